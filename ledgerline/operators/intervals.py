"""Joins of spans that overlap, without comparing every span of one side with every one of the other.

Spans are [start, end], whole numbers, both ends included; NULL for an end is a span that never ends. Time is cut into bins
of `width`, and again at every level into bins twice as wide. A span belongs to the lowest level whose bins are no shorter
than it, so it touches two of them at most. Two spans meet at the higher one of their levels: each side is placed at its own
level and at the higher levels that the other side has. Of the bins that two spans share the one where the later of them
starts is the owner, so every pair comes out once. The join itself is an ordinary one on key, level and bin; where one of
these holds many rows of either side it is dealt over a grid of salts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lookup import HOT_FLOOR, MOST_SALTS, hot_counts
from ledgerline.session import materialise

NEVER = (1 << 62) - 1  # stands for the end of a span that has none
MICROS_A_DAY = 86_400_000_000


def micros(moment: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {moment})")


def spread_join(left: DataFrame, right: DataFrame, key: str, floor: int = HOT_FLOOR) -> DataFrame:
    """Inner join on one column, many to many. A key with many rows on a side is dealt over salts there, and the other
    side's rows of it are repeated for each, so that no task gets more than about `floor` rows of a key from either side."""
    sides = []
    for rows, name in ((left, "_i"), (right, "_j")):
        hot = materialise(hot_counts(rows, key, floor).select(
            key, F.least(F.ceil(F.col("copies") / floor), F.lit(MOST_SALTS)).cast("int").alias(f"{name}_salts")))
        sides.append((rows, name, None if hot.isEmpty() else hot))
    if all(hot is None for _, _, hot in sides):
        return left.join(right.hint("merge"), key)
    salted = []
    for rows, name, own in sides:
        _, other, theirs = next(side for side in sides if side[1] != name)
        spread = F.xxhash64(F.spark_partition_id(), *rows.columns)  # the same for a repeated task
        rows = rows.join(F.broadcast(own), key, "left") if own is not None else rows.withColumn(f"{name}_salts", F.lit(1))
        rows = rows.join(F.broadcast(theirs), key, "left") if theirs is not None else rows.withColumn(f"{other}_salts", F.lit(1))
        rows = rows.withColumn(name, F.pmod(spread, F.coalesce(f"{name}_salts", F.lit(1))).cast("int"))
        rows = rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(f"{other}_salts", F.lit(1)) - 1)))
        salted.append(rows.drop(f"{name}_salts", f"{other}_salts"))
    return salted[0].join(salted[1].hint("merge"), [key, "_i", "_j"]).drop("_i", "_j")


def _leveled(rows: DataFrame, span: Sequence[str], width: int, keys: Sequence[str]) -> DataFrame:
    start, end = span
    top = 62 - width.bit_length()
    until = F.least(F.coalesce(F.col(end), F.lit(NEVER)), F.lit(NEVER))
    known = rows.withColumns({"_start": F.col(start).cast("long"), "_end": until.cast("long")}).where(
        F.col("_start").isNotNull() & (F.col("_start") <= F.col("_end")))
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    length = F.col("_end").cast("double") - F.col("_start").cast("double")
    level = F.when(length <= width, 0).otherwise(F.least(F.ceil(F.log2(length / width)), F.lit(top)))
    return known.withColumn("_level", level.cast("int"))


def _bin(value: Column, width: int, level: Column) -> Column:
    """A whole quotient: never falls as the value rises, which is all that bins need."""
    return F.call_function("div", value, F.call_function("shiftleft", F.lit(width).cast("long"), level))


def _placed(rows: DataFrame, others: list[int], keys: Sequence[str], width: int) -> DataFrame:
    """One row for each bin in which a span may meet one of the other side."""
    own = F.when(F.col("_level") >= min(others), F.array("_level")).otherwise(F.array().cast("array<int>"))
    higher = F.filter(F.array(*(F.lit(level) for level in others)), lambda level: level > F.col("_level"))
    at = rows.withColumn("_at", F.explode(F.concat(own, higher)))
    bins = F.sequence(_bin(F.col("_start"), width, F.col("_at")), _bin(F.col("_end"), width, F.col("_at")))
    return at.withColumn("_bin", F.explode(bins)).withColumn("_meet", F.struct(*keys, "_at", "_bin")).drop(*keys, "_at", "_bin")


def overlapping(
    left: DataFrame, right: DataFrame, left_span: Sequence[str], right_span: Sequence[str], *, keys: Sequence[str] = (),
    width: int = MICROS_A_DAY, floor: int = HOT_FLOOR,
) -> DataFrame:
    """All pairs of a row of `left` and one of `right` with equal keys whose spans share a value.

    Columns: the keys, then the others of both sides, whose names must differ. Rows with a NULL key or start, and spans that
    end before they start, meet nothing. Levels, at most 62 a side, are the only thing that comes to the driver.
    """
    clash = ({name.lower() for name in left.columns} & {name.lower() for name in right.columns}) - {key.lower() for key in keys}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    sides = [_leveled(rows, span, width, keys) for rows, span in ((left, left_span), (right, right_span))]
    levels = [sorted(row["_level"] for row in side.select("_level").distinct().collect()) for side in sides]
    columns = [*keys, *(name for name in left.columns + right.columns if name not in keys)]
    if not all(levels):
        return left.join(right.drop(*keys), F.lit(False)).select(columns)
    renamed = []
    for side, others, mark in zip(sides, levels[::-1], "lr"):
        placed = _placed(side, others, keys, width)
        renamed.append(placed.withColumnsRenamed({name: f"{name}_{mark}" for name in ("_start", "_end", "_level")}))
    met = spread_join(renamed[0], renamed[1], "_meet", floor)
    later = F.greatest("_start_l", "_start_r")
    pairs = met.where(
        (F.greatest("_level_l", "_level_r") == F.col("_meet._at")) & (later <= F.least("_end_l", "_end_r"))
        & (_bin(later, width, F.col("_meet._at")) == F.col("_meet._bin")))
    return pairs.select(*(F.col(f"_meet.{key}").alias(key) for key in keys),
                        *(name for name in left.columns + right.columns if name not in keys))
