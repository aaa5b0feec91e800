"""Rows of a key in time order: as-of look-ups, running totals and gap sessions, safe for keys of any size.

A window over a key puts all of its rows into one task. Here a key with many rows is cut into slices of its order, which are
windows of their own; what a slice needs of the earlier ones (the last state, the sums so far, the last moment) is taken
from one summary row a slice and handed on. Both passes are ordinary aggregations and windows, and keys below the floor are
a single slice and need neither.

The cuts come from a sample of the large keys' places: about SAMPLES of them a slice, MOST_SLICES slices at most in all, so
they are broadcast. They decide who does the work, never the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.lookup import hot_counts, lookup
from ledgerline.session import materialise

SLICE_ROWS = 1_000_000  # rows of one key that one task gets, more only if MOST_SLICES would not do
MOST_SLICES = 100_000
SAMPLES = 16
STEP = 128  # points under one head: a place is found by looking at the heads and then at one head's points
WITHOUT_KEY = 4_096  # rows without a key are dealt over so many windows


def cut_points(places: DataFrame, key: str, floor: int = SLICE_ROWS) -> DataFrame:
    """(key, points, heads) of the keys with `floor` rows or more: ascending places that cut their rows into slices.

    `places` has the columns `key` and `place`, anything that can be ordered.
    """
    rows = places.count()
    floor = max(floor, -(-rows // MOST_SLICES), SAMPLES)
    hot = materialise(hot_counts(places, key, floor).select(key))
    sampled = places.join(F.broadcast(hot), key).where(F.pmod(F.xxhash64("place"), F.lit(floor // SAMPLES)) == 0)
    held = sampled.distinct().groupBy(key).agg(F.sort_array(F.collect_list("place")).alias("held"))  # about rows / floor * SAMPLES
    every = lambda name, first, step: F.when(F.size(name) > first, F.transform(
        F.sequence(F.lit(first), F.size(name) - 1, F.lit(step)), lambda at: F.element_at(name, at + 1))).otherwise(
        F.slice(name, 1, 0))
    points = held.select(key, every("held", SAMPLES, SAMPLES).alias("points")).where(F.size("points") > 0)
    return materialise(points.withColumn("heads", every("points", 0, STEP)))


def _slice(place: Column) -> Column:
    """How many points are not beyond the place."""
    upto = lambda points: F.size(F.filter(points, lambda point: point <= place))
    head = upto(F.col("heads"))
    near = F.slice("points", F.greatest((head - 1) * STEP + 1, F.lit(1)), STEP)
    return F.when(head > 0, (head - 1) * STEP + upto(near)).otherwise(0)


class Slices:
    """The slices of one set of places; `any` tells whether a key needed cutting at all."""

    def __init__(self, places: DataFrame, key: str, floor: int):
        self.key = key
        self.cuts = cut_points(places, key, floor)
        self.any = not self.cuts.isEmpty()

    def dealt(self, rows: DataFrame, tie: Column) -> DataFrame:
        """`rows`, which have a column `place`, with their number of `_slice`. Rows without a key are spread by `tie`."""
        number = F.lit(0)
        if self.any:
            rows = rows.join(F.broadcast(self.cuts), self.key, "left")
            number = F.coalesce(_slice(F.col("place")), F.lit(0))
        number = F.when(F.col(self.key).isNull(), F.pmod(tie, F.lit(WITHOUT_KEY))).otherwise(number)
        return rows.withColumn("_slice", number.cast("int")).drop("points", "heads")

    def window(self) -> Window:
        return Window.partitionBy(self.key, "_slice").orderBy("place")

    def of_cut_keys(self, rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(self.cuts.select(self.key)), self.key, "left_semi")

    def carried(self, summary: DataFrame, merged: Mapping[str, Column]) -> DataFrame:
        """(_piece, merged columns): for each slice what the aggregates `merged` say of the earlier slices' summaries."""
        all_slices = self.cuts.select(self.key, F.explode(F.sequence(F.lit(0), F.size("points"))).alias("_slice"))
        earlier = Window.partitionBy(self.key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        handed = all_slices.join(summary, [self.key, "_slice"], "left").select(
            self.piece(), *(value.over(earlier).alias(name) for name, value in merged.items()))
        return materialise(handed)

    def piece(self) -> Column:
        return F.struct(F.col(self.key).alias("key"), F.col("_slice").cast("int").alias("slice")).alias("_piece")

    def hand_on(self, rows: DataFrame, carried: DataFrame) -> DataFrame:
        """`rows` with what is carried into their slices, NULL for keys in one piece."""
        return lookup(rows.withColumn("_piece", self.piece()), carried, "_piece", "left").drop("_piece")


def as_of(
    rows: DataFrame, states: DataFrame, key: str, at: str, since: str, values: Sequence[str], *, floor: int = SLICE_ROWS,
) -> DataFrame:
    """Each of `rows` with `since` and `values` of the latest state of its key that began at `at` or before; NULL if none.

    Of several states of one key and moment the one with the largest values, in their order, holds. Rows without a key or
    a moment have no state; states without one are no states.
    """
    held = F.struct(F.col(since).alias("since"), *(F.col(name).alias(f"v{at_}") for at_, name in enumerate(values)))
    told = states.where(F.col(key).isNotNull() & F.col(since).isNotNull()).groupBy(key, since).agg(
        F.max(F.struct(*values)).alias("_values")).select(key, since, "_values.*")
    place = lambda moment, side, tie: F.struct(moment.alias("at"), F.lit(side).alias("side"), tie.alias("tie")).alias("place")
    tie = F.xxhash64(*rows.columns)
    left = rows.select(F.struct(*rows.columns).alias("_row"), key, place(F.col(at), 1, tie))
    right = told.select(key, place(F.col(since), 0, F.lit(0).cast("long")), held.alias("_state"))
    known = left.where(F.col(key).isNotNull() & F.col("place.at").isNotNull())
    slices = Slices(known.select(key, "place").unionByName(right.select(key, "place")), key, floor)

    both = slices.dealt(left.unionByName(right, allowMissingColumns=True), F.col("place.tie"))
    latest = F.last("_state", ignorenulls=True).over(slices.window().rowsBetween(Window.unboundedPreceding, 0))
    found = both.withColumn("_state", latest).where(F.col("_row").isNotNull())
    if slices.any:
        ends = slices.of_cut_keys(slices.dealt(right, F.lit(0))).groupBy(key, "_slice").agg(
            F.max_by("_state", "place").alias("_last"))
        carried = slices.carried(ends, {"_carried": F.last("_last", ignorenulls=True)})
        found = slices.hand_on(found, carried).withColumn("_state", F.coalesce("_state", "_carried"))
    usable = F.col(f"_row.{at}").isNotNull()
    return found.select(
        *(F.col(f"_row.{name}").alias(name) for name in rows.columns),
        F.when(usable, F.col("_state.since")).alias(since),
        *(F.when(usable, F.col(f"_state.v{number}")).alias(name) for number, name in enumerate(values)))


def running_totals(
    rows: DataFrame, key: str, order: Sequence[str], sums: Mapping[str, str], *, floor: int = SLICE_ROWS,
) -> DataFrame:
    """`rows` with running sums of SQL expressions over a key's rows in order; rows equal in the order share a total.

    NULLs add nothing; a total without any value yet is NULL. Rows without a key have NULL totals.
    """
    parts = {name: f"_part{number}" for number, name in enumerate(sums)}
    placed = rows.withColumn("place", F.struct(*order)).withColumns({parts[name]: F.expr(text) for name, text in sums.items()})
    known = placed.where(F.col(key).isNotNull())
    slices = Slices(known.select(key, "place"), key, floor)
    dealt = slices.dealt(placed, F.xxhash64(*rows.columns))
    upto = slices.window().rangeBetween(Window.unboundedPreceding, Window.currentRow)
    totals = dealt.withColumns({name: F.sum(parts[name]).over(upto) for name in sums})
    if slices.any:
        held = slices.of_cut_keys(slices.dealt(known, F.lit(0))).groupBy(key, "_slice").agg(
            *(F.sum(part).alias(part) for part in parts.values()))
        carried = slices.carried(held, {f"_carried{part}": F.sum(part) for part in parts.values()})
        totals = slices.hand_on(totals, carried)
        both = lambda name: F.coalesce(F.col(name) + F.col(f"_carried{parts[name]}"), F.col(name), F.col(f"_carried{parts[name]}"))
        totals = totals.withColumns({name: both(name) for name in sums})
    without = F.col(key).isNull()
    return totals.select(*rows.columns, *(F.when(~without, F.col(name)).alias(name) for name in sums))


def sessions(
    rows: DataFrame, key: str, at: str, gap: str, *, tie: Sequence[str] = (), floor: int = SLICE_ROWS,
) -> DataFrame:
    """`rows` with `session`, numbered from 1 for each key: a row more than `gap` (an SQL interval) after the one before
    it begins a new one. Rows without a key or a moment are left out. `tie` orders rows of one moment, for even slices."""
    known = rows.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn("place", F.struct(at, *tie))
    slices = Slices(known.select(key, "place"), key, floor)
    dealt = slices.dealt(known, F.lit(0))
    before = F.lag(at).over(slices.window())
    if slices.any:
        moments = slices.of_cut_keys(dealt).groupBy(key, "_slice").agg(F.max(at).alias("_latest"))
        dealt = slices.hand_on(dealt, slices.carried(moments, {"_earlier": F.max("_latest")}))
        before = F.coalesce(before, F.col("_earlier"))
    dealt = dealt.withColumn("_before", before)
    begins = F.col("_before").isNull() | (F.col(at) > F.col("_before") + F.expr(f"INTERVAL {gap}"))
    flagged = dealt.withColumn("_begins", begins.cast("long"))
    upto = slices.window().rangeBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = flagged.withColumn("session", F.sum("_begins").over(upto))
    if slices.any:
        begun = slices.of_cut_keys(flagged).groupBy(key, "_slice").agg(F.sum("_begins").alias("_begun"))
        numbered = slices.hand_on(numbered, slices.carried(begun, {"_so_far": F.sum("_begun")}))
        numbered = numbered.withColumn("session", F.col("session") + F.coalesce("_so_far", F.lit(0)))
    return numbered.select(*rows.columns, "session")
