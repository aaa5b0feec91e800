"""Joins of a large frame with one that is unique on the key, safe against hot keys.

Two ways, both exact:

* the looked-up side is measured and, within the budget, broadcast: the large side is not shuffled at all;
* beyond it, one shuffle join on the key and a salt; where few rows are expected to match (`sparse`), a sieve of bounded size
  (see operators.sieve) drops those that certainly do not before the shuffle. The salt is 0 but for keys that hold a large share of the rows, whose
  rows are spread over several salts and whose entries are repeated for each. There are at most `HOT_KEYS` such keys,
  those with most rows, so they are broadcast. Rows without a key have no entry and are spread as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.sieve import Sieve
from ledgerline.session import broadcast_budget, materialise

HOT_KEYS = 100_000  # the keys beyond these hold less than 1/HOT_KEYS of the rows each
HOT_FLOOR = 10_000  # fewer rows than this never make a key hot
MOST_SALTS = 4_096
ROW_OVERHEAD = 24


def measured_bytes(df: DataFrame) -> int:
    """Rows times their uncompressed width, from one aggregate over the frame."""
    width = F.lit(ROW_OVERHEAD)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0)) + 8
        else:
            width = width + 8
    return df.agg(F.sum(width.cast("long")).alias("size")).first()["size"] or 0


def hot_counts(rows: DataFrame, key: str, floor: int = HOT_FLOOR) -> DataFrame:
    """(key, copies) of the keys with at least `floor` rows, the HOT_KEYS largest of them at most."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    return counts.where(F.col("copies") >= floor).orderBy(F.desc("copies"), key).limit(HOT_KEYS)


def hot_keys(rows: DataFrame, key: str, floor: int = HOT_FLOOR) -> DataFrame:
    """Keys holding so many rows that one task should not receive them all."""
    return hot_counts(rows, key, floor).select(key)


def lookup(
    rows: DataFrame, entries: DataFrame, key: str, how: str = "inner", floor: int = HOT_FLOOR, *,
    counted: DataFrame | None = None, shuffled: list[str] | None = None, sparse: bool = False,
) -> DataFrame:
    """`rows` joined (inner or left) with `entries`, which hold at most one row per key.

    `counted` is a cheaper frame with the same keys as `rows`, for finding hot ones. If the rows are shuffled, the key
    is added to `shuffled`, so that a writer knows that they have lost their layout. `sparse` tells that few rows match.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookup is inner or left, not {how}")
    columns = rows.columns + [name for name in entries.columns if name != key]
    if measured_bytes(entries) <= broadcast_budget(rows.sparkSession):
        return rows.join(F.broadcast(entries), key, how).select(columns)

    if shuffled is not None:
        shuffled.append(key)
    if sparse and how == "inner":
        rows = Sieve(entries, key).kept(rows)
    hot = materialise(hot_counts(rows if counted is None else counted, key, floor))
    salts = hot.select(key, F.least(F.ceil(F.col("copies") / floor), F.lit(MOST_SALTS)).cast("int").alias("_salts"))
    # The same for a repeated task: it depends on the row and on the number of its partition.
    spread = F.xxhash64(F.spark_partition_id(), *rows.columns)
    salt = F.when(F.col(key).isNull(), F.pmod(spread, F.lit(MOST_SALTS))).when(
        F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts"))).otherwise(F.lit(0)).cast("int")
    salted = rows.join(F.broadcast(salts), key, "left").withColumn("_salt", salt).drop("_salts")
    last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
    repeated = entries.join(F.broadcast(salts), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), last))).drop("_salts")
    return salted.join(repeated, [key, "_salt"], how).select(columns)
