"""Differences of two tables as multisets of rows, and what changed by key, without shuffling what is equal.

Each side is counted by a 128-bit hash of its rows, one side positive and the other negative. Hashes that come to zero are
done; only rows of the others are looked at in full, where the rows themselves are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.lookup import lookup
from ledgerline.session import materialise


def row_hash(rows: DataFrame) -> Column:
    """128 bits of a row. NULLs, which the hash function passes over, are told apart by their places, and 0 is -0."""
    values = [F.col(field.name) + F.lit(0.0) if isinstance(field.dataType, (T.DoubleType, T.FloatType)) else F.col(field.name)
              for field in rows.schema.fields]
    nulls = F.concat(*(F.when(F.col(name).isNull(), "1").otherwise("0") for name in rows.columns))
    return F.struct(F.xxhash64(nulls, *values).alias("a"), F.xxhash64(*values, F.lit(7), nulls).alias("b"))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows whose copies differ, with `difference`: copies on the left less those on the right.

    The tables need the same columns. NULL equals NULL and NaN equals NaN, as in EXCEPT ALL.
    """
    if left.dtypes != right.select(left.columns).dtypes:
        raise ValueError(f"columns differ: {left.dtypes} and {right.dtypes}")
    columns = left.columns
    both = left.withColumn("_sign", F.lit(1)).unionByName(right.select(columns).withColumn("_sign", F.lit(-1)))
    hashed = both.withColumn("_hash", row_hash(left))
    unequal = hashed.groupBy("_hash").agg(F.sum("_sign").alias("n")).where("n <> 0").select("_hash")
    suspects = lookup(hashed, materialise(unequal), "_hash", sparse=True)
    return suspects.groupBy(*columns).agg(F.sum("_sign").alias("difference")).where("difference <> 0")


def changed_rows(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, status, changed): keys whose rows differ. Status is `only_left`, `only_right`, `changed` (one differing row on
    each side; `changed` lists the columns) or `repeated` (several on a side, which no column list can tell)."""
    others = [name for name in left.columns if name not in key]
    found = multiset_difference(left, right)
    side = lambda condition, name: F.when(F.expr(condition), F.struct(*others)).alias(name)
    sides = found.select(*key, "difference", side("difference > 0", "_left"), side("difference < 0", "_right"))
    grouped = sides.groupBy(*key).agg(
        F.first("_left", ignorenulls=True).alias("_left"), F.first("_right", ignorenulls=True).alias("_right"),
        F.sum(F.greatest("difference", F.lit(0))).alias("_n_left"), F.sum(F.greatest(-F.col("difference"), F.lit(0))).alias("_n_right"))
    status = F.when((F.col("_n_left") > 1) | (F.col("_n_right") > 1), "repeated").when(F.col("_n_right") == 0, "only_left").when(
        F.col("_n_left") == 0, "only_right").otherwise("changed")
    names = F.array_compact(F.array(*(
        F.when(~F.col(f"_left.{name}").eqNullSafe(F.col(f"_right.{name}")), F.lit(name)) for name in others)))
    return grouped.select(*key, status.alias("status"), names.alias("_names")).select(
        *key, "status", F.when(F.col("status") == "changed", F.array_join("_names", ",")).alias("changed"))
