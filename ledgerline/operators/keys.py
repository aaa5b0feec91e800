"""Key sets: keys that repeat and keys without a parent.

Both are computed from the key column alone with a pre-aggregated count, so a key that holds a large share of the rows
is one row per map task before anything is shuffled, and the wide rows are not touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(rows: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """(key, copies), NULL included as a key of its own."""
    name = alias or key
    return rows.groupBy(F.col(key).alias(name)).agg(F.count(F.lit(1)).alias("copies"))


def repeated_keys(rows: DataFrame, key: str) -> DataFrame:
    """Non-NULL keys that occur more than once, with their number of copies."""
    return key_counts(rows.where(F.col(key).isNotNull()), key).where("copies > 1")


def _known(parents: DataFrame, parent_key: str, key: str) -> DataFrame:
    found = parents.select(F.col(parent_key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return found.withColumn("_known", F.lit(True))


def unmatched_keys(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Keys (NULL among them) that do not occur among the parents, with their number of copies.

    Both sides hold one row per key when they meet, so the join cannot be skewed. That is why this is not an anti
    join: the optimizer may move an anti or semi join below the aggregation, where it would meet every row.
    """
    marked = key_counts(rows, key).join(_known(parents, parent_key, key), key, "left")
    return marked.where(F.col("_known").isNull()).drop("_known")


def matched_keys(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Keys that do occur among the parents, with their number of copies."""
    return key_counts(rows, key).join(_known(parents, parent_key, key), key).drop("_known")
