"""The best rows of every group, in two steps: each task keeps its own best ones, and only these are shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PLANNED = 1_000  # up to so many rows a group Spark itself limits the groups of a task before it shuffles them
SHARES = 64


def best_of_groups(rows: DataFrame, by: Sequence[str], order: Sequence[Column], count: int, name: str = "rank") -> DataFrame:
    """The first `count` rows of each group with their rank, from 1. `order` should leave no ties.

    For a `count` beyond what Spark limits by itself groups are dealt over SHARES tasks first and their best ones merged.
    """
    if count > PLANNED:
        dealt = rows.withColumn("_share", F.pmod(F.xxhash64(*rows.columns), F.lit(SHARES)))
        place = F.row_number().over(Window.partitionBy(*by, "_share").orderBy(*order))
        rows = dealt.withColumn("_place", place).where(F.col("_place") <= count).drop("_place", "_share")
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn(name, rank).where(F.col(name) <= count)
