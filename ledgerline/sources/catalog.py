"""Reading published tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.files import grouped_listing


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    with grouped_listing(spark):
        return spark.table(name)
