"""Bronze: generated tables with normalised timestamps, laid out by the year and month of the entity's date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.model import ENTITIES, PARTITION_COLUMNS
from ledgerline.sources.files import conform, scan, write_table


def add_partition_columns(rows: DataFrame, date_column: str) -> DataFrame:
    """Rows without a date keep NULL year and month, so that Silver can quarantine them with a reason."""
    return rows.withColumns({"year": F.year(date_column), "month": F.month(date_column)})


def ingest(spark: SparkSession, entity: str, source: str, target: str) -> DataFrame:
    """Read one generated table, write it as Bronze in a single job, return the Bronze scan."""
    declared = ENTITIES[entity]
    found = spark.read.parquet(source)  # raises if the file is missing
    if declared.date_column not in found.columns:
        raise ValueError(f"{entity}: no date column {declared.date_column} in {source}")
    rows = add_partition_columns(conform(found, declared.columns), declared.date_column)
    write_table(rows, target, PARTITION_COLUMNS)
    return scan(spark, target, declared.bronze_schema)
