"""Parquet scans and sinks of the lake.

Scans take the declared schema, so an empty table and a NULL-only partition read back with the right types, and no
footer has to be opened for inference. Filters on year, month or transaction_date prune directories.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def grouped_listing(spark: SparkSession) -> Iterator[None]:
    """List many folders in a few tasks per core; the default starts one task per folder."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def scan(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet file, a flat directory or a directory laid out by `column=value` folders."""
    with grouped_listing(spark):
        return spark.read.schema(schema).parquet(path)


def scan_tree(spark: SparkSession, pattern: str, base: str, schema: T.StructType) -> DataFrame:
    """Files under a wildcard pattern, keeping the partition columns of the folders below `base`."""
    with grouped_listing(spark):
        return spark.read.schema(schema).option("basePath", base).parquet(pattern)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this application wrote and nobody reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def conform(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared columns, in order. Timestamps become microseconds without zone; NULL stays NULL."""
    return rows.select(*(F.col(field.name).cast(field.dataType).alias(field.name) for field in schema.fields))


def write_table(
    rows: DataFrame, path: str, layout: Sequence[str] = (), gather: bool = True, spread: int | None = None
) -> None:
    """Overwrite a Parquet table, laid out by the given columns.

    `gather` brings the rows of a folder together first, so that a folder does not get one small file per task. The
    rebalance hint, unlike a repartition, lets Spark split a folder that holds a large share of the rows. Input that
    already has this layout does not need it. `spread` is for aggregates with many folders of a few rows each, where
    the folders and not the bytes are the work: they are dealt out over that many tasks.
    """
    keys = [F.col(name) for name in layout]
    if keys and spread:
        rows = rows.repartition(spread, *keys)
    elif keys and gather:
        rows = rows.hint("rebalance", *keys)
    writer = rows.write.mode("overwrite").option("compression", "snappy")
    if layout:
        writer = writer.partitionBy(*layout)
    writer.parquet(path)
