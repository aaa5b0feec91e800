"""Publication of Gold as catalog tables: guard, prepare, write, check schema and counts, keep a history.

Tables of the session catalog are Parquet tables; replacing one replaces the partitions present in the source and
leaves others alone. A name in another (DataSource V2) catalog is written through the V2 writer instead, partitioned
by day.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.catalog import scan_table
from ledgerline.sources.files import grouped_listing


class PublishError(PySparkException):
    """A publication that must not, or did not, go through."""


@dataclass(frozen=True)
class Target:
    """A table to publish; `partition` is its date column, if it has one."""

    name: str
    partition: str | None = None


# The published tables; only the daily summary is partitioned.
TARGETS = (
    Target("daily_transaction_summary", "transaction_date"),
    Target("customer_transaction_metrics"),
    Target("merchant_performance"),
    Target("loan_portfolio"),
    Target("customer_360"),
)

HISTORY = "publish_history"
HISTORY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("operation", T.StringType()),
    T.StructField("record_count", T.LongType()),
])


def guard(source: DataFrame, name: str) -> None:
    if source.isEmpty():
        raise PublishError(f"{name}: nothing to publish")


def prepare(source: DataFrame, target: Target, files: int | None = None) -> DataFrame:
    """Deal the rows out to write tasks by their size, days kept together; Spark may split a large day.

    `files` fixes the number of tasks instead.
    """
    if files:
        return source.repartition(files, target.partition) if target.partition else source.repartition(files)
    return source.hint("rebalance", target.partition) if target.partition else source.hint("rebalance")


def schema_findings(source: T.StructType, target: T.StructType) -> list[tuple[str, str, str]]:
    """(column, finding, detail) by name and type; order and nullability do not matter.

    `missing` and `type` are errors, `extra` (only in the target) is a warning.
    """
    given = {field.name: field.dataType for field in source.fields}
    held = {field.name: field.dataType for field in target.fields}
    found = [(name, "missing", given[name].simpleString()) for name in given if name not in held]
    found += [
        (name, "type", f"{given[name].simpleString()} <> {held[name].simpleString()}")
        for name in given
        if name in held and given[name] != held[name]
    ]
    found += [(name, "extra", held[name].simpleString()) for name in held if name not in given]
    return sorted(found)


def check_schema(source: T.StructType, target: T.StructType, name: str) -> list[tuple[str, str, str]]:
    """Raise on errors, return the warnings."""
    findings = schema_findings(source, target)
    errors = [finding for finding in findings if finding[1] != "extra"]
    if errors:
        raise PublishError(f"{name}: schema does not match: {errors}")
    return findings


def check_count(source: DataFrame, target: DataFrame, name: str) -> int:
    """Compare row counts after the write; a day that vanished from the source makes them differ."""
    expected, actual = source.count(), target.count()
    if expected != actual:
        raise PublishError(f"{name}: {expected} rows in the source, {actual} in the table")
    return actual


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Publisher:
    """Publishes into one namespace; `location` is the folder for its tables where the catalog does not choose one."""

    def __init__(self, spark: SparkSession, namespace: str, location: str | None = None, provider: str = "parquet"):
        self.spark = spark
        self.namespace = namespace
        self.location = location.rstrip("/") if location else None
        self.provider = provider
        self._v2 = namespace.count(".") > 0 and not namespace.startswith("spark_catalog.")
        where = f" LOCATION '{self.location}'" if self.location and not self._v2 else ""
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")

    def full_name(self, name: str) -> str:
        return f"{self.namespace}.{name}"

    def table(self, name: str) -> DataFrame:
        return scan_table(self.spark, self.full_name(name))

    def create(self, rows: DataFrame, target: Target) -> None:
        name = self.full_name(target.name)
        if self._v2:
            writer = rows.writeTo(name).using(self.provider)
            if target.partition:
                writer = writer.partitionedBy(F.days(target.partition))
            writer.create()
            return
        writer = rows.write.format(self.provider)
        if self.location:
            writer = writer.option("path", f"{self.location}/{target.name}")
        if target.partition:
            writer = writer.partitionBy(target.partition)
        with grouped_listing(self.spark):  # the catalog registers the folders it finds
            writer.saveAsTable(name)

    def overwrite_partitions(self, rows: DataFrame, target: Target) -> None:
        """Replace the partitions present in `rows`; a table without partitions is replaced as a whole."""
        name = self.full_name(target.name)
        if self._v2:
            rows.writeTo(name).overwritePartitions()
            return
        held = self.table(target.name).schema.fields
        aligned = [
            F.col(field.name) if field.name in rows.columns else F.lit(None).cast(field.dataType).alias(field.name)
            for field in held
        ]
        with _dynamic_overwrite(self.spark), grouped_listing(self.spark):
            rows.select(*aligned).write.insertInto(name, overwrite=True)

    def publish(self, source: DataFrame, target: Target, files: int | None = None) -> list[tuple[str, str, str]]:
        """Write one table and validate it; returns schema warnings, raises PublishError at the first error."""
        guard(source, target.name)
        rows = prepare(source, target, files)
        exists = self.spark.catalog.tableExists(self.full_name(target.name))
        if exists:
            check_schema(source.schema, self.table(target.name).schema, target.name)
            self.overwrite_partitions(rows, target)
        else:
            self.create(rows, target)
        self.spark.catalog.refreshTable(self.full_name(target.name))
        written = self.table(target.name)
        warnings = check_schema(source.schema, written.schema, target.name)
        count = check_count(source, written, target.name)
        self._record(target, "overwrite" if exists else "create", count)
        return warnings

    def publish_all(self, gold, targets: Sequence[Target] = TARGETS, files: int | None = None) -> None:
        for target in targets:
            self.publish(gold(target.name), target, files)

    def _record(self, target: Target, operation: str, count: int) -> None:
        entry = self.spark.range(0, 1, 1, 1).select(
            F.lit(target.name).alias("table_name"), F.current_timestamp().alias("committed_at"),
            F.lit(operation).alias("operation"), F.lit(count).cast("long").alias("record_count"),
        )
        name = self.full_name(HISTORY)
        if self.spark.catalog.tableExists(name):
            entry.writeTo(name).append() if self._v2 else entry.write.insertInto(name)
        else:
            self.create(entry, Target(HISTORY))

    def history(self, name: str, count: int = 5) -> DataFrame:
        """The latest publications of a table, newest first; empty if there is none."""
        if not self.spark.catalog.tableExists(self.full_name(HISTORY)):
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        entries = self.table(HISTORY).where(F.col("table_name") == name)
        return entries.orderBy(F.desc("committed_at")).limit(count)
