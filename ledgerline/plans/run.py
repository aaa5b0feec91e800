"""The flows: generated files to published Gold, the SQL models over Silver, and the profile of generated files."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.model import ENTITIES
from ledgerline.operators.checks import stack
from ledgerline.plans import bronze, gold, marts, profile, quality
from ledgerline.plans.incremental import MODELS, IncrementalLake
from ledgerline.plans.lake import Lake
from ledgerline.plans.publish import Publisher
from ledgerline.sources.files import exists, scan, write_table


def open_lake(spark: SparkSession, root: str) -> Lake:
    """A lake whose Bronze tables were ingested under `root`."""
    tables = lambda name: scan(spark, f"{root}/bronze/{name}", ENTITIES[name].bronze_schema)
    return Lake(spark, root, tables, on_demand=False, gather=False)


def run(spark: SparkSession, source: str, root: str, namespace: str) -> Iterator[tuple[str, DataFrame]]:
    """Bronze, Silver, its checks, Gold, its checks, publication; yields (step, its report).

    Reports do not stop the flow (see checks.require), a failed publication does.
    """
    for name in ENTITIES:
        bronze.ingest(spark, name, f"{source}/{name}.parquet", f"{root}/bronze/{name}")
    lake = open_lake(spark, root)
    for name in ENTITIES:
        lake.build_silver(name)
    yield "silver rows", quality.row_counts(lake.silver, lake.quarantine)
    yield "silver keys", quality.primary_keys(lake.silver)
    yield "silver references", quality.silver_references(lake.silver)
    yield "silver rules", quality.business_rules(lake.silver)
    for name in gold.MODELS:
        lake.build_gold(name)
    yield "gold keys", stack([quality.gold_daily_key(lake.gold), quality.gold_keys(lake.gold)])
    yield "gold reconciliation", stack([
        check(lake.silver, lake.gold) for check in quality.RECONCILIATIONS.values()
    ])
    publisher = Publisher(spark, namespace, f"{root}/published")
    publisher.publish_all(lake.gold)
    yield "published", stack([publisher.history(target) for target in gold.MODELS])


def run_increment(spark: SparkSession, source: str, root: str, batch: int) -> Iterator[tuple[str, DataFrame]]:
    """Take one more delivery of generated files into an incremental lake and publish nothing: Gold follows from its state.

    Entities without a file in `source` have nothing new. A batch that is already committed is not taken twice.
    """
    lake = IncrementalLake(spark, root)
    paths = {name: f"{source}/{name}.parquet" for name in ENTITIES}
    lake.apply(batch, {
        name: scan(spark, path, ENTITIES[name].columns) for name, path in paths.items() if exists(spark, path)})
    yield "silver rows", quality.row_counts(lake.silver, lake.quarantine)
    for name, model in MODELS.items():
        write_table(model(lake), f"{root}/gold/{name}", gold.LAYOUTS.get(name, ()), spread=gold.FOLDER_TASKS)
        rows = scan(spark, f"{root}/gold/{name}", gold.SCHEMAS[name])
        yield f"gold {name}", rows.agg(F.count(F.lit(1)).alias("row_count"))


def run_models(spark: SparkSession, root: str) -> Iterator[tuple[str, DataFrame]]:
    """Build the SQL models of a lake, register them as views and run their column tests."""
    models = marts.build_tables(spark, open_lake(spark, root).silver, f"{root}/models")
    marts.create_views(spark, models)
    for layer in quality.COLUMN_TESTS:
        yield layer, quality.data_tests(layer, models)


def run_profile(spark: SparkSession, source: str) -> Iterator[tuple[str, DataFrame]]:
    """Profile generated files."""
    tables = {name: scan(spark, f"{source}/{name}.parquet", entity.columns) for name, entity in ENTITIES.items()}
    raw = tables.__getitem__
    yield "columns", profile.columns(raw)
    yield "duplicate rows", profile.duplicates(raw)
    yield "keys", profile.primary_keys(raw)
    yield "references", quality.raw_references(raw)
    yield "transactions", profile.transactions(raw)
    yield "loans", profile.loans(raw)
    yield "card merchants", profile.card_merchants(raw)
    yield "outliers", profile.outliers(raw)
