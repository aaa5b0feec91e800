"""Bronze ingestion, table layouts, publication and the whole flow, written to a temporary folder."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.model import ENTITIES
from ledgerline.operators.checks import ChecksFailed, require
from ledgerline.plans import bronze, gold, marts
from ledgerline.plans.lake import Lake
from ledgerline.plans.publish import PublishError, Publisher, Target, guard, schema_findings
from ledgerline.plans.run import open_lake, run, run_models, run_profile
from ledgerline.session import shared_folder
from ledgerline.sources.files import scan, scan_tree, write_table
from ledgerline.workspace import lake_over, raw_over
from tests.conftest import SMALL
from tests.samples import frame, tables


def test_bronze_layout_and_types(spark, folder):
    rows = frame(spark, "cards", dict(), dict(card_id=8, issued_at=None))
    rows.withColumn("issued_at", F.col("issued_at").cast("timestamp")).write.parquet(f"{folder}/cards.parquet")
    found = bronze.ingest(spark, "cards", f"{folder}/cards.parquet", f"{folder}/bronze")
    assert os.path.isdir(f"{folder}/bronze/year=2024/month=3")
    assert found.schema == ENTITIES["cards"].bronze_schema
    assert sorted((row.card_id, row.year, row.month) for row in found.collect()) == [(7, 2024, 3), (8, None, None)]
    assert spark.read.parquet(f"{folder}/bronze").schema["year"].dataType.simpleString() == "int"


def test_bronze_refuses_missing_input(spark, folder):
    with pytest.raises(AnalysisException):
        bronze.ingest(spark, "cards", f"{folder}/nothing.parquet", f"{folder}/bronze")
    frame(spark, "cards", {}).drop("issued_at").write.parquet(f"{folder}/cards.parquet")
    with pytest.raises(ValueError, match="issued_at"):
        bronze.ingest(spark, "cards", f"{folder}/cards.parquet", f"{folder}/bronze")


def test_year_filter_prunes_folders(spark, folder):
    rows = lake_over(spark, SMALL).bronze("transactions")
    write_table(rows, folder, ("year", "month"))
    schema = ENTITIES["transactions"].bronze_schema
    wanted = scan(spark, folder, schema).where("year = 1996 AND month <= 2")
    files = {os.path.dirname(path).split(folder)[1] for path in wanted.inputFiles()}
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and len(files) > 2
    assert wanted.count() == rows.where("year = 1996 AND month <= 2").count()
    by_pattern = scan_tree(spark, f"{folder}/year=1996/month=*/*.parquet", folder, schema)
    assert by_pattern.count() == rows.where("year = 1996").count()


def test_empty_partitioned_table_reads_back(spark, folder):
    schema = ENTITIES["loans"].bronze_schema
    write_table(tables(spark)("loans").where("false"), folder, ("year", "month"))
    assert scan(spark, folder, schema).count() == 0
    assert scan(spark, folder, schema).schema == schema


def test_tables_are_written_once_and_again_after_a_clean_up(spark, folder):
    given, built = tables(spark), []
    lake = Lake(spark, f"{folder}/lake", given)
    build = lake.build_silver
    lake.build_silver = lambda name: (built.append(name), build(name))
    for _ in range(2):
        assert lake.silver("accounts").count() == 1 and lake.quarantine("accounts").count() == 0
    assert built == ["accounts"]
    os.rename(lake.path("checked", "accounts"), f"{folder}/aside")
    assert lake.silver("accounts").count() == 1 and built == ["accounts"] * 2


def test_lake_without_demand_only_reads(spark, folder):
    with pytest.raises(AnalysisException):
        Lake(spark, folder, tables(spark), on_demand=False).silver("accounts")


class Cluster:
    """As much of a session as the choice of the shared folder looks at."""

    def __init__(self, master, **conf):
        self.conf, self.master, self.folder = conf, master, None
        self.sparkContext = self

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder():
    named = Cluster("yarn", **{"spark.checkpoint.dir": "hdfs://x/shared/"})
    assert shared_folder(named) == "hdfs://x/shared" and named.folder == "hdfs://x/shared/"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Cluster("yarn"))
    assert shared_folder(Cluster("local[2]")).startswith("/tmp/ledgerline-")


DAILY = Target("daily", "day")


@pytest.fixture
def publisher(spark, folder, request):
    name = f"test_{abs(hash(request.node.name))}"
    yield Publisher(spark, name, f"{folder}/published")
    spark.sql(f"DROP NAMESPACE {name} CASCADE")


def days(spark, *days, value=1):
    return spark.createDataFrame([(day, value) for day in days], "day string, n long").withColumn("day", F.to_date("day"))


def test_publish_replaces_the_days_it_has(spark, publisher):
    publisher.publish(days(spark, "2024-01-01", "2024-01-02"), DAILY)
    publisher.publish(days(spark, "2024-01-01", "2024-01-02", value=5), DAILY)
    assert sorted((str(row.day), row.n) for row in publisher.table("daily").collect()) == [
        ("2024-01-01", 5), ("2024-01-02", 5)]
    with pytest.raises(PublishError, match="1 rows in the source, 2 in the table"):
        publisher.publish(days(spark, "2024-01-02", value=9), DAILY)
    assert sorted(row.n for row in publisher.table("daily").collect()) == [5, 9]
    history = publisher.history("daily").collect()
    assert [(row.operation, row.record_count) for row in history] == [("overwrite", 2), ("create", 2)]


def test_publish_replaces_unpartitioned_tables(spark, publisher):
    target = Target("plain")
    publisher.publish(spark.range(5), target)
    publisher.publish(spark.range(2), target)
    assert publisher.table("plain").count() == 2


def test_publish_checks_schemas(spark, publisher):
    target = Target("plain")
    wide = spark.range(3).withColumn("extra", F.lit("x"))
    publisher.publish(wide, target)
    assert publisher.publish(spark.range(3), target) == [("extra", "extra", "string")]
    assert publisher.table("plain").where("extra IS NULL").count() == 3
    with pytest.raises(PublishError, match="type"):
        publisher.publish(spark.range(3).withColumn("id", F.col("id").cast("string")), target)
    with pytest.raises(PublishError, match="missing"):
        publisher.publish(wide.withColumn("more", F.lit(1)), target)
    assert publisher.table("plain").count() == 3


def test_publish_guard(spark, publisher):
    with pytest.raises(PublishError, match="nothing to publish"):
        publisher.publish(spark.range(0), Target("plain"))
    assert not spark.catalog.tableExists(publisher.full_name("plain"))
    guard(spark.range(1), "plain")


def test_history_is_empty_before_the_first_publication(publisher):
    assert publisher.history("plain").count() == 0


def test_schema_findings_ignore_order_and_nullability(spark):
    left = spark.range(1).select("id", F.lit("x").alias("name"))
    right = left.select(F.when(F.col("id") > 0, F.col("name")).alias("name"), "id")
    assert schema_findings(left.schema, right.schema) == []


def test_whole_flow(spark, folder):
    """Generated files to published tables; reconciliations fail only where children of quarantined rows remain."""
    for name in ENTITIES:
        raw_over(spark, SMALL)(name).write.parquet(f"{folder}/generated/{name}.parquet")
    lake_root = f"{folder}/lake"
    reports = dict(run(spark, f"{folder}/generated", lake_root, "test_flow"))
    counts = {row.entity: row for row in reports["silver rows"].collect()}
    for name in ENTITIES:
        assert counts[name].total_rows == raw_over(spark, SMALL)(name).count()
    assert {row.status for row in reports["silver keys"].collect()} == {"PASS"}
    assert {row.status for row in reports["gold keys"].collect()} == {"PASS"}
    recon = {(row.scope, row.check): row.status for row in reports["gold reconciliation"].collect()}
    assert recon["daily_transaction_summary", "transactions"] == recon["customer_360", "customers"] == "PASS"
    with pytest.raises(ChecksFailed, match="customer_360"):
        require(reports["gold reconciliation"])
    assert {row.table_name for row in reports["published"].collect()} == set(gold.MODELS)
    lake = open_lake(spark, lake_root)
    assert spark.table("test_flow.customer_360").count() == lake.silver("customers").count()
    spark.sql("DROP NAMESPACE test_flow CASCADE")

    tests = [row for _, report in run_models(spark, lake_root) for row in report.collect()]
    assert len(tests) == 27
    assert [(row.model, row.column_name) for row in tests if row.status == "FAIL"] == [
        ("stg_customers", "customer_segment")]
    assert spark.table("customer_360_mart").count() == lake.silver("customers").count()
    for name in marts.MODELS:
        spark.catalog.dropTempView(name)

    profiles = {name: report.count() for name, report in run_profile(spark, f"{folder}/generated")}
    assert profiles["columns"] == 57 and profiles["keys"] == 7 and profiles["references"] == 6
