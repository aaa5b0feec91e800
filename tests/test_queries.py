"""Every registered query against its SQL in DuckDB, values and types, and against rules about its plan."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
import oracle
from ledgerline import catalogue
from ledgerline.model import ENTITIES
from ledgerline.plans import gold, marts, silver
from ledgerline.plans.lake import Lake
from ledgerline.session import shared_folder
from ledgerline.sources.files import exists, write_table
from ledgerline.workspace import lake_over
from tests.conftest import SMALL

QUERIES = catalogue.build()
ORACLES = oracle.build()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
         "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_all_have_oracles():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) > 130
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLES[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {column: TYPES[kind] for column, kind in found.dtypes} == types
    order = sorted(types)
    positions = [list(types).index(column) for column in order]
    left = sorted((tuple(plain(row[column]) for column in order) for row in found.collect()), key=repr)
    right = sorted((tuple(plain(row[index]) for index in positions) for row in result.fetchall()), key=repr)
    assert left == right
    assert left


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, scans", [("gold_customer_360", 6), ("customer_360_mart", 7)])
def test_customer_views_read_each_table_once(spark, name, scans):
    """Six tables; the mart reads the narrow customers again for their loans."""
    assert executed(QUERIES[name](spark, SMALL)).count("FileScan") == scans


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_marking_leaves_wide_rows_unshuffled(spark):
    """The large tables are scanned once and joined with broadcast key sets only."""
    for name in ("transactions", "loan_payments"):
        plan = executed(silver.checked(name, lake_over(spark, SMALL).bronze))
        assert "Exchange hashpartitioning" not in plan and plan.count("FileScan parquet") == 1


@pytest.mark.parametrize("name", ["transactions", "loan_payments", "cards"])
def test_marking_beyond_the_budget_scans_wide_rows_once(spark, no_broadcast, name):
    """However many lookups follow each other, each adds one join and no scan."""
    lake = Lake(spark, "unused", lambda entity: spark.read.parquet(_bronze(spark, entity)))
    plan = executed(silver.checked(name, lake.bronze))
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan


def _bronze(spark, entity):
    path = f"{shared_folder(spark)}/test-bronze/{entity}"
    if not exists(spark, path):
        write_table(lake_over(spark, SMALL).bronze(entity), path, ENTITIES[entity].layout)
    return path


def test_silver_beyond_the_budget_is_gathered(spark, no_broadcast, folder):
    """Rows that lookups have shuffled come together again before they are written, though Bronze had the layout."""
    lake = Lake(spark, folder, lambda entity: spark.read.parquet(_bronze(spark, entity)), on_demand=False, gather=False)
    lake.build_silver("transactions")
    files = glob.glob(f"{folder}/checked/transactions/**/*.parquet", recursive=True)
    assert len(files) <= 2 * len({os.path.dirname(file) for file in files})


def test_scans_read_only_needed_columns(spark):
    plan = executed(gold.transaction_metrics(lake_over(spark, SMALL).silver))
    assert "ReadSchema: struct<account_id:bigint,amount:double>" in plan


@pytest.mark.parametrize("name", [*gold.MODELS, *marts.MARTS])
def test_transactions_are_aggregated_before_joins(spark, name):
    """No cross join anywhere, and no join below the first aggregate of transactions."""
    lake = lake_over(spark, SMALL)
    rows = gold.MODELS[name](lake.silver) if name in gold.MODELS else marts.model(spark, name, lake.silver)
    plan = executed(rows)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for index, line in enumerate(lines):
        if "FileScan" in line and "/checked/transactions" in line:
            above = [text for text in reversed(lines[:index])]
            first = next(text for text in above if "HashAggregate" in text or "Join" in text)
            assert "HashAggregate" in first
