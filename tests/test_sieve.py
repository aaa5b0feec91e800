"""Beyond the broadcast budget only rows that may match are shuffled, with the same results; quantiles in bounded passes."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import membership, quantiles, sieve
from ledgerline.operators.copies import duplicate_rows
from ledgerline.operators.lookup import lookup
from ledgerline.operators.quantiles import exact_quantiles
from ledgerline.operators.sieve import Sieve
from ledgerline.plans import silver
from ledgerline.plans.lake import Lake
from ledgerline.session import BROADCAST_BUDGET_CONF
from ledgerline.sources.files import write_table
from ledgerline.workspace import lake_over
from tests.conftest import SMALL


def executed(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """Bronze as Parquet, so that plans show the checks alone."""
    base = tmp_path_factory.mktemp("bronze")
    for name in ("customers", "accounts", "transactions", "cards"):
        write_table(lake_over(spark, SMALL).bronze(name), f"{base}/{name}")
    return lambda name: spark.read.parquet(f"{base}/{name}")


@pytest.mark.parametrize("kind", ["long", "string"])
def test_sieve_lets_every_match_through(spark, kind):
    keys = spark.range(0, 4_000, 7).select(F.col("id").cast(kind).alias("key")).unionByName(spark.createDataFrame([(None,)], f"key {kind}"))
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 50 != 3, F.col("id").cast(kind)).alias("key"))
    sieve = Sieve(keys, "key")
    kept = sieve.kept(rows)
    matching = rows.join(keys, "key", "left_semi")
    assert kept.join(matching, "id", "left_semi").count() == matching.count() == 561
    assert kept.count() < 1.2 * matching.count() + 1_400 and kept.columns == rows.columns
    plan = executed(sieve.marked(rows, "maybe"))
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_sieve_of_no_keys(spark):
    assert Sieve(spark.range(0).select(F.col("id").alias("key")), "key").kept(spark.range(5).select(F.col("id").alias("key"))).count() == 0


def test_full_sieve_still_lets_all_matches_through(spark, monkeypatch):
    from ledgerline.operators import sieve

    monkeypatch.setattr(sieve, "MOST_BITS", 12)
    monkeypatch.setattr(sieve, "LEAST_BITS", 12)
    keys = spark.range(30_000).select(F.col("id").alias("key"))
    assert Sieve(keys, "key").kept(keys).count() == 30_000


def test_sparse_lookup_shuffles_possible_matches_only(spark, no_broadcast):
    rows = spark.range(50_000).select("id", (F.col("id") % 9_000).alias("key"))
    entries = spark.range(0, 9_000, 300).select(F.col("id").alias("key"), F.lit("x").alias("mark"))
    found = lookup(rows, entries, "key", sparse=True)
    assert found.count() == rows.join(entries, "key").count()
    plan = executed(found)
    assert plan.index("Exchange hashpartitioning") < plan.index("_sieve_words")  # the sieve lies below the shuffle


@pytest.mark.parametrize("name", ["transactions", "cards", "customers"])
def test_silver_beyond_the_budget_shuffles_possible_matches_only(spark, no_broadcast, written, name):
    bronze = written
    still, few = silver.checked_parts(name, bronze)
    plan = executed(still)
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan and plan.count("FileScan parquet") == 1
    below = executed(few).split("Exchange hashpartitioning", 1)[1]
    assert "_sieve_words" in below  # nothing but what the sieves let through is shuffled
    both = still.unionByName(few)
    assert Counter(map(repr, both.collect())) == Counter(map(repr, silver.checked(name, bronze).collect()))
    offending = both.where("quality_error LIKE 'DUPLICATE%' OR quality_error = 'INVALID_ACCOUNT_ID'").count()
    assert few.count() >= offending and few.count() < both.count()


@pytest.mark.parametrize("name", ["transactions", "cards"])
def test_single_checks_beyond_the_budget(spark, no_broadcast, written, name):
    """References and duplicates on their own: the same rows, and what is shuffled went through the sieve."""
    for check in (silver.checked_references, silver.checked_duplicates):
        found = check(name, written)
        assert executed(found).count("_sieve_words") >= 2 and "Union" in executed(found)
        spark.conf.set(BROADCAST_BUDGET_CONF, str(1 << 26))
        wanted = check(name, written)
        assert "Union" not in executed(wanted)
        assert Counter(map(repr, found.collect())) == Counter(map(repr, wanted.collect()))
        spark.conf.set(BROADCAST_BUDGET_CONF, "-1")


def test_silver_within_the_budget_is_one_part(spark):
    assert len(silver.checked_parts("transactions", lake_over(spark, SMALL).bronze)) == 1


def test_written_silver_is_the_same_either_way(spark, no_broadcast, folder):
    bronze = lake_over(spark, SMALL).bronze
    lake = Lake(spark, folder, bronze)
    for name in ("accounts", "loan_payments"):
        found = lake.silver(name).unionByName(lake.quarantine(name).select(lake.silver(name).columns))
        assert Counter(map(repr, found.collect())) == Counter(map(repr, silver.checked(name, bronze).select(found.columns).collect()))


def test_duplicate_rows_beyond_the_budget_shuffle_suspects_only(spark, no_broadcast, folder):
    rows = spark.range(3_000).selectExpr("id", "repeat('x', 50) AS body").unionByName(spark.range(5).selectExpr("id", "repeat('x', 50) AS body"))
    write_table(rows, folder)
    assert duplicate_rows(spark.read.parquet(folder)).first().duplicate_rows == 5


@pytest.mark.parametrize("values", [
    [-1e308, 1e308, 0.0, 3.0], [1.0, math.nextafter(1.0, 2), math.nextafter(math.nextafter(1.0, 2), 2)], [0.0, -0.0, 5e-324, 1e-320],
    np.random.default_rng(7).lognormal(3, 20, 4001).tolist(), [float(at) for at in range(30_000)],
])
def test_hard_quantiles(spark, values):
    rows = spark.createDataFrame([(value,) for value in values], "amount double").repartition(3)
    wanted = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    found = exact_quantiles(rows, "amount", wanted, [f"p{at}" for at in range(len(wanted))]).first()
    assert np.allclose(list(found), np.quantile(values, wanted))


def test_quantiles_of_odd_values(spark):
    """NaN comes last, as Spark orders it; infinities at the ends."""
    frame = lambda values: spark.createDataFrame([(value,) for value in values], "amount double")
    low, high = exact_quantiles(frame([float("nan"), 2.0, 1.0]), "amount", (0.5, 1.0), ("a", "b")).first()
    assert low == 2.0 and math.isnan(high)
    assert list(exact_quantiles(frame([float("inf"), 1.0, float("-inf")]), "amount", (0.0, 0.5, 1.0), ("a", "b", "c")).first()) == [
        float("-inf"), 1.0, float("inf")]
    assert list(exact_quantiles(frame([float("nan")]), "amount", (0.5,), ("a",)).first())[0] != 0


def test_quantiles_take_few_small_passes(spark, monkeypatch):
    """Thirty thousand values: three passes, none of which brings more than the steps of its spans to the driver."""
    sizes = []
    counted = quantiles._counted

    def seen(values, spans):
        rows = counted(values, spans)
        sizes.append((len(spans), len(rows)))
        return rows

    monkeypatch.setattr(quantiles, "_counted", seen)
    rows = spark.range(30_000).selectExpr("CAST(id AS DOUBLE) / 7 AS amount")
    exact_quantiles(rows, "amount", (0.25, 0.5, 0.75), ("a", "b", "c")).first()
    assert len(sizes) <= 3 and all(spans <= 6 and rows <= spans * (quantiles.BUCKETS + 3) for spans, rows in sizes)


@pytest.mark.parametrize("levels", [1, 4])
def test_membership_beyond_the_budget_shuffles_no_rows(spark, monkeypatch, levels):
    """Exact also where a sieve lets many others through, with NULL and repeated keys; the rows stay where they are."""
    if levels > 1:
        monkeypatch.setattr(sieve, "MOST_BITS", 14)
        monkeypatch.setattr(membership, "MOST_BITS", 14)
    spark.conf.set(BROADCAST_BUDGET_CONF, "4000")
    try:
        keys = spark.range(0, 30_000, 3).select(F.col("id").alias("key"))
        rows = spark.range(60_000).select("id", F.when(F.col("id") % 50 != 3, F.col("id") % 31_000).alias("key"))
        found = membership.Membership(keys, "key", rows)
        assert found.settled and len(found._levels) >= levels
        marked = found.marked(rows, "member")
        assert marked.where("member != coalesce(key < 30000 AND key % 3 = 0, false)").count() == 0 == marked.where("member IS NULL").count()
        assert marked.columns == ["id", "key", "member"] and marked.count() == 60_000
        assert found.kept(rows).count() + found.dropped(rows).count() == 60_000
        plan = executed(marked)
        assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset(BROADCAST_BUDGET_CONF)


@pytest.mark.parametrize("name", ["transactions", "cards"])
def test_silver_beyond_a_budget_shuffles_keys_alone(spark, written, name):
    wanted = Counter(map(repr, silver.checked(name, written).collect()))
    spark.conf.set(BROADCAST_BUDGET_CONF, "500")
    try:
        parts = silver.checked_parts(name, written)
        assert len(parts) == 1 and "_sieve_words" in executed(parts[0])
        assert "Exchange hashpartitioning" not in executed(parts[0]) and "SortMergeJoin" not in executed(parts[0])
        assert Counter(map(repr, parts[0].collect())) == wanted
    finally:
        spark.conf.unset(BROADCAST_BUDGET_CONF)
