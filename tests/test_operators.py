from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import lookup as lookups
from ledgerline.operators.checks import (
    ChecksFailed, column_tests, condition_check, key_check, reconcile, reference_check, require, totals,
)
from ledgerline.operators.copies import duplicate_rows
from ledgerline.operators.keys import matched_keys, repeated_keys, unmatched_keys
from ledgerline.operators.measures import (
    count_rows, count_where, max_of, mean_of, min_of, roll_up, sum_of, sum_where, summarise,
)
from ledgerline.operators.quantiles import exact_quantiles


def skewed(spark, rows=9000):
    """A third of the rows share key 1, some keys are NULL, the others are spread."""
    return spark.range(rows).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 50 != 7, F.col("id") % 400).alias("key"),
        (F.col("id") % 997 / 4).alias("amount"),
    )


def as_set(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("floor", [1, 500, 10**9])  # all keys hot, one key hot, none hot
def test_lookup_ways_agree(spark, no_broadcast, how, floor):
    rows = skewed(spark)
    entries = spark.range(0, 300).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value"))
    found = lookups.lookup(rows, entries, "key", how, floor)
    assert found.columns == ["id", "key", "amount", "value"]
    assert as_set(found) == as_set(rows.join(entries, "key", how).select("id", "key", "amount", "value"))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_beyond_the_budget_reads_its_rows_once(spark, no_broadcast, folder):
    """Two lookups in a row: one scan, and no union of hot and other rows."""
    skewed(spark).write.parquet(f"{folder}/rows")
    rows, shuffled = spark.read.parquet(f"{folder}/rows"), []
    for name in ("key", "id"):
        entries = spark.range(300).withColumnRenamed("id", name).withColumn(f"of_{name}", F.lit(1))
        rows = lookups.lookup(rows, entries, name, "left", 500, shuffled=shuffled)
    assert executed(rows).count("FileScan") == 1 and "Union" not in executed(rows) and shuffled == ["key", "id"]


def test_lookup_spreads_hot_and_missing_keys(spark, no_broadcast):
    rows = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 4 > 0, F.lit(1)).alias("key"))
    found = lookups.lookup(rows, spark.range(5).withColumnRenamed("id", "key"), "key", "left", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [len(part) for part in found.rdd.glom().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 20_000 and max(sizes) < 10_000


def test_column_tests_evaluate_their_rows_once(spark, folder):
    given = [(1, "a", None), (1, "b", "x"), (2, None, "x"), (None, "c", "x"), (None, "d", None)]
    spark.createDataFrame(given, "id long, name string, kind string").write.parquet(f"{folder}/rows")
    found = column_tests("m", spark.read.parquet(f"{folder}/rows"), ("id", "name", "kind"), ("id",))
    assert executed(found).count("FileScan") == 1
    assert {(row.column_name, row.test): (row.failures, row.status) for row in found.collect()} == {
        ("id", "not_null"): (2, "FAIL"), ("name", "not_null"): (1, "FAIL"), ("kind", "not_null"): (2, "FAIL"),
        ("id", "unique"): (1, "FAIL")}


def test_lookup_broadcasts_within_the_budget(spark):
    rows, entries = skewed(spark), spark.range(0, 300).withColumnRenamed("id", "key")
    plan = lookups.lookup(rows, entries, "key")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_only_large_keys_are_hot(spark):
    assert as_set(lookups.hot_keys(skewed(spark), "key", floor=500)) == [(1,)]


def test_measured_bytes_counts_text(spark):
    rows = spark.createDataFrame([(1, "abc"), (2, None)], "id long, name string")
    assert lookups.measured_bytes(rows) == 2 * (lookups.ROW_OVERHEAD + 8 + 8) + 3
    assert lookups.measured_bytes(rows.where("false")) == 0


def test_key_sets(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,), (None,)], "key long")
    parents = spark.createDataFrame([(2,), (2,), (None,)], "id long")
    assert as_set(repeated_keys(rows, "key")) == [(1, 2)]
    assert as_set(unmatched_keys(rows, "key", parents, "id")) == [(1, 2), (3, 1), (None, 2)]


@pytest.mark.parametrize("find", [unmatched_keys, matched_keys])
def test_rows_are_counted_before_they_meet_parents(spark, find):
    """Also where Spark would broadcast the parents and move a semi or anti join below the aggregation."""
    rows, parents = skewed(spark), spark.range(10)
    plan = find(rows, "key", parents, "id")._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    join = next(index for index, line in enumerate(lines) if line.startswith("Join"))
    assert not any(line.startswith("Aggregate") for line in lines[:join])
    assert sum(line.startswith("Aggregate") for line in lines[join:]) == 2


MEASURES = (
    count_rows("n"), count_where("big", "amount > 100"), sum_of("total", "amount"), mean_of("average", "amount"),
    sum_where("big_total", "amount", "amount > 100"), min_of("least", "amount"), max_of("most", "amount"),
)


def test_roll_up_equals_join_then_aggregate(spark):
    rows = skewed(spark)
    bridge = spark.range(0, 350).select(F.col("id").alias("key"), (F.col("id") % 7).alias("owner"))
    joined = rows.join(bridge, "key").groupBy("owner").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("amount") > 100, True)), F.sum("amount"), F.avg("amount"),
        F.sum(F.when(F.col("amount") > 100, F.col("amount")).otherwise(0)), F.min("amount"), F.max("amount"),
    )
    two_step = roll_up(rows, "key", bridge, ["owner"], MEASURES)
    left = pd.DataFrame(two_step.orderBy("owner").collect()).astype(float)
    right = pd.DataFrame(joined.orderBy("owner").collect()).astype(float)
    assert len(left) == 7 and np.allclose(left, right)


def test_mean_of_nothing_is_null(spark):
    rows = spark.createDataFrame([(1, None)], "key long, amount double")
    assert summarise(rows, ["key"], [mean_of("average", "amount")]).first().average is None


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], list(map(float, range(101))), [3.0] * 500 + [1.0, 9.0, 11.5],
    np.random.default_rng(7).lognormal(3, 2, 4001).round(2).tolist(),
])
def test_quantiles_are_exact(spark, values):
    rows = spark.createDataFrame([(value,) for value in values] + [(None,)], "amount double").repartition(3)
    probabilities = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)
    names = [f"p{index}" for index in range(len(probabilities))]
    found = exact_quantiles(rows, "amount", probabilities, names).first()
    assert np.allclose(list(found), np.quantile(values, probabilities))


def test_quantiles_of_nothing(spark):
    rows = spark.createDataFrame([], "amount double")
    assert list(exact_quantiles(rows, "amount", (0.5,), ("median",)).first()) == [None]


def test_duplicate_rows(spark):
    """(NULL, 1) and (1, NULL) share a hash but are different rows."""
    data = [(1, None), (None, 1), (1, None), (None, None), (None, None), (2, 2), (1, None)]
    rows = spark.createDataFrame(data, "a long, b long")
    assert rows.select(F.xxhash64("a", "b")).limit(2).distinct().count() == 1
    assert duplicate_rows(rows).first().duplicate_rows == int(pd.DataFrame(data).duplicated().sum()) == 3


def test_duplicate_rows_without_broadcast(spark, no_broadcast):
    rows = skewed(spark).select("key").unionByName(spark.range(5).select(F.lit(10**6).alias("key")))
    frame = pd.DataFrame(rows.collect())
    assert duplicate_rows(rows).first().duplicate_rows == int(frame.duplicated().sum())


def test_key_check_counts_null_once(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "a"), (2, None)], "id long, kind string")
    single = key_check("t", rows, ["id"]).first()
    assert (single.total, single.distinct_keys, single.duplicates, single.null_keys) == (5, 3, 2, 2)
    pair = key_check("t", rows, ["id", "kind"]).first()
    assert (pair.distinct_keys, pair.duplicates, pair.null_keys, pair.status) == (3, 2, 3, "FAIL")


def test_reference_check_counts_null_children(spark):
    rows = spark.createDataFrame([(1,), (2,), (2,), (None,)], "parent long")
    parents = spark.createDataFrame([(1,)], "id long")
    assert reference_check("r", "t", rows, "parent", parents, "id").first().actual == 3


def test_reconcile(spark):
    rows, empty = spark.range(3), spark.range(0)
    checks = {row.check: row for row in reconcile(
        "t",
        [totals(rows, "actual", {"n": "count(*)", "seen": "count(*)"}), totals(empty, "actual", {"sum": "sum(id)"})],
        [totals(rows, "expected", {"n": "count(*)"}), totals(empty, "expected", {"sum": "count(*)"})],
    ).collect()}
    assert checks["n"].status == "PASS" and checks["seen"].status == "INFO"
    assert checks["sum"].actual is None and checks["sum"].status == "FAIL"


def test_require_raises_on_failures(spark):
    rows = spark.range(3)
    require(condition_check("t", rows, {"negative": "id < 0"}))
    with pytest.raises(ChecksFailed, match="large"):
        require(condition_check("t", rows, {"negative": "id < 0", "large": "id > 1"}))
