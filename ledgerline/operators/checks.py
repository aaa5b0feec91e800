"""Checks that return rows instead of printing: keys, references, conditions and reconciliations.

Each table is read once per check function, however many conditions it is checked for. Nothing but counts leaves the
executors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.keys import repeated_keys, unmatched_keys


class ChecksFailed(PySparkException):
    """Raised by `require` when a check row says FAIL."""


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_check(dataset: str, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Total, distinct, duplicate and NULL keys. As with DISTINCT, NULL counts as one value."""
    any_null = reduce(lambda left, right: left | right, (F.col(name).isNull() for name in key))
    counts = rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(F.struct(*key)).alias("distinct_keys"),
        F.count_if(any_null).alias("null_keys"),
    )
    duplicates = F.col("total") - F.col("distinct_keys")
    passed = (duplicates == 0) & (F.col("null_keys") == 0)
    return counts.select(
        F.lit(dataset).alias("dataset"),
        F.lit(",".join(key)).alias("key_columns"),
        "total",
        "distinct_keys",
        duplicates.alias("duplicates"),
        "null_keys",
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
    )


def _verdict(counts: DataFrame, scope: str) -> DataFrame:
    """(check, actual, expected) with scope and status; a check without an expectation is informative."""
    status = F.when(F.col("expected").isNull(), "INFO").when(F.col("actual") == F.col("expected"), "PASS")
    return counts.select(
        "check", F.lit(scope).alias("scope"), "actual", "expected", status.otherwise("FAIL").alias("status")
    )


def reference_check(
    check: str, scope: str, rows: DataFrame, key: str, parents: DataFrame, parent_key: str
) -> DataFrame:
    """Rows whose key, NULL included, has no parent."""
    orphans = unmatched_keys(rows, key, parents, parent_key)
    counts = orphans.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("actual"))
    return _verdict(counts.select(F.lit(check).alias("check"), "actual", F.lit(0).cast("long").alias("expected")), scope)


def condition_check(scope: str, rows: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Number of rows for which each condition (SQL) is true, none being expected. One pass for all conditions."""
    counts = rows.agg(*(F.count_if(F.expr(text)).alias(name) for name, text in conditions.items()))
    listed = counts.unpivot([], list(conditions), "check", "actual")
    return _verdict(listed.withColumn("expected", F.lit(0).cast("long")), scope)


def totals(rows: DataFrame, side: str, measures: Mapping[str, str]) -> DataFrame:
    """(check, side, value) for several SQL aggregates of one table."""
    values = rows.agg(*(F.expr(text).cast("long").alias(name) for name, text in measures.items()))
    return values.unpivot([], list(measures), "check", "value").withColumn("side", F.lit(side))


def reconcile(scope: str, actual: Sequence[DataFrame], expected: Sequence[DataFrame]) -> DataFrame:
    """Put totals of the two sides next to each other by check name; one row per check."""
    rows = stack([*actual, *expected])
    sides = rows.groupBy("check").agg(
        F.max(F.when(F.col("side") == "actual", F.col("value"))).alias("actual"),
        F.max(F.when(F.col("side") == "expected", F.col("value"))).alias("expected"),
        F.count_if(F.col("side") == "expected").alias("has_expected"),
    )
    # An empty side sums to NULL, which is a mismatch and not a missing expectation.
    status = F.when(F.col("has_expected") == 0, "INFO").when(F.col("actual") == F.col("expected"), "PASS")
    return sides.select(
        "check", F.lit(scope).alias("scope"), "actual", "expected", status.otherwise("FAIL").alias("status")
    )


def column_tests(model: str, rows: DataFrame, not_null: Sequence[str], unique: Sequence[str]) -> DataFrame:
    """Declarative column tests: rows with NULL, and values (NULL left out) that occur more than once.

    One evaluation of `rows`: grouped by the first unique column, which counts its repeats and, per value, the NULLs of
    the others; the totals over the groups are the results. Further unique columns take one evaluation each.
    """
    empty = {name: F.count_if(F.col(name).isNull()).cast("long") for name in not_null}
    if unique:
        key = unique[0]
        grouped = rows.groupBy(F.col(key).alias("_key")).agg(
            F.count(F.lit(1)).alias("_copies"), *(count.alias(f"_{name}") for name, count in empty.items() if name != key))
        tests = {("not_null", name): F.sum(f"_{name}") for name in not_null if name != key}
        if key in not_null:
            tests["not_null", key] = F.sum(F.when(F.col("_key").isNull(), F.col("_copies")))
        tests["unique", key] = F.sum((F.col("_key").isNotNull() & (F.col("_copies") > 1)).cast("long"))
    else:
        grouped, tests = rows, {("not_null", name): count for name, count in empty.items()}
    counts = grouped.agg(*(F.coalesce(value, F.lit(0)).alias(f"{test} {name}") for (test, name), value in tests.items()))
    listed = counts.unpivot([], counts.columns, "what", "failures").select(
        F.substring_index("what", " ", -1).alias("column_name"), "failures", F.substring_index("what", " ", 1).alias("test"))
    results = [listed]
    for name in unique[1:]:
        repeated = repeated_keys(rows, name).agg(F.count(F.lit(1)).alias("failures"))
        results.append(repeated.select(F.lit(name).alias("column_name"), "failures", F.lit("unique").alias("test")))
    return stack(results).select(
        F.lit(model).alias("model"), "column_name", "test", "failures",
        F.when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("status"),
    )


def require(checks: DataFrame) -> None:
    """Raise if any check failed; only failed check rows, one per check at most, come to the driver."""
    failed = checks.where("status = 'FAIL'").collect()
    if failed:
        raise ChecksFailed("; ".join(str(row.asDict()) for row in failed))


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """Rows per value of a text column, most frequent first."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), "value")
