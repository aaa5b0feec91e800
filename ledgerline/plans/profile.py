"""Profile of the raw tables: columns, duplicates, keys, references, distributions and outliers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.model import ENTITIES
from ledgerline.operators.checks import key_check, reconcile, stack, totals, value_counts
from ledgerline.operators.copies import duplicate_rows
from ledgerline.operators.keys import unmatched_keys
from ledgerline.operators.quantiles import exact_quantiles

Tables = Callable[[str], DataFrame]


def columns(raw: Tables) -> DataFrame:
    """Per column: type, NULL count and NULL share in percent; one pass per table."""
    results = []
    for name in ENTITIES:
        rows = raw(name)
        counts = rows.agg(
            F.count(F.lit(1)).alias("row_count"),
            *(F.count_if(F.col(field.name).isNull()).alias(field.name) for field in rows.schema.fields),
        )
        listed = counts.unpivot(["row_count"], rows.columns, "column_name", "null_count")
        types = F.create_map(*(F.lit(text) for pair in rows.dtypes for text in pair))
        results.append(listed.select(
            F.lit(name).alias("entity"), "column_name", types[F.col("column_name")].alias("data_type"),
            "row_count", F.lit(len(rows.columns)).cast("long").alias("column_count"), "null_count",
            F.try_divide(F.col("null_count") * 100, F.col("row_count")).alias("null_percent"),
        ))
    return stack(results)


def duplicates(raw: Tables) -> DataFrame:
    """Rows that repeat an earlier row in every column."""
    return stack([
        duplicate_rows(raw(name)).select(F.lit(name).alias("entity"), "duplicate_rows") for name in ENTITIES
    ])


def primary_keys(raw: Tables) -> DataFrame:
    return stack([key_check(name, raw(name), [entity.key]) for name, entity in ENTITIES.items()])


def _described(rows: DataFrame, column: str) -> DataFrame:
    """(section, item, value): count, mean, standard deviation, extremes, quartiles and total."""
    moments = rows.agg(
        F.count(column).cast("double").alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"), F.max(column).alias("max"), F.sum(column).alias("total"),
    )
    quartiles = exact_quantiles(rows, column, (0.25, 0.5, 0.75), ("q25", "q50", "q75"))
    return stack([
        frame.unpivot([], frame.columns, "item", "value").select(F.lit(column).alias("section"), "item", "value")
        for frame in (moments, quartiles)
    ])


def _counted(rows: DataFrame, column: str) -> DataFrame:
    counts = value_counts(rows.where(F.col(column).isNotNull()), column)
    return counts.select(F.lit(column).alias("section"), F.col("value").alias("item"),
                         F.col("row_count").cast("double").alias("value"))


def transactions(raw: Tables) -> DataFrame:
    rows = raw("transactions")
    return stack([_counted(rows, "transaction_type"), _counted(rows, "status"), _described(rows, "amount")])


def loans(raw: Tables) -> DataFrame:
    rows = raw("loans")
    return stack([_counted(rows, "loan_type"), _counted(rows, "status"), _described(rows, "principal_amount")])


def card_merchants(raw: Tables) -> DataFrame:
    """Card purchases: all, without merchant, and with a merchant (or none) that does not exist."""
    purchases = raw("transactions").where("transaction_type = 'CARD_PURCHASE'")
    unknown = unmatched_keys(purchases, "merchant_id", raw("merchants"), "merchant_id")
    scope = "transactions"
    return reconcile(
        scope,
        [
            totals(purchases, "actual", {
                "card_purchases": "count(*)", "missing_merchant": "count_if(merchant_id IS NULL)",
            }),
            totals(unknown, "actual", {"invalid_merchant": "coalesce(sum(copies), 0)"}),
        ],
        [totals(purchases, "expected", {
            "missing_merchant": "count_if(false)", "invalid_merchant": "count_if(false)",
        })],
    )


def outliers(raw: Tables) -> DataFrame:
    """Amounts above the third quartile plus one and a half interquartile ranges."""
    rows = raw("transactions")
    quartiles = exact_quantiles(rows, "amount", (0.25, 0.75), ("q1", "q3"))
    limits = quartiles.withColumn("upper_limit", F.expr("q3 + 1.5D * (q3 - q1)")).first()  # three numbers
    upper = F.lit(limits["upper_limit"]).cast("double")
    return rows.agg(F.count_if(F.col("amount") > upper).alias("outliers")).select(
        *(F.lit(limits[name]).cast("double").alias(name) for name in ("q1", "q3", "upper_limit")), "outliers"
    )
