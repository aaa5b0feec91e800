"""Reconciliation by row, the best of each group, and all failures of a row with their frequent combinations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rules import RULES
from ledgerline.model import ENTITIES
from ledgerline.operators.checks import stack
from ledgerline.operators.differences import changed_rows, multiset_difference
from ledgerline.operators.itemsets import frequent_itemsets
from ledgerline.operators.ranking import best_of_groups
from ledgerline.plans import gold
from ledgerline.plans import silver as checks

Tables = Callable[[str], DataFrame]

FIGURES = ("customer_id", "customer_segment", "transaction_count", "total_transaction_amount")


def unchecked_customer_metrics(bronze: Tables) -> DataFrame:
    """The customers' transaction metrics as they would be without any check: over normalised Bronze rows."""
    return gold.customer_transaction_metrics(lambda name: checks.normalised(name, bronze)).select(*FIGURES)


def customer_row_differences(checked: DataFrame, unchecked: DataFrame) -> DataFrame:
    """Rows of either of two customer tables that the other one does not have as often, with their surplus."""
    return multiset_difference(checked.select(*FIGURES), unchecked.select(*FIGURES))


def customer_reconciliation(checked: DataFrame, unchecked: DataFrame) -> DataFrame:
    """The customers whose figures differ between the two tables, and in which columns: what the checks have cost whom."""
    return changed_rows(checked.select(*FIGURES), unchecked.select(*FIGURES), ["customer_id"])


def bronze_silver_differences(name: str, bronze: Tables, silver: Tables) -> DataFrame:
    """Rows that Silver does not hold as often as the normalised Bronze does, by row: what the quarantine should explain."""
    columns = ENTITIES[name].bronze_schema.names
    return multiset_difference(checks.normalised(name, bronze).select(columns), silver(name).select(columns))


def top_merchants_by_state_and_month(silver: Tables, count: int = 3) -> DataFrame:
    """The merchants with most sales in each state and month, with their share of it in basis points.

    Sales are added by merchant and month first, so the ranking sees one row for each, whatever a merchant sells.
    """
    cents = F.rint(F.col("amount") * 100).cast("long")
    sold = silver("transactions").where("merchant_id IS NOT NULL").groupBy("merchant_id", "year", "month").agg(
        F.sum(cents).alias("sales_cents"), F.count(F.lit(1)).alias("transaction_count"))
    placed = sold.join(silver("merchants").select("merchant_id", "merchant_name", "state"), "merchant_id")
    best = best_of_groups(placed, ["state", "year", "month"], [F.desc("sales_cents"), F.asc("merchant_id")], count)
    whole = placed.groupBy("state", "year", "month").agg(F.sum("sales_cents").alias("all_cents"))
    return best.join(whole, ["state", "year", "month"]).select(
        "state", "year", "month", "rank", "merchant_id", "merchant_name", "transaction_count", "sales_cents",
        F.expr("(sales_cents * 10000) div all_cents").alias("share_basis_points"))


def failures(name: str, tables: Tables) -> DataFrame:
    """Rows with `failures`: every code that applies, in the order of the checks, not only the first one."""
    rows, references = checks.mark_references(name, checks.normalised(name, tables), tables)
    rows, duplicate = checks.mark_duplicates(name, rows, tables)
    own = [F.when(F.expr(rule.fails), F.lit(rule.code)) for rule in RULES[name]]
    found = F.array_distinct(F.array_compact(F.array(*own, *references, duplicate)))
    return rows.withColumn("failures", found).select(*ENTITIES[name].bronze_schema.names, "failures")


def failure_rows(name: str, tables: Tables) -> DataFrame:
    """(key, failures, failure_count) of the rows that fail, codes joined in the order of the checks."""
    return failures(name, tables).where(F.size("failures") > 0).select(
        ENTITIES[name].key, F.array_join("failures", ",").alias("failures"), F.size("failures").cast("long").alias("failure_count"))


def failure_combinations(tables: Tables, least: int = 2, longest: int = 3) -> DataFrame:
    """Codes that occur together in at least `least` rows of an entity, up to `longest` of them."""
    return stack([
        frequent_itemsets(failures(name, tables), "failures", least, longest).select(
            F.lit(name).alias("entity"), F.array_join("itemset", ",").alias("codes"), F.size("itemset").cast("long").alias("size"),
            F.col("support").alias("row_count"))
        for name in ENTITIES
    ])
