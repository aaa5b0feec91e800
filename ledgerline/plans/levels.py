"""Distinct accounts at all levels of merchant, day and segment, and sketches of transactions by day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.cubes import DENSE, distinct_counts, levels_of
from ledgerline.operators.lookup import lookup
from ledgerline.operators.sketches import daily, in_bounds, merged
from ledgerline.session import materialise

Tables = Callable[[str], DataFrame]

QUANTILES = (0.1, 0.5, 0.9)


def _merchant_sales(silver: Tables) -> DataFrame:
    """(merchant_id, transaction_date, customer_segment, account_id) of merchant transactions whose account is known."""
    sales = silver("transactions").where("merchant_id IS NOT NULL").select(
        "merchant_id", F.to_date("transaction_timestamp").alias("transaction_date"), "account_id").distinct()
    owners = silver("accounts").select("account_id", "customer_id")
    segments = silver("customers").select("customer_id", "customer_segment")
    return lookup(sales, lookup(owners, segments, "customer_id").select("account_id", "customer_segment"), "account_id")


DIMENSIONS = ("merchant_id", "transaction_date", "customer_segment")


def account_cube(silver: Tables, dense: int = DENSE) -> DataFrame:
    """Distinct accounts that paid merchants, for every combination of merchant, day and customer segment."""
    return distinct_counts(_merchant_sales(silver), DIMENSIONS, "account_id", levels_of(DIMENSIONS), "accounts", dense)


def account_rollup(silver: Tables, dense: int = DENSE) -> DataFrame:
    """The same from customer segment over day to merchant."""
    order = DIMENSIONS[::-1]
    return distinct_counts(_merchant_sales(silver), order, "account_id", levels_of(order, "rollup"), "accounts", dense)


def sketch_checks(silver: Tables) -> DataFrame:
    """By transaction type and month: exact transactions and accounts, and whether the daily sketches, merged, agree."""
    rows = silver("transactions").select(
        "transaction_type", "year", "month", F.to_date("transaction_timestamp").alias("day"), "account_id", "amount")
    by = ("transaction_type", "year", "month")
    summaries = materialise(daily(rows, (*by, "day"), "account_id", "amount"))
    answers = materialise(merged(summaries, by, QUANTILES))
    return in_bounds(rows, answers, by, "account_id", "amount", QUANTILES)
