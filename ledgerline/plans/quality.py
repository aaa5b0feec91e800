"""Quality assurance of Silver and Gold, and the declarative column tests of the SQL models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rules import outside
from ledgerline.model import ENTITIES, TRANSACTION_STATUSES, TRANSACTION_TYPES
from ledgerline.operators.checks import (
    column_tests, condition_check, key_check, reconcile, reference_check, stack, totals, value_counts,
)
from ledgerline.operators.keys import key_counts

Tables = Callable[[str], DataFrame]

DISTRIBUTIONS = (
    ("transactions", "transaction_type"), ("transactions", "status"), ("transactions", "currency"),
    ("cards", "card_type"), ("cards", "status"), ("cards", "brand"),
    ("loans", "loan_type"), ("loans", "status"), ("loan_payments", "status"),
)


def primary_keys(tables: Tables) -> DataFrame:
    return stack([key_check(name, tables(name), [entity.key]) for name, entity in ENTITIES.items()])


def row_counts(tables: Tables, quarantine: Tables) -> DataFrame:
    """Total, valid and quarantined rows per entity."""
    parts = []
    for name in ENTITIES:
        for rows, column in ((tables(name), "valid_rows"), (quarantine(name), "invalid_rows")):
            other = "invalid_rows" if column == "valid_rows" else "valid_rows"
            count = rows.agg(F.count(F.lit(1)).alias(column))
            parts.append(count.select(F.lit(name).alias("entity"), column, F.lit(0).cast("long").alias(other)))
    summed = stack(parts).groupBy("entity").agg(
        F.sum("valid_rows").alias("valid_rows"), F.sum("invalid_rows").alias("invalid_rows")
    )
    return summed.select("entity", (F.col("valid_rows") + F.col("invalid_rows")).alias("total_rows"),
                         "valid_rows", "invalid_rows")


REFERENCES = (
    ("accounts", "customer_id", "customers"),
    ("transactions", "account_id", "accounts"),
    ("transactions", "merchant_id", "merchants"),
    ("cards", "account_id", "accounts"),
    ("loans", "customer_id", "customers"),
    ("loan_payments", "loan_id", "loans"),
)


def _references(tables: Tables, optional: tuple[str, ...]) -> DataFrame:
    """Every reference checked against its parent; optional ones only where they are set."""
    results = []
    for child, column, parent in REFERENCES:
        rows = tables(child)
        if column in optional:
            rows = rows.where(F.col(column).isNotNull())
        parent_key = ENTITIES[parent].key
        results.append(reference_check(f"{child}_{column}", child, rows, column, tables(parent), parent_key))
    return stack(results)


def silver_references(silver: Tables) -> DataFrame:
    """Silver rows whose reference has no Silver parent."""
    return _references(silver, optional=("merchant_id",))


def raw_references(raw: Tables) -> DataFrame:
    """The same on raw data, where a missing merchant counts as invalid too."""
    return _references(raw, optional=())


def business_rules(silver: Tables) -> DataFrame:
    credit = key_counts(silver("cards").where("card_type = 'CREDIT' AND account_id IS NOT NULL"), "account_id")
    savings = silver("accounts").where("account_type = 'SAVINGS'").select("account_id")
    on_savings = credit.join(savings, "account_id").agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"))
    return stack([
        reconcile(
            "cards",
            [totals(on_savings, "actual", {"savings_with_credit_card": "max(n)"})],
            [totals(on_savings, "expected", {"savings_with_credit_card": "max(0)"})],
        ),
        condition_check("transactions", silver("transactions"), {
            "invalid_transaction_type": outside("transaction_type", TRANSACTION_TYPES),
            "invalid_transaction_status": outside("status", TRANSACTION_STATUSES),
            "card_purchase_without_merchant": "transaction_type = 'CARD_PURCHASE' AND merchant_id IS NULL",
        }),
        condition_check("cards", silver("cards"), {
            "credit_limit_violation": (
                "(card_type = 'CREDIT' AND credit_limit IS NULL) OR (card_type = 'DEBIT' AND credit_limit IS NOT NULL)"
            ),
        }),
        condition_check("loan_payments", silver("loan_payments"), {
            "paid_without_date": "status = 'PAID' AND payment_date IS NULL",
            "pending_with_date": "status = 'PENDING' AND payment_date IS NOT NULL",
        }),
    ])


def distribution(silver: Tables, entity: str, column: str) -> DataFrame:
    return value_counts(silver(entity), column)


def transaction_stats(silver: Tables) -> DataFrame:
    return silver("transactions").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_amount"), F.min("amount").alias("minimum_amount"),
        F.max("amount").alias("maximum_amount"),
    )


def loan_stats(silver: Tables) -> DataFrame:
    return silver("loans").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("principal_amount").alias("total_principal"),
        F.avg("principal_amount").alias("average_principal"), F.avg("interest_rate").alias("average_interest_rate"),
    )


def payment_stats(silver: Tables) -> DataFrame:
    return silver("loan_payments").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("amount").alias("total_amount"),
        F.avg("amount").alias("average_amount"),
    )


def null_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counts = rows.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return counts.unpivot([], columns, "column_name", "null_count")


def gold_daily_key(gold: Tables) -> DataFrame:
    name = "daily_transaction_summary"
    return key_check(name, gold(name), ["transaction_date", "transaction_type", "status"])


def gold_keys(gold: Tables) -> DataFrame:
    keys = {
        "customer_transaction_metrics": "customer_id", "merchant_performance": "merchant_id",
        "loan_portfolio": "loan_id", "customer_360": "customer_id",
    }
    return stack([key_check(name, gold(name), [key]) for name, key in keys.items()])


ROWS = "count(*)"


def _expect_none(*checks: str) -> dict[str, str]:
    """Aggregates that are zero on any table, for counts that should be zero."""
    return {check: "count_if(false)" for check in checks}


def daily_reconciliation(silver: Tables, gold: Tables) -> DataFrame:
    scope = "daily_transaction_summary"
    return reconcile(
        scope,
        [totals(gold(scope), "actual", {
            "transactions": "sum(transaction_count)", "invalid_total_amount": "count_if(total_amount <= 0)",
        })],
        [totals(silver("transactions"), "expected", {"transactions": ROWS, **_expect_none("invalid_total_amount")})],
    )


NEGATIVE_TRANSACTIONS = "count_if(transaction_count < 0 OR total_transaction_amount < 0)"


def customer_transaction_reconciliation(silver: Tables, gold: Tables) -> DataFrame:
    scope = "customer_transaction_metrics"
    return reconcile(
        scope,
        [totals(gold(scope), "actual", {
            "transactions": "sum(transaction_count)", "customers_with_transactions": ROWS,
            "negative_metrics": NEGATIVE_TRANSACTIONS,
        })],
        [totals(silver("transactions"), "expected", {"transactions": ROWS, **_expect_none("negative_metrics")})],
    )


def merchant_reconciliation(silver: Tables, gold: Tables) -> DataFrame:
    scope = "merchant_performance"
    return reconcile(
        scope,
        [totals(gold(scope), "actual", {
            "merchant_transactions": "sum(transaction_count)", "negative_metrics": NEGATIVE_TRANSACTIONS,
        })],
        [totals(silver("transactions"), "expected", {
            "merchant_transactions": "count(merchant_id)", **_expect_none("negative_metrics"),
        })],
    )


def loan_reconciliation(silver: Tables, gold: Tables) -> DataFrame:
    scope = "loan_portfolio"
    return reconcile(
        scope,
        [totals(gold(scope), "actual", {
            "loans": ROWS, "payments": "sum(total_payments)", "negative_remaining": "count_if(remaining_amount < 0)",
        })],
        [
            totals(silver("loans"), "expected", {"loans": ROWS, **_expect_none("negative_remaining")}),
            totals(silver("loan_payments"), "expected", {"payments": ROWS}),
        ],
    )


def customer_360_reconciliation(silver: Tables, gold: Tables) -> DataFrame:
    scope = "customer_360"
    parts = ("accounts", "transactions", "cards", "loans")
    negative = " OR ".join(f"total_{part} < 0" for part in (*parts, "loan_payments"))
    return reconcile(
        scope,
        [totals(gold(scope), "actual", {
            "customers": ROWS, **{part: f"sum(total_{part})" for part in parts},
            "negative_metrics": f"count_if({negative})",
        })],
        [
            totals(silver("customers"), "expected", {"customers": ROWS, **_expect_none("negative_metrics")}),
            *(totals(silver(part), "expected", {part: ROWS}) for part in parts),
        ],
    )


RECONCILIATIONS = {
    "recon_daily": daily_reconciliation,
    "recon_customer_tx": customer_transaction_reconciliation,
    "recon_merchant": merchant_reconciliation,
    "recon_loan": loan_reconciliation,
    "recon_c360": customer_360_reconciliation,
}

# model -> (columns that must not be NULL, columns that must be unique)
COLUMN_TESTS: dict[str, dict[str, tuple[tuple[str, ...], tuple[str, ...]]]] = {
    "dt_staging": {"stg_customers": (("customer_id", "customer_segment"), ("customer_id",))},
    "dt_intermediate": {
        "int_customer_transactions": (("transaction_id", "customer_id"), ("transaction_id",)),
        "int_merchant_transactions": (("transaction_id", "merchant_id"), ("transaction_id",)),
        "int_loan_payments": (("payment_id", "loan_id"), ("payment_id",)),
        "int_customer_loans": (("customer_id",), ("customer_id",)),
    },
    "dt_marts": {
        "fct_daily_transactions": (("transaction_date", "transaction_type", "status"), ()),
        "fct_merchant_performance": (("merchant_id", "merchant_name"), ("merchant_id",)),
        "fct_loan_portfolio": (("loan_id", "customer_id"), ("loan_id",)),
        "fct_customer_transactions": (("customer_id",), ("customer_id",)),
        "customer_360_mart": (("customer_id",), ("customer_id",)),
    },
}


def data_tests(layer: str, models: Tables) -> DataFrame:
    return stack([
        column_tests(name, models(name), not_null, unique) for name, (not_null, unique) in COLUMN_TESTS[layer].items()
    ])
