"""Gold: five aggregate models over Silver, and the parts of the customer view.

Transactions, cards and payments are aggregated by their own key before they are joined to accounts, merchants or
loans, so no join ever sees more than one row per account, merchant or loan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.model import flat_schema
from ledgerline.operators.measures import (
    count_rows, count_where, gather, max_of, mean_of, min_of, roll_up, sum_of, sum_where, summarise,
)

Tables = Callable[[str], DataFrame]  # entity name -> its Silver rows


def _equals(column: str, value: str) -> str:
    return f"{column} = '{value}'"


def daily_transaction_summary(silver: Tables) -> DataFrame:
    """Count and amounts by day, type and status, in that order."""
    by = ("transaction_date", "transaction_type", "status")
    rows = silver("transactions").withColumn("transaction_date", F.to_date("transaction_timestamp"))
    measures = (
        count_rows("transaction_count"),
        sum_of("total_amount", "amount"),
        mean_of("average_amount", "amount"),
        min_of("minimum_amount", "amount"),
        max_of("maximum_amount", "amount"),
    )
    return summarise(rows, by, measures).orderBy(*by)


TRANSACTION_TOTALS = (
    sum_of("total_transaction_amount", "amount"),
    mean_of("average_transaction_amount", "amount"),
)
STATUS_COUNTS = tuple(
    count_where(f"{status.lower()}_transactions", _equals("status", status))
    for status in ("COMPLETED", "FAILED", "PENDING")
)


def customer_transaction_metrics(silver: Tables) -> DataFrame:
    """Customers with transactions: totals, counts by type and status, first and last transaction."""
    kinds = ("PIX", "CARD_PURCHASE", "TRANSFER", "DEPOSIT", "WITHDRAWAL")
    measures = (
        count_rows("transaction_count"),
        *TRANSACTION_TOTALS,
        *(count_where(f"{kind.lower()}_count", _equals("transaction_type", kind)) for kind in kinds),
        *STATUS_COUNTS,
        min_of("first_transaction_at", "transaction_timestamp"),
        max_of("last_transaction_at", "transaction_timestamp"),
    )
    per_customer = roll_up(silver("transactions"), "account_id", silver("accounts"), ["customer_id"], measures)
    segments = silver("customers").select("customer_id", "customer_segment")
    columns = ["customer_id", "customer_segment", *(measure.name for measure in measures)]
    return per_customer.join(segments, "customer_id").select(columns)


def merchant_performance(silver: Tables) -> DataFrame:
    """Merchants with transactions: totals, counts by status and the exact number of accounts that paid them."""
    merchant = ["merchant_id", "merchant_name", "merchant_category", "city", "state"]
    measures = (count_rows("transaction_count"), *TRANSACTION_TOTALS, *STATUS_COUNTS)
    collected = [column for measure in measures for column in measure.collected()]
    per_merchant = (
        silver("transactions")
        .where("merchant_id IS NOT NULL")
        .groupBy("merchant_id")
        .agg(*collected, F.count_distinct("account_id").alias("unique_accounts"))
    )
    return per_merchant.join(silver("merchants").select(merchant), "merchant_id").select(
        *merchant, *(measure.finished() for measure in measures), "unique_accounts"
    )


def top_merchants(performance: DataFrame, count: int = 10) -> DataFrame:
    return performance.orderBy(F.desc("total_transaction_amount"), "merchant_id").limit(count)


def loan_portfolio(silver: Tables) -> DataFrame:
    """Every loan with its payment counts, the amount paid and the amount left of the principal."""
    measures = (
        count_rows("total_payments"),
        *(count_where(f"{status.lower()}_payments", _equals("status", status)) for status in ("PAID", "PENDING", "LATE")),
        sum_where("total_paid_amount", "amount", _equals("status", "PAID")),
    )
    payments = summarise(silver("loan_payments"), ["loan_id"], measures)
    names = [measure.name for measure in measures]
    loans = silver("loans").withColumnRenamed("status", "loan_status")
    loan = ["loan_id", "customer_id", "loan_type", "principal_amount", "interest_rate", "term_months", "loan_status"]
    return (
        loans.join(payments, "loan_id", "left")
        .fillna(0, names)
        .withColumn("remaining_amount", F.col("principal_amount") - F.col("total_paid_amount"))
        .select(*loan, "created_at", *names, "remaining_amount")
    )


def status_counts(portfolio: DataFrame) -> DataFrame:
    return _counts(portfolio, "loan_status", "loan_count")


def segment_counts(customers: DataFrame) -> DataFrame:
    return _counts(customers, "customer_segment", "customer_count")


def _counts(rows: DataFrame, column: str, name: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


ACCOUNT_MEASURES = (count_rows("total_accounts"), count_where("active_accounts", _equals("status", "ACTIVE")))
TRANSACTION_MEASURES = (count_rows("total_transactions"), *TRANSACTION_TOTALS)
CARD_MEASURES = (count_rows("total_cards"), count_where("credit_cards", _equals("card_type", "CREDIT")))
LOAN_MEASURES = (
    count_rows("total_loans"),
    sum_of("total_loan_amount", "principal_amount"),
    count_where("active_loans", _equals("status", "ACTIVE")),
    count_where("defaulted_loans", _equals("status", "DEFAULTED")),
)
PAYMENT_MEASURES = (
    count_rows("total_loan_payments"),
    count_where("paid_payments", _equals("status", "PAID")),
    count_where("late_payments", _equals("status", "LATE")),
    sum_where("total_paid_amount", "amount", _equals("status", "PAID")),
)


def account_metrics(silver: Tables) -> DataFrame:
    return summarise(silver("accounts"), ["customer_id"], ACCOUNT_MEASURES)


def transaction_metrics(silver: Tables) -> DataFrame:
    return roll_up(silver("transactions"), "account_id", silver("accounts"), ["customer_id"], TRANSACTION_MEASURES)


def card_metrics(silver: Tables) -> DataFrame:
    return roll_up(silver("cards"), "account_id", silver("accounts"), ["customer_id"], CARD_MEASURES)


def loan_metrics(silver: Tables) -> DataFrame:
    return summarise(silver("loans"), ["customer_id"], LOAN_MEASURES)


def payment_metrics(silver: Tables) -> DataFrame:
    return roll_up(silver("loan_payments"), "loan_id", silver("loans"), ["customer_id"], PAYMENT_MEASURES)


CUSTOMER_PARTS = (account_metrics, transaction_metrics, card_metrics, loan_metrics, payment_metrics)


def customer_360(silver: Tables) -> DataFrame:
    """Every customer with the account, transaction, card, loan and payment metrics, zero where there are none.

    Accounts and loans are read once each: transactions and cards meet accounts, payments meet loans, one row a key.
    """
    held = gather(
        silver("accounts").select("account_id", "customer_id", "status"), "account_id", ["customer_id"], ACCOUNT_MEASURES,
        [(silver("transactions"), TRANSACTION_MEASURES), (silver("cards"), CARD_MEASURES)])
    borrowed = gather(
        silver("loans").select("loan_id", "customer_id", "principal_amount", "status"), "loan_id", ["customer_id"],
        LOAN_MEASURES, [(silver("loan_payments"), PAYMENT_MEASURES)])
    customers = silver("customers").select("customer_id", "customer_segment")
    result = customers.join(held, "customer_id", "left").join(borrowed, "customer_id", "left")
    return result.fillna(0, [name for name in result.columns if name not in customers.columns])


MODELS: dict[str, Callable[[Tables], DataFrame]] = {
    "daily_transaction_summary": daily_transaction_summary,
    "customer_transaction_metrics": customer_transaction_metrics,
    "merchant_performance": merchant_performance,
    "loan_portfolio": loan_portfolio,
    "customer_360": customer_360,
}
LAYOUTS = {"daily_transaction_summary": ("transaction_date",)}
FOLDER_TASKS = 32  # a day of the summary is one row per type and status, so no task can get too many rows


SCHEMAS: dict[str, T.StructType] = {
    "daily_transaction_summary": flat_schema(
        "transaction_type string, status string, transaction_count long, total_amount double, average_amount double, "
        "minimum_amount double, maximum_amount double, transaction_date date"
    ),
    "customer_transaction_metrics": flat_schema(
        "customer_id long, customer_segment string, transaction_count long, total_transaction_amount double, "
        "average_transaction_amount double, pix_count long, card_purchase_count long, transfer_count long, "
        "deposit_count long, withdrawal_count long, completed_transactions long, failed_transactions long, "
        "pending_transactions long, first_transaction_at timestamp_ntz, last_transaction_at timestamp_ntz"
    ),
    "merchant_performance": flat_schema(
        "merchant_id long, merchant_name string, merchant_category string, city string, state string, "
        "transaction_count long, total_transaction_amount double, average_transaction_amount double, "
        "completed_transactions long, failed_transactions long, pending_transactions long, unique_accounts long"
    ),
    "loan_portfolio": flat_schema(
        "loan_id long, customer_id long, loan_type string, principal_amount double, interest_rate double, "
        "term_months long, loan_status string, created_at timestamp_ntz, total_payments long, paid_payments long, "
        "pending_payments long, late_payments long, total_paid_amount double, remaining_amount double"
    ),
    "customer_360": flat_schema(
        "customer_id long, customer_segment string, total_accounts long, active_accounts long, "
        "total_transactions long, total_transaction_amount double, average_transaction_amount double, "
        "total_cards long, credit_cards long, total_loans long, total_loan_amount double, active_loans long, "
        "defaulted_loans long, total_loan_payments long, paid_payments long, late_payments long, "
        "total_paid_amount double"
    ),
}
