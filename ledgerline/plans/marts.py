"""SQL models over Silver: staging projections, intermediate joins and marts.

Each model names the models it reads in braces. Marts aggregate payments and transactions by their own key before the
join, as the Gold plans do; the row-level joins go through `lookup`, which stays safe when one account, merchant or
loan holds a large share of the rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.model import ENTITIES
from ledgerline.operators.lookup import lookup
from ledgerline.session import materialise
from ledgerline.sources.files import scan, write_table

Tables = Callable[[str], DataFrame]

STAGING = {
    f"stg_{name}": f"SELECT {', '.join(entity.columns.names)} FROM {{{name}}}" for name, entity in ENTITIES.items()
}


def int_customer_transactions(model: Tables) -> DataFrame:
    segments = model("stg_customers").select("customer_id", "customer_segment")
    owners = materialise(lookup(model("stg_accounts").select("account_id", "customer_id"), segments, "customer_id"))
    return lookup(model("stg_transactions"), owners, "account_id").select(
        "transaction_id", "account_id", "customer_id", "customer_segment", "transaction_type", "amount", "currency",
        "status", "transaction_timestamp", "merchant_id", "description",
    )


def int_merchant_transactions(model: Tables) -> DataFrame:
    merchants = model("stg_merchants").select(
        "merchant_id", "merchant_name", "merchant_category",
        F.col("city").alias("merchant_city"), F.col("state").alias("merchant_state"),
    )
    paid = model("stg_transactions").where("merchant_id IS NOT NULL").drop("description")
    return lookup(paid, merchants, "merchant_id").select(
        "transaction_id", "account_id", *merchants.columns, "transaction_type", "amount", "currency", "status",
        "transaction_timestamp",
    )


def int_loan_payments(model: Tables) -> DataFrame:
    loans = model("stg_loans").drop("created_at").withColumnRenamed("status", "loan_status")
    payments = model("stg_loan_payments").withColumnsRenamed({"amount": "payment_amount", "status": "payment_status"})
    return lookup(payments, loans, "loan_id").select(
        "payment_id", *loans.columns, "payment_number", "due_date", "payment_date", "payment_amount", "payment_status",
    )


ROW_JOINS: dict[str, Callable[[Tables], DataFrame]] = {
    "int_customer_transactions": int_customer_transactions,
    "int_merchant_transactions": int_merchant_transactions,
    "int_loan_payments": int_loan_payments,
}

_ACCOUNT_TOTALS = """
  SELECT account_id, count(*) AS n, sum(amount) AS amount, count(amount) AS amounts,
         min(amount) AS smallest, max(amount) AS largest,
         count_if(status = 'COMPLETED') AS completed, count_if(status = 'FAILED') AS failed,
         count_if(status = 'PENDING') AS pending, count_if(status = 'CANCELLED') AS cancelled
  FROM {stg_transactions} GROUP BY account_id
"""

MARTS = {
    "int_customer_loans": """
WITH by_loan AS (
  SELECT loan_id, count(payment_id) AS n, count_if(status = 'PAID') AS paid, count_if(status = 'LATE') AS late,
         sum(amount) FILTER (WHERE status = 'PAID') AS paid_amount
  FROM {stg_loan_payments} GROUP BY loan_id
), borrowed AS (
  SELECT customer_id, count(DISTINCT loan_id) AS loans, sum(principal_amount) AS principal,
         count_if(status = 'ACTIVE') AS active, count_if(status = 'DEFAULTED') AS defaulted,
         sum(n) AS n, sum(paid) AS paid, sum(late) AS late, sum(paid_amount) AS paid_amount
  FROM {stg_loans} LEFT JOIN by_loan USING (loan_id) GROUP BY customer_id
)
SELECT customer_id, customer_segment,
       coalesce(loans, 0) AS total_loans, coalesce(principal, 0) AS total_loan_amount,
       coalesce(active, 0) AS active_loans, coalesce(defaulted, 0) AS defaulted_loans,
       coalesce(n, 0) AS total_loan_payments, coalesce(paid, 0) AS paid_payments,
       coalesce(late, 0) AS late_payments, coalesce(paid_amount, 0) AS total_paid_amount
FROM {stg_customers} LEFT JOIN borrowed USING (customer_id)
""",
    "fct_daily_transactions": """
SELECT date(transaction_timestamp) AS transaction_date, transaction_type, status,
       count(*) AS transaction_count, sum(amount) AS total_amount, avg(amount) AS average_amount,
       min(amount) AS minimum_amount, max(amount) AS maximum_amount
FROM {stg_transactions} GROUP BY ALL
""",
    "fct_customer_transactions": f"""
WITH by_account AS ({_ACCOUNT_TOTALS}), by_customer AS (
  SELECT customer_id, sum(n) AS n, sum(amount) AS amount, sum(amounts) AS amounts,
         min(smallest) AS smallest, max(largest) AS largest, sum(completed) AS completed, sum(failed) AS failed,
         sum(pending) AS pending, sum(cancelled) AS cancelled
  FROM by_account JOIN {{stg_accounts}} USING (account_id) GROUP BY customer_id
)
SELECT customer_id, customer_segment, n AS total_transactions, amount AS total_transaction_amount,
       try_divide(amount, amounts) AS average_transaction_amount,
       smallest AS minimum_transaction_amount, largest AS maximum_transaction_amount,
       completed AS completed_transactions, failed AS failed_transactions,
       pending AS pending_transactions, cancelled AS cancelled_transactions
FROM by_customer JOIN {{stg_customers}} USING (customer_id)
""",
    "fct_merchant_performance": """
WITH by_merchant AS (
  SELECT merchant_id, count(*) AS transaction_count, sum(amount) AS total_transaction_amount,
         avg(amount) AS average_transaction_amount, count_if(status = 'COMPLETED') AS completed_transactions,
         count_if(status = 'FAILED') AS failed_transactions, count_if(status = 'CANCELLED') AS cancelled_transactions
  FROM {stg_transactions} WHERE merchant_id IS NOT NULL GROUP BY merchant_id
)
SELECT merchant_id, merchant_name, merchant_category, city AS merchant_city, state AS merchant_state,
       transaction_count, total_transaction_amount, average_transaction_amount,
       completed_transactions, failed_transactions, cancelled_transactions
FROM by_merchant JOIN {stg_merchants} USING (merchant_id)
""",
    "fct_loan_portfolio": """
WITH by_loan AS (
  SELECT loan_id, count(payment_id) AS total_payments, count_if(status = 'PAID') AS paid_payments,
         count_if(status = 'LATE') AS late_payments, count_if(status = 'PENDING') AS pending_payments,
         coalesce(sum(amount) FILTER (WHERE status = 'PAID'), 0) AS total_paid_amount,
         coalesce(sum(amount) FILTER (WHERE status = 'LATE'), 0) AS total_late_amount
  FROM {stg_loan_payments} GROUP BY loan_id
)
SELECT loan_id, customer_id, loan_type, principal_amount, interest_rate, term_months, status AS loan_status,
       total_payments, paid_payments, late_payments, pending_payments, total_paid_amount, total_late_amount
FROM by_loan JOIN {stg_loans} USING (loan_id)
""",
    "customer_360_mart": f"""
WITH by_account AS ({_ACCOUNT_TOTALS}), issued AS (
  SELECT account_id, count(card_id) AS cards, count_if(card_type = 'CREDIT') AS credit,
         count_if(card_type = 'DEBIT') AS debit
  FROM {{stg_cards}} GROUP BY account_id
), held AS (
  SELECT customer_id, count(*) AS accounts, count_if(status = 'ACTIVE') AS active,
         count_if(status = 'BLOCKED') AS blocked, count_if(status = 'CLOSED') AS closed,
         sum(n) AS n, sum(amount) AS amount, sum(amounts) AS amounts, sum(completed) AS completed,
         sum(failed) AS failed, sum(pending) AS pending, sum(cancelled) AS cancelled,
         sum(cards) AS cards, sum(credit) AS credit, sum(debit) AS debit
  FROM {{stg_accounts}} LEFT JOIN by_account USING (account_id) LEFT JOIN issued USING (account_id)
  GROUP BY customer_id
)
SELECT customer_id, c.customer_segment,
       coalesce(accounts, 0) AS total_accounts, coalesce(held.active, 0) AS active_accounts,
       coalesce(blocked, 0) AS blocked_accounts, coalesce(closed, 0) AS closed_accounts,
       coalesce(n, 0) AS total_transactions, coalesce(amount, 0) AS total_transaction_amount,
       coalesce(try_divide(amount, amounts), 0) AS average_transaction_amount,
       coalesce(completed, 0) AS completed_transactions, coalesce(failed, 0) AS failed_transactions,
       coalesce(pending, 0) AS pending_transactions, coalesce(cancelled, 0) AS cancelled_transactions,
       coalesce(cards, 0) AS total_cards, coalesce(credit, 0) AS credit_cards, coalesce(debit, 0) AS debit_cards,
       coalesce(total_loans, 0) AS total_loans, coalesce(total_loan_amount, 0) AS total_loan_amount,
       coalesce(active_loans, 0) AS active_loans, coalesce(defaulted_loans, 0) AS defaulted_loans,
       coalesce(total_loan_payments, 0) AS total_loan_payments, coalesce(paid_payments, 0) AS paid_payments,
       coalesce(late_payments, 0) AS late_payments, coalesce(total_paid_amount, 0) AS total_paid_amount
FROM {{stg_customers}} AS c
LEFT JOIN held USING (customer_id)
LEFT JOIN {{int_customer_loans}} USING (customer_id)
""",
}

MODELS = (*STAGING, *ROW_JOINS, *MARTS)  # in an order in which each model follows those it reads


def define(spark: SparkSession, name: str, read: Tables) -> DataFrame:
    """One model as a DataFrame over what `read` returns for the models and Silver tables it names."""
    if name in ROW_JOINS:
        return ROW_JOINS[name](read)
    text = STAGING.get(name) or MARTS[name]
    return spark.sql(text, **{other: read(other) for other in sorted(set(re.findall(r"{(\w+)}", text)))})


def model(spark: SparkSession, name: str, silver: Tables) -> DataFrame:
    """The model as one plan, resolved down to Silver."""
    return define(spark, name, lambda other: silver(other) if other in ENTITIES else model(spark, other, silver))


def build_tables(spark: SparkSession, silver: Tables, root: str) -> Tables:
    """Write the intermediate models and marts below `root`, each from the written models it reads; staging models
    stay views. Returns a reader by model name."""
    built: dict[str, DataFrame] = {}
    for name in MODELS:
        rows = define(spark, name, lambda other: silver(other) if other in ENTITIES else built[other])
        if name not in STAGING:
            write_table(rows, f"{root}/{name}")
            rows = scan(spark, f"{root}/{name}", rows.schema)
        built[name] = rows
    return built.__getitem__


def create_views(spark: SparkSession, read: Tables) -> None:
    """Register every model as a temporary view, for use from SQL."""
    for name in MODELS:
        read(name).createOrReplaceTempView(name)
