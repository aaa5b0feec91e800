"""Derived tables: the payment schedule of a loan and the accounts that may get a card."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.schedule import instalment, months_after


def installment_schedule(loans: DataFrame) -> DataFrame:
    """One row per loan and month of its term: payment number, due date and instalment."""
    return (
        loans.where("term_months >= 1")
        .withColumn("payment_number", F.explode(F.sequence(F.lit(1).cast("long"), "term_months")))
        .select(
            "loan_id",
            "payment_number",
            months_after(F.col("created_at"), F.col("payment_number")).alias("due_date"),
            instalment(F.col("principal_amount"), F.col("interest_rate"), F.col("term_months")).alias("amount"),
        )
    )


def eligible_card_accounts(accounts: DataFrame) -> DataFrame:
    """Active accounts with the card types they may have; savings accounts may only have debit cards."""
    return accounts.where("status = 'ACTIVE'").select(
        "account_id",
        "account_type",
        F.when(F.col("account_type") == "SAVINGS", "DEBIT").otherwise("DEBIT,CREDIT").alias("allowed_card_types"),
    )
