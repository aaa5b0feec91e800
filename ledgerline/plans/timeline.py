"""What happened when: account states at transactions, open accounts at payments, overlapping loans, sessions, running totals."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.schedule import months_after
from ledgerline.operators.checks import stack
from ledgerline.operators.intervals import micros, overlapping
from ledgerline.operators.lookup import lookup
from ledgerline.operators.ordered import SLICE_ROWS, as_of, running_totals, sessions

Tables = Callable[[str], DataFrame]  # entity name -> its Silver rows

SESSION_GAP = "6 HOURS"
DAY = 86_400_000_000  # microseconds


def account_history(silver: Tables) -> DataFrame:
    """(account_id, since, state): what an account becomes when it is opened or closed, or gets a card."""
    accounts, cards = silver("accounts"), silver("cards")
    state = lambda rows, moment, name: rows.where(F.col(moment).isNotNull()).select(
        "account_id", F.col(moment).alias("since"), name.alias("state"))
    return stack([
        state(accounts, "opened_at", F.lit("OPENED")),
        state(accounts, "closed_at", F.lit("CLOSED")),
        state(cards, "issued_at", F.concat(F.lit("HAS_"), F.col("card_type"), F.lit("_CARD"))),
    ])


def transactions_with_state(silver: Tables, floor: int = SLICE_ROWS) -> DataFrame:
    """Every transaction with the latest state of its account at that moment, NULL before the first one."""
    rows = silver("transactions").select("transaction_id", "account_id", "transaction_timestamp", "amount")
    return as_of(rows, account_history(silver), "account_id", "transaction_timestamp", "since", ["state"], floor=floor)


def transactions_by_state(silver: Tables) -> DataFrame:
    """How many transactions, and how much, came in each state of their accounts: those of closed ones need a look."""
    held = transactions_with_state(silver).withColumn("state", F.coalesce("state", F.lit("NOT_OPENED")))
    days = F.datediff("transaction_timestamp", "since")
    return held.groupBy("state").agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("amount").alias("total_amount"),
        F.max(days).alias("longest_days"))


def open_accounts_at_payments(silver: Tables) -> DataFrame:
    """(payment_id, customer_id, open_accounts): payments made while their customer had open accounts."""
    paid = silver("loan_payments").where("payment_date IS NOT NULL").select("payment_id", "loan_id", "payment_date")
    owners = silver("loans").select("loan_id", "customer_id")
    payments = lookup(paid, owners, "loan_id").select("customer_id", "payment_id", micros("payment_date").alias("paid_at"))
    accounts = silver("accounts").select(
        "customer_id", "account_id", micros("opened_at").alias("open_from"), micros("closed_at").alias("open_until"))
    held = overlapping(payments, accounts, ("paid_at", "paid_at"), ("open_from", "open_until"), keys=["customer_id"], width=DAY)
    return held.groupBy("payment_id", "customer_id").agg(F.count(F.lit(1)).alias("open_accounts"))


def overlapping_loans(silver: Tables) -> DataFrame:
    """Pairs of loans of one customer whose terms overlap, with the days they run side by side."""
    loans = silver("loans").select(
        "customer_id", "loan_id", F.col("created_at").alias("begins"),
        months_after(F.col("created_at"), F.col("term_months")).alias("ends"))
    side = lambda mark: loans.select(
        "customer_id", F.col("loan_id").alias(f"loan_{mark}"), F.col("begins").alias(f"begins_{mark}"),
        F.col("ends").alias(f"ends_{mark}"), micros("begins").alias(f"from_{mark}"), (micros("ends") - 1).alias(f"until_{mark}"))
    pairs = overlapping(side("a"), side("b"), ("from_a", "until_a"), ("from_b", "until_b"), keys=["customer_id"], width=30 * DAY)
    begins, ends = F.greatest("begins_a", "begins_b"), F.least("ends_a", "ends_b")
    return pairs.where("loan_a < loan_b").select(
        "customer_id", "loan_a", "loan_b", begins.alias("overlap_from"), ends.alias("overlap_until"),
        F.datediff(ends, begins).alias("overlap_days"))


def event_sessions(events: DataFrame, gap: str = SESSION_GAP, floor: int = SLICE_ROWS) -> DataFrame:
    """Sessions of each user: events with no more than `gap` between one and the next."""
    numbered = sessions(events, "user_id", "ts", gap, tie=["event_id"], floor=floor)
    cents = F.rint(F.col("value") * 100).cast("long")
    return numbered.groupBy("user_id", "session").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count(F.lit(1)).alias("event_count"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"), F.sum(cents).alias("total_cents"))


def event_running_totals(events: DataFrame, floor: int = SLICE_ROWS) -> DataFrame:
    """Every event with the number and value of its user's events up to it."""
    totals = running_totals(
        events, "user_id", ["ts", "event_id"], {"running_events": "1", "running_cents": "CAST(rint(value * 100) AS BIGINT)"},
        floor=floor)
    return totals.select("event_id", "user_id", "ts", F.col("running_events").cast("long").alias("running_events"), "running_cents")
