"""Paid amounts allotted to the instalments of their loan, oldest first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.lookup import lookup
from ledgerline.operators.ordered import SLICE_ROWS, as_of, running_totals
from ledgerline.plans.derive import installment_schedule
from ledgerline.session import materialise

Tables = Callable[[str], DataFrame]

CENTS = "CAST(rint(amount * 100) AS BIGINT)"


def allotted(silver: Tables, floor: int = SLICE_ROWS) -> DataFrame:
    """(loan_id, payment_number, payment_id, allotted_cents): how much of each payment went to each instalment.

    Instalments and payments are laid end to end as ranges of cents, in the order they fall due and are paid; a payment
    pays for what its range shares with an instalment's. What is paid beyond the schedule is allotted to nothing. Keys are
    unique, as in Silver. Two ranges that share cents do so where the later of them starts, so each pair comes out of one
    look-up there; only loans with payments are given a schedule.
    """
    paid = silver("loan_payments").where("status = 'PAID'").select(
        "loan_id", "payment_id", "payment_date", F.expr(CENTS).alias("paid_cents")).where("paid_cents > 0")
    payers = materialise(paid.select("loan_id").where("loan_id IS NOT NULL").distinct())
    due = installment_schedule(lookup(silver("loans"), payers, "loan_id")).select(
        "loan_id", "payment_number", F.expr(CENTS).alias("due_cents"))
    due = running_totals(due.where("due_cents > 0"), "loan_id", ["payment_number"], {"due_until": "due_cents"}, floor=floor)
    paid = running_totals(paid, "loan_id", ["payment_date", "payment_id"], {"paid_until": "paid_cents"}, floor=floor)
    # Written once: each look-up reads them several times.
    due = materialise(due.select("loan_id", "payment_number", F.expr("due_until - due_cents + 1").alias("due_from"), "due_until"))
    paid = materialise(paid.select("loan_id", "payment_id", F.expr("paid_until - paid_cents + 1").alias("paid_from"), "paid_until"))
    begun = as_of(due, paid, "loan_id", "due_from", "paid_from", ["paid_until", "payment_id"], floor=floor)
    within = as_of(paid, due, "loan_id", "paid_from", "due_from", ["due_until", "payment_number"], floor=floor)
    columns = ["loan_id", "payment_number", "payment_id", "due_from", "due_until", "paid_from", "paid_until"]
    met = begun.where("due_from <= paid_until").select(columns).unionByName(
        within.where("due_from < paid_from AND paid_from <= due_until").select(columns))
    return met.select("loan_id", "payment_number", "payment_id", F.expr(
        "least(due_until, paid_until) - greatest(due_from, paid_from) + 1").alias("allotted_cents"))
