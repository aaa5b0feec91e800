"""A valid row per entity, to be bent by the tests, and helpers to make Bronze tables of such rows."""

from __future__ import annotations

from datetime import date, datetime

from ledgerline.model import ENTITIES
from ledgerline.plans.bronze import add_partition_columns

MOMENT = datetime(2024, 3, 31, 10, 30)
LATER = datetime(2027, 3, 31, 10, 30)

VALID = {
    "customers": dict(
        customer_id=1, first_name="Ana", last_name="Lima", birth_date=date(1990, 1, 1), document="123",
        email="ana@example.com", phone="55", city="Recife", state="PE", customer_segment="BASIC", created_at=MOMENT),
    "accounts": dict(
        account_id=10, customer_id=1, account_type="CHECKING", branch="0001", account_number="42", status="ACTIVE",
        opened_at=MOMENT, closed_at=None),
    "merchants": dict(
        merchant_id=5, merchant_name="Shop", merchant_category="TRAVEL", city="Natal", state="RN", created_at=MOMENT),
    "transactions": dict(
        transaction_id=100, account_id=10, transaction_type="PIX", amount=12.5, currency="BRL", status="COMPLETED",
        transaction_timestamp=MOMENT, merchant_id=None, description="x"),
    "cards": dict(
        card_id=7, account_id=10, card_type="DEBIT", brand="VISA", status="ACTIVE", credit_limit=None,
        issued_at=MOMENT, expires_at=LATER),
    "loans": dict(
        loan_id=3, customer_id=1, loan_type="AUTO", principal_amount=1000.0, interest_rate=2.0, term_months=12,
        status="ACTIVE", created_at=MOMENT),
    "loan_payments": dict(
        payment_id=9, loan_id=3, payment_number=1, due_date=MOMENT, payment_date=MOMENT, amount=85.0, status="PAID"),
}


def frame(spark, entity, *changes):
    """Rows of an entity without year and month; each change is applied to the valid row."""
    schema = ENTITIES[entity].columns
    rows = [tuple({**VALID[entity], **change}[name] for name in schema.names) for change in changes]
    return spark.createDataFrame(rows, schema)


def bronze(spark, entity, *changes):
    return add_partition_columns(frame(spark, entity, *changes), ENTITIES[entity].date_column)


def tables(spark, **given):
    """A Bronze lookup: the given rows, one valid row for every other entity."""
    made = {name: bronze(spark, name, *given.get(name, [{}])) for name in ENTITIES}
    return made.__getitem__
