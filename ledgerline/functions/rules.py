"""Row rules: an ordered list of (code, predicate) per entity; the first predicate that is true names the error.

Predicates are SQL text under three-valued logic: a NULL in an enumerated column makes the predicate NULL, so the rule
does not fire.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline import model as m


class Rule(NamedTuple):
    code: str
    fails: str


def missing(column: str) -> str:
    return f"{column} IS NULL"


def blank(column: str) -> str:
    return f"{column} IS NULL OR trim({column}) = ''"


def outside(column: str, allowed: Iterable[str]) -> str:
    return f"{column} NOT IN ({', '.join(repr(value) for value in allowed)})"


def not_above_zero(column: str) -> str:
    return f"{column} IS NULL OR {column} <= 0"


# The codes, their conditions and their order of precedence.
RULES: dict[str, tuple[Rule, ...]] = {
    "customers": (
        Rule("NULL_CUSTOMER_ID", missing("customer_id")),
        Rule("INVALID_FIRST_NAME", blank("first_name")),
        Rule("INVALID_LAST_NAME", blank("last_name")),
        Rule("INVALID_DOCUMENT", blank("document")),
        Rule("INVALID_EMAIL", blank("email")),
        Rule("INVALID_CUSTOMER_SEGMENT", outside("customer_segment", m.CUSTOMER_SEGMENTS)),
        Rule("NULL_BIRTH_DATE", missing("birth_date")),
        Rule("INVALID_BIRTH_DATE", "birth_date > created_at"),
        Rule("NULL_CREATED_AT", missing("created_at")),
    ),
    "accounts": (
        Rule("NULL_ACCOUNT_ID", missing("account_id")),
        Rule("NULL_CUSTOMER_ID", missing("customer_id")),
        Rule("INVALID_BRANCH", blank("branch")),
        Rule("INVALID_ACCOUNT_NUMBER", blank("account_number")),
        Rule("INVALID_ACCOUNT_TYPE", outside("account_type", m.ACCOUNT_TYPES)),
        Rule("INVALID_STATUS", outside("status", m.ACCOUNT_STATUSES)),
        Rule("NULL_OPENED_AT", missing("opened_at")),
        Rule("MISSING_CLOSED_AT", "status = 'CLOSED' AND closed_at IS NULL"),
        Rule("UNEXPECTED_CLOSED_AT", "status <> 'CLOSED' AND closed_at IS NOT NULL"),
    ),
    "merchants": (
        Rule("NULL_MERCHANT_ID", missing("merchant_id")),
        Rule("INVALID_MERCHANT_NAME", blank("merchant_name")),
        Rule("INVALID_MERCHANT_CATEGORY", outside("merchant_category", m.MERCHANT_CATEGORIES)),
        Rule("INVALID_CITY", blank("city")),
        Rule("INVALID_STATE", outside("state", m.STATES)),
        Rule("NULL_CREATED_AT", missing("created_at")),
    ),
    "transactions": (
        Rule("NULL_TRANSACTION_ID", missing("transaction_id")),
        Rule("NULL_ACCOUNT_ID", missing("account_id")),
        Rule("INVALID_AMOUNT", not_above_zero("amount")),
        Rule("INVALID_CURRENCY", f"currency <> '{m.CURRENCY}'"),
        Rule("INVALID_TRANSACTION_TYPE", outside("transaction_type", m.TRANSACTION_TYPES)),
        Rule("INVALID_STATUS", outside("status", m.TRANSACTION_STATUSES)),
        Rule("MISSING_MERCHANT_ID", "transaction_type = 'CARD_PURCHASE' AND merchant_id IS NULL"),
    ),
    "cards": (
        Rule("NULL_CARD_ID", missing("card_id")),
        Rule("NULL_ACCOUNT_ID", missing("account_id")),
        Rule("INVALID_BRAND", blank("brand")),
        Rule("INVALID_CARD_TYPE", outside("card_type", m.CARD_TYPES)),
        Rule("INVALID_STATUS", outside("status", m.CARD_STATUSES)),
        Rule("NULL_ISSUED_AT", missing("issued_at")),
        Rule("NULL_EXPIRES_AT", missing("expires_at")),
        Rule("INVALID_EXPIRATION_DATE", "expires_at <= issued_at"),
        Rule("MISSING_CREDIT_LIMIT", "card_type = 'CREDIT' AND credit_limit IS NULL"),
        Rule("UNEXPECTED_CREDIT_LIMIT", "card_type = 'DEBIT' AND credit_limit IS NOT NULL"),
    ),
    "loans": (
        Rule("NULL_LOAN_ID", missing("loan_id")),
        Rule("NULL_CUSTOMER_ID", missing("customer_id")),
        Rule("INVALID_LOAN_TYPE", outside("loan_type", m.LOAN_TYPES)),
        Rule("INVALID_PRINCIPAL_AMOUNT", not_above_zero("principal_amount")),
        Rule("INVALID_INTEREST_RATE", "interest_rate IS NULL OR interest_rate < 0"),
        Rule("INVALID_TERM_MONTHS", not_above_zero("term_months")),
        Rule("INVALID_STATUS", outside("status", m.LOAN_STATUSES)),
        Rule("NULL_CREATED_AT", missing("created_at")),
    ),
    "loan_payments": (
        Rule("NULL_PAYMENT_ID", missing("payment_id")),
        Rule("NULL_LOAN_ID", missing("loan_id")),
        Rule("INVALID_PAYMENT_NUMBER", not_above_zero("payment_number")),
        Rule("NULL_DUE_DATE", missing("due_date")),
        Rule("INVALID_AMOUNT", not_above_zero("amount")),
        Rule("INVALID_STATUS", outside("status", m.PAYMENT_STATUSES)),
        Rule("MISSING_PAYMENT_DATE", "status = 'PAID' AND payment_date IS NULL"),
        Rule("UNEXPECTED_PAYMENT_DATE", "status = 'PENDING' AND payment_date IS NOT NULL"),
    ),
}


def first_failure(rules: Iterable[Rule]) -> Column:
    """The code of the first rule that fails, NULL if none does."""
    return F.coalesce(*(F.when(F.expr(rule.fails), F.lit(rule.code)) for rule in rules))


def validate(entity: str, rows: DataFrame) -> DataFrame:
    """Add `quality_error` from the row rules alone; rows must be normalised already."""
    return rows.withColumn("quality_error", first_failure(RULES[entity]))
