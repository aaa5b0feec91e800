from __future__ import annotations

from datetime import date, datetime

import pytest

from ledgerline.functions.rules import RULES, validate
from ledgerline.functions.text import normalise
from ledgerline.plans.silver import validated
from tests.samples import LATER, MOMENT, bronze, tables

# entity -> code -> changes that break exactly that rule
FIRING = {
    "customers": {
        "NULL_CUSTOMER_ID": [dict(customer_id=None)],
        "INVALID_FIRST_NAME": [dict(first_name=None), dict(first_name="  ")],
        "INVALID_LAST_NAME": [dict(last_name=None), dict(last_name="")],
        "INVALID_DOCUMENT": [dict(document=None), dict(document=" ")],
        "INVALID_EMAIL": [dict(email=None), dict(email="")],
        "INVALID_CUSTOMER_SEGMENT": [dict(customer_segment="VIP")],
        "NULL_BIRTH_DATE": [dict(birth_date=None)],
        "INVALID_BIRTH_DATE": [dict(birth_date=date(2024, 4, 1))],
        "NULL_CREATED_AT": [dict(created_at=None)],
    },
    "accounts": {
        "NULL_ACCOUNT_ID": [dict(account_id=None)],
        "NULL_CUSTOMER_ID": [dict(customer_id=None)],
        "INVALID_BRANCH": [dict(branch=None), dict(branch=" ")],
        "INVALID_ACCOUNT_NUMBER": [dict(account_number=None), dict(account_number="")],
        "INVALID_ACCOUNT_TYPE": [dict(account_type="JOINT")],
        "INVALID_STATUS": [dict(status="FROZEN")],
        "NULL_OPENED_AT": [dict(opened_at=None)],
        "MISSING_CLOSED_AT": [dict(status="CLOSED")],
        "UNEXPECTED_CLOSED_AT": [dict(closed_at=LATER), dict(status="blocked", closed_at=LATER)],
    },
    "merchants": {
        "NULL_MERCHANT_ID": [dict(merchant_id=None)],
        "INVALID_MERCHANT_NAME": [dict(merchant_name=None), dict(merchant_name=" ")],
        "INVALID_MERCHANT_CATEGORY": [dict(merchant_category="CASINO")],
        "INVALID_CITY": [dict(city=None), dict(city="")],
        "INVALID_STATE": [dict(state="XX")],
        "NULL_CREATED_AT": [dict(created_at=None)],
    },
    "transactions": {
        "NULL_TRANSACTION_ID": [dict(transaction_id=None)],
        "NULL_ACCOUNT_ID": [dict(account_id=None)],
        "INVALID_AMOUNT": [dict(amount=None), dict(amount=0.0), dict(amount=-1.0)],
        "INVALID_CURRENCY": [dict(currency="USD")],
        "INVALID_TRANSACTION_TYPE": [dict(transaction_type="BOLETO")],
        "INVALID_STATUS": [dict(status="REVERSED")],
        "MISSING_MERCHANT_ID": [dict(transaction_type="card_purchase")],
    },
    "cards": {
        "NULL_CARD_ID": [dict(card_id=None)],
        "NULL_ACCOUNT_ID": [dict(account_id=None)],
        "INVALID_BRAND": [dict(brand=None), dict(brand=" ")],
        "INVALID_CARD_TYPE": [dict(card_type="PREPAID")],
        "INVALID_STATUS": [dict(status="LOST")],
        "NULL_ISSUED_AT": [dict(issued_at=None)],
        "NULL_EXPIRES_AT": [dict(expires_at=None)],
        "INVALID_EXPIRATION_DATE": [dict(expires_at=MOMENT), dict(expires_at=datetime(2020, 1, 1))],
        "MISSING_CREDIT_LIMIT": [dict(card_type="credit")],
        "UNEXPECTED_CREDIT_LIMIT": [dict(credit_limit=10.0)],
    },
    "loans": {
        "NULL_LOAN_ID": [dict(loan_id=None)],
        "NULL_CUSTOMER_ID": [dict(customer_id=None)],
        "INVALID_LOAN_TYPE": [dict(loan_type="HOME")],
        "INVALID_PRINCIPAL_AMOUNT": [dict(principal_amount=None), dict(principal_amount=0.0)],
        "INVALID_INTEREST_RATE": [dict(interest_rate=None), dict(interest_rate=-0.1)],
        "INVALID_TERM_MONTHS": [dict(term_months=None), dict(term_months=0)],
        "INVALID_STATUS": [dict(status="FROZEN")],
        "NULL_CREATED_AT": [dict(created_at=None)],
    },
    "loan_payments": {
        "NULL_PAYMENT_ID": [dict(payment_id=None)],
        "NULL_LOAN_ID": [dict(loan_id=None)],
        "INVALID_PAYMENT_NUMBER": [dict(payment_number=None), dict(payment_number=0)],
        "NULL_DUE_DATE": [dict(due_date=None)],
        "INVALID_AMOUNT": [dict(amount=None), dict(amount=0.0)],
        "INVALID_STATUS": [dict(status="WAIVED")],
        "MISSING_PAYMENT_DATE": [dict(payment_date=None)],
        "UNEXPECTED_PAYMENT_DATE": [dict(status="PENDING")],
    },
}

# Rows that no rule may reject: NULL in an enumerated column, unusual but allowed values, untidy text.
PASSING = {
    "customers": [{}, dict(customer_segment=None), dict(customer_segment=" premium "), dict(email="no at sign"),
                  dict(phone=None, city=None, state="??"), dict(first_name="\t"), dict(birth_date=MOMENT.date())],
    "accounts": [{}, dict(status=None), dict(status=None, closed_at=LATER), dict(account_type=None),
                 dict(status=" closed", closed_at=LATER), dict(account_type=" savings ")],
    "merchants": [{}, dict(merchant_category=None), dict(state=None), dict(state=" sp")],
    "transactions": [{}, dict(currency=None), dict(status=None), dict(transaction_type=None), dict(merchant_id=9),
                     dict(transaction_type="CARD_PURCHASE", merchant_id=5), dict(transaction_timestamp=None)],
    "cards": [{}, dict(card_type=None), dict(card_type=None, credit_limit=3.0), dict(status=None),
              dict(card_type="CREDIT", credit_limit=3.0), dict(brand="anything")],
    "loans": [{}, dict(interest_rate=0.0), dict(loan_type=None), dict(status=None), dict(status="defaulted ")],
    "loan_payments": [{}, dict(status=None, payment_date=None), dict(status="LATE"),
                      dict(status="LATE", payment_date=None), dict(status="PENDING", payment_date=None)],
}


# Neighbours that no row can break at once.
EXCLUSIVE = {
    ("INVALID_BIRTH_DATE", "NULL_CREATED_AT"), ("MISSING_CLOSED_AT", "UNEXPECTED_CLOSED_AT"),
    ("MISSING_CREDIT_LIMIT", "UNEXPECTED_CREDIT_LIMIT"), ("MISSING_PAYMENT_DATE", "UNEXPECTED_PAYMENT_DATE"),
    ("NULL_EXPIRES_AT", "INVALID_EXPIRATION_DATE"),
}


def test_every_rule_is_exercised():
    assert {name: list(codes) for name, codes in FIRING.items()} == {
        name: [rule.code for rule in rules] for name, rules in RULES.items()}
    assert sum(map(len, RULES.values())) == 57


@pytest.mark.parametrize("entity", FIRING)
def test_rules_fire(spark, entity):
    cases = [(code, change) for code, changes in FIRING[entity].items() for change in changes]
    rows = bronze(spark, entity, *(change for _, change in cases)).coalesce(1)
    found = [row["quality_error"] for row in validate(entity, normalise(entity, rows)).collect()]
    assert found == [code for code, _ in cases]


@pytest.mark.parametrize("entity", PASSING)
def test_rules_pass(spark, entity):
    rows = bronze(spark, entity, *PASSING[entity])
    assert validate(entity, normalise(entity, rows)).where("quality_error IS NOT NULL").count() == 0


@pytest.mark.parametrize("entity", FIRING)
def test_first_rule_wins(spark, entity):
    """A row that breaks two rules carries the code of the earlier one."""
    codes = list(FIRING[entity])
    cases = []
    for early, late in zip(codes, codes[1:]):
        for first in FIRING[entity][early]:
            for second in FIRING[entity][late]:
                if not set(first) & set(second) and (early, late) not in EXCLUSIVE:
                    cases.append((early, {**second, **first}))
    rows = bronze(spark, entity, *(change for _, change in cases)).coalesce(1)
    found = [row["quality_error"] for row in validate(entity, normalise(entity, rows)).collect()]
    assert found == [code for code, _ in cases]


def test_normalisation_trims_spaces_only(spark):
    row = validated("customers", tables(spark, customers=[
        dict(first_name=" Ana ", email=" Ana@X.Com ", state=" pe", customer_segment="basic ", city="\tRecife ")
    ])).first()
    assert (row.first_name, row.email, row.state, row.customer_segment, row.city) == (
        "Ana", "ana@x.com", "PE", "BASIC", "\tRecife")
