from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.rules import RULES
from ledgerline.model import ENTITIES
from ledgerline.plans import silver
from ledgerline.plans.bronze import add_partition_columns
from ledgerline.workspace import lake_over
from tests.conftest import SMALL
from tests.samples import VALID, tables


def errors(rows, key):
    return sorted(((row[key], row.quality_error) for row in rows.collect()), key=repr)


def test_missing_parents(spark):
    lake = tables(spark, accounts=[dict(account_id=1), dict(account_id=2, customer_id=99),
                                   dict(account_id=3, customer_id=99, branch=" ")])
    assert errors(silver.checked("accounts", lake), "account_id") == [
        (1, None), (2, "INVALID_CUSTOMER_ID"), (3, "INVALID_BRANCH")]


def test_children_of_quarantined_parents_stay_valid(spark):
    lake = tables(spark, customers=[dict(first_name=None)], accounts=[{}])
    assert errors(silver.checked("customers", lake), "customer_id") == [(1, "INVALID_FIRST_NAME")]
    assert errors(silver.checked("accounts", lake), "account_id") == [(10, None)]


def test_all_copies_are_duplicates(spark):
    """An invalid copy keeps its own code and condemns the valid one; NULL keys never match."""
    lake = tables(spark, merchants=[dict(), dict(), dict(merchant_id=6), dict(merchant_id=6, city=None),
                                    dict(merchant_id=8), dict(merchant_id=None), dict(merchant_id=None)])
    assert errors(silver.checked("merchants", lake), "merchant_id") == [
        (5, "DUPLICATE_MERCHANT_ID"), (5, "DUPLICATE_MERCHANT_ID"), (6, "DUPLICATE_MERCHANT_ID"),
        (6, "INVALID_CITY"), (8, None), (None, "NULL_MERCHANT_ID"), (None, "NULL_MERCHANT_ID")]


def test_cards_on_savings_accounts(spark):
    lake = tables(
        spark,
        accounts=[dict(account_id=1), dict(account_id=2, account_type="SAVINGS"),
                  dict(account_id=3, account_type=None), dict(account_id=4, account_type=" SAVINGS")],
        cards=[dict(card_id=number, account_id=account, card_type=kind, credit_limit=5.0 if kind == "CREDIT" else None)
               for number, (account, kind) in enumerate(
                   [(1, "CREDIT"), (2, "CREDIT"), (2, "DEBIT"), (3, "DEBIT"), (4, "CREDIT"), (9, "DEBIT"), (2, None)])])
    assert errors(silver.checked("cards", lake), "card_id") == [
        (0, None), (1, "INVALID_CARD_TYPE_FOR_SAVINGS"), (2, None), (3, "INVALID_ACCOUNT_ID"), (4, None),
        (5, "INVALID_ACCOUNT_ID"), (6, None)]


@pytest.mark.parametrize("entity", ENTITIES)
def test_empty_tables(spark, entity):
    lake = tables(spark)
    none = lambda name: lake(name).where("false")
    assert silver.checked(entity, none).count() == 0


def small(spark):
    return lake_over(spark, SMALL).bronze


def test_every_code_occurs(spark):
    codes = 0
    for name, entity in ENTITIES.items():
        found = {row.quality_error for row in silver.checked(name, small(spark)).select("quality_error").distinct().collect()}
        expected = {rule.code for rule in RULES[name]} | {entity.duplicate_code}
        expected |= {reference.code for reference in entity.references}
        if name == "cards":
            expected.add(silver.SAVINGS_CARD_CODE)
        assert found == expected | {None}
        codes += len(expected)
    assert codes == 70


@pytest.mark.parametrize("entity", ENTITIES)
def test_split_keeps_every_row(spark, entity):
    rows = silver.checked(entity, small(spark))
    keys = lambda df: Counter(row[0] for row in df.select(ENTITIES[entity].key).collect())
    parts = keys(silver.valid_rows(entity, rows)) + keys(silver.quarantined_rows(entity, rows))
    assert parts == keys(small(spark)(entity))


@pytest.mark.parametrize("entity", ["transactions", "cards", "loan_payments"])
def test_large_key_sets_give_the_same_errors(spark, no_broadcast, monkeypatch, entity):
    """The way for key sets beyond the budget agrees with counts per code of a naive plan, with hot keys present."""
    from ledgerline.operators import lookup as lookups
    monkeypatch.setattr(lookups.lookup, "__defaults__", ("inner", 3))
    beyond = silver.checked(entity, small(spark))
    assert "SortMergeJoin" in beyond._jdf.queryExecution().sparkPlan().toString()
    counts = Counter(row.quality_error for row in beyond.collect())
    spark.conf.unset("spark.ledgerline.broadcastBytes")
    assert counts == Counter(row.quality_error for row in silver.checked(entity, small(spark)).collect())


def test_hot_account_in_transactions(spark):
    """A third of all transactions on one unknown account, another third copies of one row."""
    given = tables(spark)
    number = F.col("id")
    constant = {
        name: F.lit(value).cast(ENTITIES["transactions"].columns[name].dataType)
        for name, value in VALID["transactions"].items()
    }
    crowded = add_partition_columns(spark.range(900).select(*(column.alias(name) for name, column in {
        **constant,
        "transaction_id": F.when(number < 300, F.lit(7)).otherwise(number),
        "account_id": F.when(number >= 600, F.lit(77)).otherwise(F.lit(10)),
    }.items())), "transaction_timestamp")
    lake = lambda name: crowded if name == "transactions" else given(name)
    counts = Counter(row.quality_error for row in silver.checked("transactions", lake).collect())
    assert counts == {"DUPLICATE_TRANSACTION_ID": 300, "INVALID_ACCOUNT_ID": 300, None: 300}
