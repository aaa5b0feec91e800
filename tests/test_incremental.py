"""Increments against one full run: rows condemned by later duplicates, rows revived by later parents, repeated and broken batches."""

from __future__ import annotations

import os
from collections import Counter
from datetime import timedelta

import pytest

from ledgerline.model import ENTITIES
from ledgerline.plans import gold, incremental, silver
from ledgerline.plans import run as flows
from ledgerline.plans.bronze import add_partition_columns
from ledgerline.plans.incremental import DealtLake, IncrementalLake
from ledgerline.session import BROADCAST_BUDGET_CONF, materialise
from tests.samples import MOMENT, frame

DAY = timedelta(days=1)
BATCHES = [
    {  # the account of 101 and 103 is not there yet, 104 is the day's largest
        "customers": [{}], "merchants": [{}], "accounts": [{}], "loans": [{}],
        "transactions": [dict(transaction_id=100), dict(transaction_id=101, account_id=11), dict(transaction_id=103, account_id=11, amount=1.0),
                         dict(transaction_id=104, amount=900.0, transaction_timestamp=MOMENT + DAY),
                         dict(transaction_id=105, amount=7.25, transaction_timestamp=MOMENT + DAY),
                         dict(transaction_id=106, transaction_type="CARD_PURCHASE", merchant_id=5)],
        "cards": [dict(card_id=7, account_id=11, card_type="CREDIT", credit_limit=5.0), dict(card_id=8)],
        "loan_payments": [dict(payment_id=9), dict(payment_id=10, loan_id=4), dict(payment_id=11, payment_number=2, amount=10.5)],
    },
    {  # the account comes and revives them, 104 comes again and both go, payment 11 too
        "accounts": [dict(account_id=11, customer_id=1)], "customers": [dict(customer_id=2)],
        "transactions": [dict(transaction_id=104, amount=3.0), dict(transaction_id=107, account_id=11, transaction_type="CARD_PURCHASE", merchant_id=5)],
        "loan_payments": [dict(payment_id=11)],
    },
    {  # the account comes again as a savings one: both copies go, its credit card goes; the loan of payment 10 comes
        "accounts": [dict(account_id=11, account_type="SAVINGS"), dict(account_id=12, customer_id=2), dict(account_id=None)],
        "cards": [dict(card_id=8, status="BLOCKED"), dict(card_id=13, account_id=12)], "loans": [dict(loan_id=4, customer_id=2)],
        "transactions": [dict(transaction_id=104), dict(transaction_id=108, account_id=12, amount=-1.0), dict(transaction_id=None)],
    },
]


@pytest.fixture(scope="module")
def batches(spark):
    return [{name: frame(spark, name, *rows) for name, rows in batch.items()} for batch in BATCHES]


@pytest.fixture(scope="module")
def lake(spark, batches, tmp_path_factory):
    made = IncrementalLake(spark, str(tmp_path_factory.mktemp("incremental")))
    for number, batch in enumerate(batches, start=1):
        made.apply(number, batch)
    return made


def full(spark, upto):
    """Bronze of everything received in the first batches."""
    def rows(name):
        held = frame(spark, name, *(row for batch in BATCHES[:upto] for row in batch.get(name, [])))
        return add_partition_columns(held, ENTITIES[name].date_column)

    return rows


def bag(rows):
    return Counter(map(repr, map(tuple, rows.collect())))


@pytest.mark.parametrize("upto", [1, 2, 3])
@pytest.mark.parametrize("name", ENTITIES)
def test_checked_rows_are_those_of_a_full_run(spark, lake, name, upto):
    assert bag(lake.checked(name, upto)) == bag(silver.checked(name, full(spark, upto)))


def test_verdicts_change(spark, lake):
    def verdicts(name, key, upto):
        return sorted((row[key] or 0, row.quality_error or "") for row in lake.checked(name, upto).collect())

    assert (101, "INVALID_ACCOUNT_ID") in verdicts("transactions", "transaction_id", 1)
    assert (101, "") in verdicts("transactions", "transaction_id", 2)
    assert (104, "") in verdicts("transactions", "transaction_id", 1)
    assert [v for v in verdicts("transactions", "transaction_id", 3) if v[0] == 104] == 3 * [(104, "DUPLICATE_TRANSACTION_ID")]
    assert (7, "INVALID_ACCOUNT_ID") in verdicts("cards", "card_id", 1) and (7, "") in verdicts("cards", "card_id", 2)
    assert (10, "INVALID_LOAN_ID") in verdicts("loan_payments", "payment_id", 2) and (10, "") in verdicts("loan_payments", "payment_id", 3)


@pytest.mark.parametrize("name", incremental.MODELS)
def test_gold_is_that_of_a_full_run(spark, lake, name):
    checked = {entity: silver.valid_rows(entity, silver.checked(entity, full(spark, 3))) for entity in ENTITIES}
    columns = gold.SCHEMAS[name].names
    found = incremental.MODELS[name](lake).select(columns)
    assert bag(found) == bag(gold.MODELS[name](checked.__getitem__).select(columns))
    assert found.count() > 0 and {f.name: f.dataType for f in found.schema} == {f.name: f.dataType for f in gold.SCHEMAS[name]}


def test_extremes_of_taken_back_rows_are_looked_up(lake):
    """The day's largest amount went when its key came again."""
    day = [row for row in lake.daily_transaction_summary().collect() if row.transaction_date == (MOMENT + DAY).date()]
    assert [(row.transaction_count, row.minimum_amount, row.maximum_amount) for row in day] == [(1, 7.25, 7.25)]


def test_batches_are_taken_once_and_in_order(spark, lake, batches):
    assert lake.committed() == 3
    lake.apply(3, batches[2])
    assert lake.committed() == 3 and lake.bronze("transactions").count() == 11
    with pytest.raises(ValueError):
        lake.apply(5, batches[0])


def test_a_broken_batch_is_repeated(spark, batches, folder, monkeypatch):
    """What a failed run left behind is neither read nor kept."""
    lake = IncrementalLake(spark, folder)
    lake.apply(1, batches[0])

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(IncrementalLake, "_collect", broken)
        with pytest.raises(OSError):
            lake.apply(2, batches[2])
    before = bag(silver.checked("transactions", full(spark, 1)))
    assert lake.committed() == 1 and bag(lake.checked("transactions")) == before
    lake.apply(2, batches[1])
    assert bag(lake.checked("transactions")) == bag(silver.checked("transactions", full(spark, 2)))


def test_the_flow_takes_deliveries(spark, batches, folder):
    """Two deliveries, the second without most files; Gold as written has the rows of the models."""
    for number in (1, 2):
        for name, rows in batches[number - 1].items():
            rows.write.parquet(f"{folder}/in{number}/{name}.parquet")
        reports = dict(flows.run_increment(spark, f"{folder}/in{number}", f"{folder}/lake", number))
    lake = IncrementalLake(spark, f"{folder}/lake")
    counts = {row.entity: row.valid_rows for row in reports["silver rows"].collect()}
    assert counts["transactions"] == lake.silver("transactions").count() == 6
    assert reports["gold daily_transaction_summary"].first().row_count == lake.daily_transaction_summary().count()


def test_only_key_columns_of_old_rows_are_read_for_dirty_keys(lake):
    plan = lake.dirty_keys("transactions", 3)._jdf.queryExecution().executedPlan().toString()
    assert "amount" not in plan and "CartesianProduct" not in plan


def test_rows_that_stay_are_not_shuffled(spark, lake, no_broadcast):
    """With more replaced keys than can be broadcast, only rows that may have been replaced meet them in a shuffle."""
    found = lake.checked("transactions")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1 and "Join LeftOuter" in plan
    assert bag(found) == bag(silver.checked("transactions", full(spark, 3)))


def test_rows_of_some_keys(spark, lake):
    keys = spark.createDataFrame([(101,), (104,), (999,)], "transaction_id long")
    for upto in (1, 2, 3):
        assert bag(lake.checked("transactions", upto, among=keys)) == bag(
            lake.checked("transactions", upto).where("transaction_id IN (101, 104, 999)"))


def test_a_dealt_lake_makes_what_is_asked_for(spark, folder):
    """Accounts need their parents' Bronze rows, not transactions; Gold needs states, dealt and built as by `apply`."""
    lake = DealtLake(spark, folder, lambda name: full(spark, 3)(name), 3)
    columns = ENTITIES["accounts"].bronze_schema.names
    assert bag(lake.silver("accounts").select(columns)) == bag(silver.valid_rows("accounts", silver.checked("accounts", full(spark, 3))))
    assert sorted(os.listdir(f"{folder}/increments")) == ["accounts", "customers"]
    assert os.listdir(f"{folder}/checked") == ["accounts"] and not os.path.exists(f"{folder}/state")
    checked = {name: silver.valid_rows(name, silver.checked(name, full(spark, 3))) for name in ENTITIES}
    names = gold.SCHEMAS["loan_portfolio"].names
    assert bag(lake.loan_portfolio().select(names)) == bag(gold.MODELS["loan_portfolio"](checked.__getitem__).select(names))
    assert os.listdir(f"{folder}/state") == ["loan"]


def test_a_dealt_lake_writes_bronze_rows_once(spark, folder):
    """The dealt parts are the Bronze batches themselves, those without rows among them."""
    few = lambda name: full(spark, 3)(name).limit(1) if name == "merchants" else full(spark, 3)(name)
    lake = DealtLake(spark, folder, few, 3)
    for name in ("merchants", "transactions"):
        assert bag(lake.bronze(name)) == bag(few(name)) and len(os.listdir(f"{folder}/increments/{name}")) >= 3
    assert not os.path.exists(f"{folder}/bronze")
    assert bag(lake.checked("merchants")) == bag(silver.checked("merchants", few))


def test_rows_that_stay_are_not_shuffled_within_a_budget(spark, lake):
    """With more replaced keys than can be broadcast, each batch drops them by sieves; nothing of it is shuffled."""
    wanted = bag(silver.checked("transactions", full(spark, 3)))
    spark.conf.set(BROADCAST_BUDGET_CONF, "45")
    try:
        found = lake.checked("transactions")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "_sieve_words" in plan and "Exchange hashpartitioning" not in plan
        assert bag(found) == wanted
        dirty = materialise(lake.dirty_keys("transactions", 3))
        assert bag(lake.checked("transactions", 2, among=dirty)) == bag(lake.checked("transactions", 2).join(dirty, "transaction_id", "left_semi"))
    finally:
        spark.conf.unset(BROADCAST_BUDGET_CONF)
