from __future__ import annotations

import pytest

from ledgerline.plans import gold, marts
from tests.samples import tables


def test_loan_without_payments(spark):
    silver = tables(spark, loans=[dict(loan_id=3), dict(loan_id=4)],
                    loan_payments=[dict(payment_id=1, amount=100.0), dict(payment_id=2, amount=50.0, status="LATE")])
    rows = {row.loan_id: row for row in gold.loan_portfolio(silver).collect()}
    assert (rows[3].total_payments, rows[3].total_paid_amount, rows[3].remaining_amount) == (2, 100.0, 900.0)
    assert (rows[4].total_payments, rows[4].total_paid_amount, rows[4].remaining_amount) == (0, 0.0, 1000.0)
    mart = marts.model(spark, "fct_loan_portfolio", silver).collect()
    assert [(row.loan_id, row.total_late_amount) for row in mart] == [(3, 50.0)]


def test_customer_without_anything(spark):
    silver = tables(spark, customers=[dict(customer_id=1), dict(customer_id=2)])
    rows = {row.customer_id: row.asDict() for row in gold.customer_360(silver).collect()}
    metrics = [name for name in rows[2] if name not in ("customer_id", "customer_segment")]
    assert len(metrics) == 15 and all(rows[2][name] == 0 for name in metrics)
    assert rows[1]["total_accounts"] == rows[1]["total_loans"] == rows[1]["total_cards"] == 1
    mart = {row.customer_id: row.asDict() for row in marts.model(spark, "customer_360_mart", silver).collect()}
    metrics = [name for name in mart[2] if name not in ("customer_id", "customer_segment")]
    assert len(metrics) == 22 and all(mart[2][name] == 0 for name in metrics)


def test_transactions_of_unknown_customers(spark):
    """They count per day, but not per customer."""
    silver = tables(spark, accounts=[dict(account_id=10, customer_id=77)])
    assert gold.daily_transaction_summary(silver).first().transaction_count == 1
    assert gold.customer_transaction_metrics(silver).count() == 0
    assert marts.model(spark, "int_customer_transactions", silver).count() == 0


def test_kinds_without_a_column(spark):
    silver = tables(spark, transactions=[
        dict(transaction_id=number, transaction_type=kind, status=status, amount=float(number))
        for number, (kind, status) in enumerate(
            [("PIX", "COMPLETED"), ("TED", "CANCELLED"), ("DOC", "FAILED"), ("DEPOSIT", "PENDING")], 1)])
    row = gold.customer_transaction_metrics(silver).first()
    assert (row.transaction_count, row.total_transaction_amount, row.average_transaction_amount) == (4, 10.0, 2.5)
    assert row.pix_count + row.card_purchase_count + row.transfer_count + row.deposit_count + row.withdrawal_count == 2
    assert row.completed_transactions + row.failed_transactions + row.pending_transactions == 3
    assert marts.model(spark, "fct_customer_transactions", silver).first().cancelled_transactions == 1


def test_top_merchants_break_ties_by_id(spark):
    silver = tables(
        spark,
        merchants=[dict(merchant_id=number) for number in range(15)],
        transactions=[dict(transaction_id=number, merchant_id=number % 15, amount=5.0) for number in range(30)])
    top = gold.top_merchants(gold.merchant_performance(silver)).collect()
    assert [row.merchant_id for row in top] == list(range(10))


def test_sums_of_cents_do_not_depend_on_the_partitioning(spark):
    amounts = [number * 0.01 + 1e7 * (number % 7) for number in range(1, 700)]
    amounts = [round(amount, 2) for amount in amounts]
    silver = tables(spark, transactions=[dict(transaction_id=at, amount=amount) for at, amount in enumerate(amounts)])

    def totals(parts):
        dealt = lambda name: silver(name).repartition(parts, "transaction_id") if name == "transactions" else silver(name)
        return [gold.daily_transaction_summary(dealt).collect(), gold.customer_transaction_metrics(dealt).collect()]

    one = totals(1)
    assert one == totals(3) == totals(8)
    assert one[0][0].total_amount == sum(round(amount * 100) for amount in amounts) / 100


def test_sums_of_other_values(spark):
    silver = tables(spark, transactions=[
        dict(transaction_id=at, amount=amount) for at, amount in enumerate((0.125, 1e300, None, -1e300))])
    row = gold.daily_transaction_summary(silver).first()
    assert row.total_amount in (0.0, 0.125) and row.average_amount in (0.0, 0.125 / 3)


def test_unique_accounts(spark):
    silver = tables(spark, transactions=[
        dict(transaction_id=number, merchant_id=5, account_id=number % 3) for number in range(9)])
    row = gold.merchant_performance(silver).first()
    assert (row.transaction_count, row.unique_accounts) == (9, 3)


@pytest.mark.parametrize("name", gold.MODELS)
def test_schemas(spark, name):
    silver = tables(spark)
    found, declared = gold.MODELS[name](silver).schema, gold.SCHEMAS[name]
    assert {field.name: field.dataType for field in found} == {field.name: field.dataType for field in declared}


@pytest.mark.parametrize("name", [*gold.MODELS, *(name for name in marts.MODELS if not name.startswith("stg_"))])
def test_empty_silver(spark, name):
    silver = tables(spark)
    none = lambda entity: silver(entity).where("false")
    rows = gold.MODELS[name](none) if name in gold.MODELS else marts.model(spark, name, none)
    assert rows.count() == 0


def test_marts_without_broadcast(spark, no_broadcast):
    silver = tables(spark, transactions=[dict(transaction_id=number) for number in range(20)])
    assert marts.model(spark, "int_customer_transactions", silver).count() == 20


def test_views(spark):
    silver = tables(spark)
    marts.create_views(spark, lambda name: marts.model(spark, name, silver))
    assert spark.sql("SELECT count(*) AS n FROM stg_accounts JOIN customer_360_mart USING (customer_id)").first().n == 1
    for name in marts.MODELS:
        spark.catalog.dropTempView(name)


def test_schedule_clamps_to_month_end(spark):
    from ledgerline.plans.derive import installment_schedule
    rows = installment_schedule(tables(spark, loans=[dict(term_months=3), dict(loan_id=4, term_months=0)])("loans"))
    found = [(row.payment_number, row.due_date.isoformat(), row.amount) for row in rows.orderBy("payment_number").collect()]
    assert found == [(1, "2024-04-30T10:30:00", 340.0), (2, "2024-05-31T10:30:00", 340.0), (3, "2024-06-30T10:30:00", 340.0)]
