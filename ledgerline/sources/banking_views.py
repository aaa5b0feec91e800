"""Banking-shaped views over the supplied order, customer, supplier, lineitem and event tables.

Every row of a source table becomes a row of its entity. `k` is the source key; its remainder decides which planted
defect a row carries, so that each validation rule has rows to find. Some rows are planted twice (`twice`), to give the
duplicate rules work. The column expressions are plain SQL, so a check in another engine can use the same inputs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.model import ENTITIES
from ledgerline.plans.bronze import add_partition_columns
from ledgerline.sources.files import conform


@dataclass(frozen=True)
class View:
    source: str
    key: str
    columns: dict[str, str]
    twice: str = ""  # condition on k: such rows are planted twice


VIEWS: dict[str, View] = {
    "customers": View(
        "customer", "c_custkey",
        {
            "customer_id": "CASE WHEN k%50=1 THEN NULL ELSE k END",
            "first_name": "CASE WHEN k%50=2 THEN ' ' ELSE concat(' ',c_name,' ') END",
            "last_name": "CASE WHEN k%50=3 THEN NULL ELSE n_name END",
            "birth_date": "CASE WHEN k%50=7 THEN NULL WHEN k%50=8 THEN DATE '2030-01-01' ELSE DATE '1980-06-15' END",
            "document": "CASE WHEN k%50=4 THEN '' ELSE concat('D',k) END",
            "email": "CASE WHEN k%50 IN (2,5) THEN NULL ELSE concat(' User',k,'@Example.COM') END",
            "phone": "concat('55-',k)",
            "city": "n_name",
            "state": "lower(r_name)",
            "customer_segment": (
                "CASE WHEN k%50=6 THEN 'VIP' WHEN k%50=11 THEN NULL WHEN c_mktsegment IN ('BUILDING','MACHINERY') "
                "THEN ' basic ' WHEN c_mktsegment='FURNITURE' THEN 'Premium' ELSE 'STANDARD' END"
            ),
            "created_at": "CASE WHEN k%50=9 THEN NULL ELSE TIMESTAMP '2020-01-01 10:00:00' END",
        },
        twice="k%50=10",
    ),
    "merchants": View(
        "supplier", "s_suppkey",
        {
            "merchant_id": "CASE WHEN k%20=1 THEN NULL ELSE k END",
            "merchant_name": "CASE WHEN k%20=2 THEN ' ' ELSE concat(' ',s_name) END",
            "merchant_category": (
                "CASE WHEN k%20=3 THEN 'CASINO' WHEN k%4=0 THEN 'travel ' WHEN k%4=1 THEN 'PHARMACY' "
                "WHEN k%4=2 THEN 'Services' ELSE 'OTHER' END"
            ),
            "city": "CASE WHEN k%20=4 THEN NULL ELSE n_name END",
            "state": "CASE WHEN k%20=5 THEN 'XX' WHEN k%2=0 THEN 'sp' ELSE 'RJ' END",
            "created_at": "CASE WHEN k%20=6 THEN NULL ELSE TIMESTAMP '2021-03-01 00:00:00' END",
        },
        twice="k%20=7",
    ),
    "accounts": View(
        "orders", "o_orderkey",
        {
            "account_id": "CASE WHEN k%50=1 THEN NULL ELSE k END",
            "customer_id": "CASE WHEN k%50=2 THEN NULL WHEN k%50=10 THEN k+900000000 ELSE o_custkey END",
            "account_type": (
                "CASE WHEN k%50=5 THEN 'JOINT' ELSE CASE o_orderpriority WHEN '1-URGENT' THEN ' checking' "
                "WHEN '3-MEDIUM' THEN 'SAVINGS' WHEN '5-LOW' THEN 'SAVINGS' ELSE 'CHECKING' END END"
            ),
            "branch": "CASE WHEN k%50=3 THEN ' ' ELSE concat('B',k%1000) END",
            "account_number": "CASE WHEN k%50=4 THEN NULL ELSE concat('N',k) END",
            "status": (
                "CASE WHEN k%50=6 THEN 'FROZEN' WHEN k%50=8 THEN 'CLOSED' WHEN k%50=9 THEN 'ACTIVE' "
                "WHEN o_orderstatus='O' THEN 'active ' WHEN o_orderstatus='P' THEN 'BLOCKED' ELSE 'CLOSED' END"
            ),
            "opened_at": "CASE WHEN k%50=7 THEN NULL ELSE o_orderdate END",
            "closed_at": (
                "CASE WHEN k%50=8 THEN NULL WHEN k%50=9 OR o_orderstatus='F' THEN o_orderdate + INTERVAL '60' DAY END"
            ),
        },
        twice="k%50=11",
    ),
    "transactions": View(
        "lineitem", "l_orderkey",
        {
            "transaction_id": "CASE WHEN k%50=12 THEN NULL ELSE k*10+l_linenumber END",
            "account_id": "CASE WHEN k%50=13 THEN NULL WHEN k%50=19 THEN k+900000000 ELSE k END",
            "transaction_type": (
                "CASE WHEN k%50=16 THEN 'BOLETO' WHEN k%50=18 THEN 'CARD_PURCHASE' ELSE CASE l_linenumber%7 "
                "WHEN 0 THEN 'PIX' WHEN 1 THEN 'card_purchase' WHEN 2 THEN 'TRANSFER' WHEN 3 THEN ' DEPOSIT' "
                "WHEN 4 THEN 'WITHDRAWAL' WHEN 5 THEN 'TED' ELSE 'DOC' END END"
            ),
            "amount": "CASE WHEN k%50=14 THEN -l_extendedprice ELSE l_extendedprice END",
            "currency": "CASE WHEN k%50=15 THEN 'USD' ELSE 'brl' END",
            "status": (
                "CASE WHEN k%50=17 THEN 'REVERSED' WHEN l_returnflag='A' OR (l_returnflag='R' AND l_linestatus='O') "
                "THEN 'completed' WHEN l_returnflag='R' THEN 'CANCELLED' WHEN l_linestatus='O' THEN 'PENDING' "
                "ELSE 'FAILED' END"
            ),
            "transaction_timestamp": "l_shipdate",
            "merchant_id": "CASE WHEN k%50<>18 AND l_linenumber%7=1 THEN l_suppkey END",
            "description": "concat(' tx ',l_linenumber)",
        },
    ),
    "cards": View(
        "events", "event_id",
        {
            "card_id": "CASE WHEN k%50=21 THEN NULL ELSE k END",
            "account_id": "CASE WHEN k%50=22 THEN NULL WHEN k%50=31 THEN k+900000000 ELSE k END",
            "card_type": "CASE WHEN k%50=24 THEN 'PREPAID' WHEN ct='C' THEN 'credit' ELSE 'DEBIT' END",
            "brand": "CASE WHEN k%50=23 THEN ' ' WHEN k%2=0 THEN 'visa' ELSE 'MASTERCARD' END",
            "status": (
                "CASE WHEN k%50=25 THEN 'LOST' WHEN event_type='error' THEN 'BLOCKED' WHEN event_type='signup' "
                "THEN 'EXPIRED' WHEN k%9=0 THEN 'CANCELLED' ELSE 'ACTIVE' END"
            ),
            "credit_limit": "CASE WHEN k%50=29 THEN NULL WHEN ct='C' OR k%50=30 THEN 1000.0E0 + k END",
            "issued_at": "CASE WHEN k%50=26 THEN NULL ELSE ts END",
            "expires_at": "CASE WHEN k%50=27 THEN NULL WHEN k%50=28 THEN ts ELSE ts + INTERVAL '1000' DAY END",
        },
        twice="k%50=33",
    ),
    "loans": View(
        "orders", "o_orderkey",
        {
            "loan_id": "CASE WHEN k%50=1 THEN NULL ELSE k END",
            "customer_id": "CASE WHEN k%50=2 THEN NULL WHEN k%50=9 THEN k+900000000 ELSE o_custkey END",
            "loan_type": (
                "CASE WHEN k%50=3 THEN 'HOME' WHEN k%4=0 THEN 'payroll' WHEN k%4=1 THEN 'AUTO' ELSE 'PERSONAL' END"
            ),
            "principal_amount": "CASE WHEN k%50=4 THEN 0.0E0 ELSE o_totalprice END",
            "interest_rate": "CASE WHEN k%50=5 THEN NULL ELSE 1.0E0+(k%40)/10.0E0 END",
            "term_months": "CASE WHEN k%50=6 THEN 0 ELSE 6+6*(k%8) END",
            "status": (
                "CASE WHEN k%50=7 THEN 'FROZEN' WHEN o_orderstatus='O' THEN 'active' WHEN o_orderstatus='F' "
                "THEN 'PAID' WHEN k%2=0 THEN 'DEFAULTED' ELSE 'CANCELLED' END"
            ),
            "created_at": "CASE WHEN k%50=8 THEN NULL ELSE o_orderdate END",
        },
        twice="k%50=10",
    ),
    "loan_payments": View(
        "lineitem", "l_orderkey",
        {
            "payment_id": "CASE WHEN k%50=21 THEN NULL ELSE k*10+l_linenumber END",
            "loan_id": "CASE WHEN k%50=22 THEN NULL WHEN k%50=29 THEN k+900000000 ELSE k END",
            "payment_number": "CASE WHEN k%50=23 THEN 0 ELSE l_linenumber END",
            "due_date": "CASE WHEN k%50=24 THEN NULL ELSE l_shipdate END",
            "payment_date": "CASE WHEN k%50=27 THEN NULL WHEN k%50=28 OR l_returnflag='A' THEN l_shipdate END",
            "amount": "CASE WHEN k%50=25 THEN 0.0E0 ELSE l_extendedprice END",
            "status": (
                "CASE WHEN k%50=26 THEN 'WAIVED' WHEN k%50=27 THEN 'PAID' WHEN k%50=28 THEN 'PENDING' "
                "WHEN l_returnflag='A' THEN 'paid ' WHEN l_returnflag='N' THEN 'PENDING' ELSE 'LATE' END"
            ),
        },
    ),
}

# Whether a planted card is a credit card (C) or a debit card (D).
CARD_KIND = (
    "CASE WHEN k%50 IN (29,32) THEN 'C' WHEN k%50=30 THEN 'D' "
    "WHEN event_type='purchase' AND o_orderpriority NOT IN ('3-MEDIUM','5-LOW') THEN 'C' ELSE 'D' END"
)


def generated(table: Callable[[str], DataFrame], entity: str) -> DataFrame:
    """The entity as generated, before Bronze adds year and month; `table` opens a supplied table by name."""
    view = VIEWS[entity]
    rows = table(view.source).withColumn("k", F.col(view.key))
    if entity == "customers":
        rows = rows.join(table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        rows = rows.join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    elif entity == "merchants":
        rows = rows.join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    elif entity == "cards":
        orders = table("orders").select("o_orderkey", "o_orderpriority")
        rows = rows.join(orders, F.col("event_id") == F.col("o_orderkey"), "left").withColumn("ct", F.expr(CARD_KIND))
    if view.twice:
        rows = rows.withColumn("copy", F.expr(f"explode(sequence(1, CASE WHEN {view.twice} THEN 2 ELSE 1 END))"))
    shaped = rows.selectExpr(*(f"{text} AS {name}" for name, text in view.columns.items()))
    return conform(shaped, ENTITIES[entity].columns)


def bronze(raw: DataFrame, entity: str) -> DataFrame:
    return add_partition_columns(raw, ENTITIES[entity].date_column)
