"""SQL of the queries over time, spans, differences, levels and combinations."""

from __future__ import annotations

import re

from oracle.layers import KEYS, LAYERS, cents

_CENTS = "CAST(round(amount * 100) AS BIGINT)"

HISTORY = """
  SELECT account_id, since, max(state) AS state FROM (
    SELECT account_id, opened_at AS since, 'OPENED' AS state FROM si_accounts
    UNION ALL SELECT account_id, closed_at, 'CLOSED' FROM si_accounts WHERE closed_at IS NOT NULL
    UNION ALL SELECT account_id, issued_at, 'HAS_' || card_type || '_CARD' FROM si_cards) GROUP BY account_id, since"""
WITH_STATE = f"""
  SELECT t.transaction_id, t.account_id, t.transaction_timestamp, t.amount, h.since, h.state
  FROM si_transactions t ASOF LEFT JOIN ({HISTORY}) h
    ON t.account_id = h.account_id AND t.transaction_timestamp >= h.since"""
SALES = """
  SELECT t.merchant_id, CAST(t.transaction_timestamp AS DATE) AS transaction_date, c.customer_segment, t.account_id
  FROM si_transactions t JOIN si_accounts a ON t.account_id = a.account_id JOIN si_customers c ON a.customer_id = c.customer_id
  WHERE t.merchant_id IS NOT NULL"""
METRICS = "SELECT customer_id, customer_segment, transaction_count, total_transaction_amount FROM go_customer"
UNCHECKED = f"""
  SELECT c.customer_id, c.customer_segment, x.transaction_count, x.total_transaction_amount FROM (
    SELECT a.customer_id, count(*) AS transaction_count, {cents('sum(amount)', 'total_transaction_amount')}
    FROM nm_transactions t JOIN nm_accounts a ON t.account_id = a.account_id GROUP BY 1) x
  JOIN nm_customers c ON x.customer_id = c.customer_id"""
MONTHLY = """
  SELECT m.state, t.year, t.month, t.merchant_id, m.merchant_name, count(*) AS transaction_count,
    CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS sales_cents
  FROM si_transactions t JOIN si_merchants m ON t.merchant_id = m.merchant_id GROUP BY 1, 2, 3, 4, 5"""

QUERIES: dict[str, str] = {
    "asof_account_state": WITH_STATE,
    "transactions_by_account_state": f"""
        SELECT coalesce(state, 'NOT_OPENED') AS state, count(*) AS transaction_count,
          CAST(floor(sum(amount) * 1e2 + 0.50001E0) AS DOUBLE) / 1e2 AS total_amount,
          CAST(max(date_diff('day', since, transaction_timestamp)) AS INTEGER) AS longest_days
        FROM ({WITH_STATE}) GROUP BY 1""",
    "open_accounts_at_payments": """
        SELECT p.payment_id, l.customer_id, count(*) AS open_accounts
        FROM si_loan_payments p JOIN si_loans l ON p.loan_id = l.loan_id JOIN si_accounts a ON a.customer_id = l.customer_id
        WHERE p.payment_date >= a.opened_at AND (a.closed_at IS NULL OR p.payment_date <= a.closed_at) GROUP BY 1, 2""",
    "overlapping_loans": """
        SELECT a.customer_id, a.loan_id AS loan_a, b.loan_id AS loan_b, greatest(a.created_at, b.created_at) AS overlap_from,
          least(a.ends, b.ends) AS overlap_until,
          CAST(date_diff('day', greatest(a.created_at, b.created_at), least(a.ends, b.ends)) AS INTEGER) AS overlap_days
        FROM (SELECT *, created_at + to_months(CAST(term_months AS INTEGER)) AS ends FROM si_loans) a
        JOIN (SELECT *, created_at + to_months(CAST(term_months AS INTEGER)) AS ends FROM si_loans) b
          ON a.customer_id = b.customer_id AND a.loan_id < b.loan_id AND a.created_at < b.ends AND b.created_at < a.ends""",
    "event_sessions": """
        SELECT user_id, session, min(ts) AS session_start, max(ts) AS session_end, count(*) AS event_count,
          count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
          CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
        FROM (SELECT *, CAST(sum(CASE WHEN earlier IS NULL OR ts > earlier + INTERVAL 6 HOURS THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session
              FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS earlier FROM events))
        GROUP BY user_id, session""",
    "event_running_totals": """
        SELECT event_id, user_id, ts, count(*) OVER w AS running_events,
          CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS running_cents
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "stream_event_windows": """
        SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS event_count,
          CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
        FROM events GROUP BY 1, 2""",
    "stream_event_sessions": """
        SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS event_count,
          CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_cents
        FROM (SELECT *, sum(CASE WHEN earlier IS NULL OR ts >= earlier + INTERVAL 6 HOURS THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
              FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS earlier FROM events))
        GROUP BY user_id, session""",
    "top_merchants_by_state_month": f"""
        SELECT state, year, month, CAST(rank AS INTEGER) AS rank, merchant_id, merchant_name, transaction_count, sales_cents,
          CAST((sales_cents * 10000) // all_cents AS BIGINT) AS share_basis_points
        FROM (SELECT *, row_number() OVER (PARTITION BY state, year, month ORDER BY sales_cents DESC, merchant_id) AS rank,
                sum(sales_cents) OVER (PARTITION BY state, year, month) AS all_cents FROM ({MONTHLY}))
        WHERE rank <= 3""",
    "customer_row_differences": f"""
        SELECT *, count(*) AS difference FROM ({METRICS} EXCEPT ALL {UNCHECKED}) GROUP BY ALL
        UNION ALL SELECT *, -count(*) FROM ({UNCHECKED} EXCEPT ALL {METRICS}) GROUP BY ALL""",
    "customer_reconciliation": f"""
        SELECT customer_id, CASE WHEN l.n > 1 OR r.n > 1 THEN 'repeated' WHEN r.n IS NULL THEN 'only_left'
            WHEN l.n IS NULL THEN 'only_right' ELSE 'changed' END AS status,
          CASE WHEN l.n = 1 AND r.n = 1 THEN concat_ws(',',
            CASE WHEN l.customer_segment IS DISTINCT FROM r.customer_segment THEN 'customer_segment' END,
            CASE WHEN l.transaction_count IS DISTINCT FROM r.transaction_count THEN 'transaction_count' END,
            CASE WHEN l.total_transaction_amount IS DISTINCT FROM r.total_transaction_amount
              THEN 'total_transaction_amount' END) END AS changed
        FROM (SELECT customer_id, count(*) AS n, any_value(customer_segment) AS customer_segment,
                any_value(transaction_count) AS transaction_count, any_value(total_transaction_amount) AS total_transaction_amount
              FROM ({METRICS} EXCEPT ALL {UNCHECKED}) GROUP BY 1) l
        FULL JOIN (SELECT customer_id, count(*) AS n, any_value(customer_segment) AS customer_segment,
                any_value(transaction_count) AS transaction_count, any_value(total_transaction_amount) AS total_transaction_amount
              FROM ({UNCHECKED} EXCEPT ALL {METRICS}) GROUP BY 1) r USING (customer_id)""",
    "bronze_silver_differences": """
        SELECT *, count(*) AS difference FROM (SELECT * FROM nm_accounts EXCEPT ALL SELECT * FROM si_accounts) GROUP BY ALL""",
    "account_cube": f"""
        SELECT merchant_id, transaction_date, customer_segment,
          CAST(grouping(merchant_id, transaction_date, customer_segment) AS BIGINT) AS level,
          count(DISTINCT account_id) AS accounts
        FROM ({SALES}) GROUP BY CUBE (merchant_id, transaction_date, customer_segment)""",
    "account_rollup": f"""
        SELECT merchant_id, transaction_date, customer_segment,
          CAST(grouping(customer_segment, transaction_date, merchant_id) AS BIGINT) AS level,
          count(DISTINCT account_id) AS accounts
        FROM ({SALES}) GROUP BY ROLLUP (customer_segment, transaction_date, merchant_id)""",
    "sketch_checks": """
        SELECT transaction_type, year, month, count(amount) AS n, count(DISTINCT account_id) AS distinct_ids,
          'PASS' AS distinct_check, 'PASS' AS quantile_check
        FROM si_transactions GROUP BY 1, 2, 3""",
    "allotted_payments": f"""
        SELECT * FROM (WITH due AS (
          SELECT *, due_until - due_cents AS due_before FROM (
            SELECT *, sum(due_cents) OVER (PARTITION BY loan_id ORDER BY payment_number) AS due_until FROM (
              SELECT loan_id, payment_number, CAST(round(100 * round(CAST(principal_amount * (1.0E0 + interest_rate / 100)
                / term_months AS DECIMAL(28, 10)), 2)) AS BIGINT) AS due_cents
              FROM (SELECT *, unnest(generate_series(1, term_months)) AS payment_number FROM si_loans)) WHERE due_cents > 0)
        ), paid AS (
          SELECT *, paid_until - paid_cents AS paid_before FROM (
            SELECT *, sum(paid_cents) OVER (PARTITION BY loan_id ORDER BY payment_date, payment_id) AS paid_until FROM (
              SELECT loan_id, payment_id, payment_date, {_CENTS} AS paid_cents FROM si_loan_payments WHERE status = 'PAID')
            WHERE paid_cents > 0)
        )
        SELECT d.loan_id, payment_number, payment_id,
          CAST(least(due_until, paid_until) - greatest(due_before, paid_before) AS BIGINT) AS allotted_cents
        FROM due d JOIN paid p ON d.loan_id = p.loan_id AND due_before < paid_until AND paid_before < due_until)""",
}



REFERENCES = {  # entity: (column, table of parents, their key, code)
    "accounts": ("customer_id", "br_customers", "customer_id", "INVALID_CUSTOMER_ID"),
    "transactions": ("account_id", "br_accounts", "account_id", "INVALID_ACCOUNT_ID"),
    "cards": ("account_id", "typed_accounts", "account_id", "INVALID_ACCOUNT_ID"),
    "loans": ("customer_id", "br_customers", "customer_id", "INVALID_CUSTOMER_ID"),
    "loan_payments": ("loan_id", "br_loans", "loan_id", "INVALID_LOAN_ID"),
}


def _codes(entity: str) -> str:
    """(row, key, codes): every code of every row; the row rules' conditions are those of the va_ table."""
    key = KEYS[entity]
    cases = [f"CASE WHEN {fails.strip()} THEN '{code}' END"
             for fails, code in re.findall(r"WHEN (.*?)\s+THEN '(\w+)'", LAYERS[f"va_{entity}"], re.DOTALL)]
    joins = ""
    if entity in REFERENCES:
        column, parents, parent_key, code = REFERENCES[entity]
        cases.append(f"CASE WHEN p.parent IS NULL THEN '{code}' END")
        joins += f" LEFT JOIN (SELECT DISTINCT {parent_key} AS parent FROM {parents}) p ON v.{column} = p.parent"
    if entity == "cards":
        cases.append("CASE WHEN s.kind = 'SAVINGS' AND card_type <> 'DEBIT' THEN 'INVALID_CARD_TYPE_FOR_SAVINGS' END")
        joins += (" LEFT JOIN (SELECT account_id AS owner, min(account_type) AS kind FROM br_accounts GROUP BY 1) s"
                  " ON v.account_id = s.owner")
    cases.append(f"CASE WHEN d.twin IS NOT NULL THEN 'DUPLICATE_{key.upper()}' END")
    joins += f" LEFT JOIN (SELECT {key} AS twin FROM nm_{entity} GROUP BY 1 HAVING count(*) > 1) d ON v.{key} = d.twin"
    return (f"SELECT row_number() OVER () AS row_no, {key}, [code FOR code IN [{', '.join(cases)}] IF code IS NOT NULL] AS codes "
            f"FROM nm_{entity} v{joins}")


def _combinations(entity: str) -> str:
    item = f"(SELECT row_no, unnest(codes) AS code FROM ({_codes(entity)}))"
    return f"""
        SELECT '{entity}' AS entity, codes, CAST(size AS BIGINT) AS size, row_count FROM (
          WITH item AS MATERIALIZED {item}
          SELECT code AS codes, 1 AS size, count(*) AS row_count FROM item GROUP BY 1
          UNION ALL SELECT a.code || ',' || b.code, 2, count(*) FROM item a JOIN item b
            ON a.row_no = b.row_no AND a.code < b.code GROUP BY 1
          UNION ALL SELECT a.code || ',' || b.code || ',' || c.code, 3, count(*) FROM item a JOIN item b
            ON a.row_no = b.row_no AND a.code < b.code JOIN item c ON b.row_no = c.row_no AND b.code < c.code GROUP BY 1)
        WHERE row_count >= 2"""


for _entity, _key in KEYS.items():
    QUERIES[f"failures_{_entity}"] = f"""
        SELECT {_key}, array_to_string(codes, ',') AS failures, CAST(len(codes) AS BIGINT) AS failure_count
        FROM ({_codes(_entity)}) WHERE len(codes) > 0"""
    QUERIES[f"incremental_silver_{_entity}"] = f"SELECT * FROM si_{_entity}"
QUERIES["incremental_quarantine_transactions"] = "SELECT * FROM qu_transactions"
QUERIES |= {f"incremental_gold_{model}": f"SELECT * FROM {table}" for model, table in (
    ("daily_transaction_summary", "go_daily"), ("customer_transaction_metrics", "go_customer"),
    ("merchant_performance", "go_merchant"), ("loan_portfolio", "go_loan"))}
QUERIES["failure_combinations"] = "\nUNION ALL ".join(_combinations(entity) for entity in KEYS)
