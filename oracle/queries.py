"""One query per registered key, over the tables of oracle.inputs and oracle.layers."""

from __future__ import annotations

from oracle.layers import KEYS, cents, fine

QUERIES: dict[str, str] = {}

DATES = {
    "customers": "created_at", "accounts": "opened_at", "merchants": "created_at",
    "transactions": "transaction_timestamp", "cards": "issued_at", "loans": "created_at", "loan_payments": "due_date",
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _summary(prefix: str) -> str:
    return _union([
        f"SELECT '{name}' AS entity, count(*) AS row_count, CAST(sum({key}) AS BIGINT) AS key_total, "
        f"count({DATES[name]}) AS dated_rows, min({DATES[name]}) AS first_date, max({DATES[name]}) AS last_date "
        f"FROM {prefix}_{name}"
        for name, key in KEYS.items()
    ])


def _keys(dataset: str, table: str, key: str) -> str:
    columns = key.split(",")
    null = " OR ".join(f"{column} IS NULL" for column in columns)
    return f"""
        SELECT '{dataset}' AS dataset, '{key}' AS key_columns, total, distinct_keys,
          total - distinct_keys AS duplicates, null_keys,
          CASE WHEN total = distinct_keys AND null_keys = 0 THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT (SELECT count(*) FROM {table}) AS total,
          (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) AS distinct_keys,
          (SELECT count(*) FROM {table} WHERE {null}) AS null_keys)"""


def _check(check: str, scope: str, actual: str, expected: str) -> str:
    return f"""
        SELECT '{check}' AS "check", '{scope}' AS scope, actual, expected,
          CASE WHEN actual = expected THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT CAST(({actual}) AS BIGINT) AS actual, CAST(({expected}) AS BIGINT) AS expected)"""


def _info(check: str, scope: str, actual: str) -> str:
    return (f"""SELECT '{check}' AS "check", '{scope}' AS scope, CAST(({actual}) AS BIGINT) AS actual, """
            f"CAST(NULL AS BIGINT) AS expected, 'INFO' AS status")


def _rows(table: str, condition: str = "true") -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def _orphans(child: str, column: str, parent: str, key: str) -> str:
    return (f"SELECT count(*) FROM {child} x LEFT JOIN (SELECT DISTINCT {key} AS parent FROM {parent}) y "
            f"ON x.{column} = y.parent WHERE y.parent IS NULL")


REFERENCES = (
    ("accounts", "customer_id", "customers"), ("transactions", "account_id", "accounts"),
    ("transactions", "merchant_id", "merchants"), ("cards", "account_id", "accounts"),
    ("loans", "customer_id", "customers"), ("loan_payments", "loan_id", "loans"),
)


def _references(prefix: str, optional_merchant: bool) -> str:
    parts = []
    for child, column, parent in REFERENCES:
        counted = _orphans(f"{prefix}_{child}", column, f"{prefix}_{parent}", KEYS[parent])
        if optional_merchant and column == "merchant_id":
            counted += " AND x.merchant_id IS NOT NULL"
        parts.append(_check(f"{child}_{column}", child, counted, "0"))
    return _union(parts)


def _tests(model: str, table: str, not_null: str, unique: str = "") -> list[str]:
    tests = [(column, "not_null", _rows(table, f"{column} IS NULL")) for column in not_null.split()]
    tests += [
        (column, "unique", f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
                           f"GROUP BY {column} HAVING count(*) > 1)")
        for column in unique.split()
    ]
    return [
        f"SELECT '{model}' AS model, '{column}' AS column_name, '{test}' AS test, failures, "
        f"CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT ({counted}) AS failures)"
        for column, test, counted in tests
    ]


def _counts(table: str, column: str) -> str:
    return f"SELECT {column} AS value, count(*) AS row_count FROM {table} GROUP BY 1"


def _profile(table: str, kind: str, amount: str) -> str:
    value = lambda expression: f"CAST(floor(CAST({expression} AS DOUBLE) * 1e2 + 0.50001E0) AS DOUBLE) / 1e2"
    parts = [
        f"SELECT '{column}' AS section, {column} AS item, CAST(count(*) AS DOUBLE) AS value FROM {table} "
        f"WHERE {column} IS NOT NULL GROUP BY {column}"
        for column in (kind, "status")
    ]
    numbers = {
        "count": f"count({amount})", "mean": f"avg({amount})", "std": f"stddev_samp({amount})",
        "min": f"min({amount})", "max": f"max({amount})", "total": f"sum({amount})",
        "q25": f"quantile_cont({amount}, 0.25)", "q50": f"quantile_cont({amount}, 0.5)",
        "q75": f"quantile_cont({amount}, 0.75)",
    }
    parts += [f"SELECT '{amount}', '{name}', {value(text)} FROM {table}" for name, text in numbers.items()]
    return _union(parts)


TYPES = {
    "customers": "customer_id bigint, first_name string, last_name string, birth_date date, document string, "
                 "email string, phone string, city string, state string, customer_segment string, "
                 "created_at timestamp_ntz",
    "accounts": "account_id bigint, customer_id bigint, account_type string, branch string, account_number string, "
                "status string, opened_at timestamp_ntz, closed_at timestamp_ntz",
    "merchants": "merchant_id bigint, merchant_name string, merchant_category string, city string, state string, "
                 "created_at timestamp_ntz",
    "transactions": "transaction_id bigint, account_id bigint, transaction_type string, amount double, "
                    "currency string, status string, transaction_timestamp timestamp_ntz, merchant_id bigint, "
                    "description string",
    "cards": "card_id bigint, account_id bigint, card_type string, brand string, status string, "
             "credit_limit double, issued_at timestamp_ntz, expires_at timestamp_ntz",
    "loans": "loan_id bigint, customer_id bigint, loan_type string, principal_amount double, "
             "interest_rate double, term_months bigint, status string, created_at timestamp_ntz",
    "loan_payments": "payment_id bigint, loan_id bigint, payment_number bigint, due_date timestamp_ntz, "
                     "payment_date timestamp_ntz, amount double, status string",
}


def _profile_columns() -> str:
    parts = []
    for name, text in TYPES.items():
        columns = [column.split() for column in text.split(", ")]
        for column, kind in columns:
            parts.append(
                f"SELECT '{name}' AS entity, '{column}' AS column_name, '{kind}' AS data_type, row_count, "
                f"CAST({len(columns)} AS BIGINT) AS column_count, null_count, "
                f"{fine('(null_count * 100 / row_count)', 'null_percent')} "
                f"FROM (SELECT count(*) AS row_count, count(*) - count({column}) AS null_count FROM in_{name})"
            )
    return _union(parts)


# Sources and sinks
QUERIES.update({
    "scan_generated": _summary("in"),
    "scan_bronze": "SELECT * FROM br_transactions",
    "scan_silver": _summary("si"),
    "scan_gold": "SELECT * FROM go_daily",
    "scan_glob_hive": "SELECT * FROM si_transactions",
    "scan_catalog_table": "SELECT * FROM go_c360",
    "bronze_ingest": _union([
        f"SELECT '{name}' AS entity, year, month, count(*) AS row_count, CAST(sum({key}) AS BIGINT) AS key_total "
        f"FROM br_{name} GROUP BY year, month" for name, key in KEYS.items()
    ]),
    "normalize_timestamps": "SELECT card_id, issued_at, expires_at FROM in_cards",
    "sink_overwrite_flat": "SELECT * FROM si_customers",
    "sink_overwrite_partitioned": "SELECT * FROM si_transactions",
    "sink_daily_partitioned": f"""
        SELECT CAST(transaction_timestamp AS DATE) AS transaction_date,
          count(DISTINCT (transaction_type, status)) AS groups, count(*) AS transaction_count,
          {cents('sum(amount)', 'total_amount')} FROM si_transactions GROUP BY 1""",
    "quarantine_sink": _union([
        f"SELECT '{name}' AS entity, quality_error, count(*) AS error_count FROM qu_{name} GROUP BY quality_error"
        for name in KEYS
    ]),
})

# Silver
for _name in KEYS:
    QUERIES[f"norm_{_name}"] = f"SELECT * FROM nm_{_name}"
    QUERIES[f"validate_{_name}"] = f"SELECT * FROM va_{_name}"
    QUERIES[f"dup_{_name}"] = f"SELECT * FROM du_{_name}"
    QUERIES[f"silver_{_name}"] = f"SELECT * FROM si_{_name}"
    QUERIES[f"quarantine_{_name}"] = f"SELECT * FROM qu_{_name}"
    QUERIES[f"errors_{_name}"] = f"SELECT quality_error, count(*) AS error_count FROM qu_{_name} GROUP BY 1"
QUERIES.update({
    "fk_accounts_customer": "SELECT * FROM fk_accounts",
    "fk_transactions_account": "SELECT * FROM fk_transactions",
    "fk_cards_account": "SELECT * FROM fk_cards",
    "fk_loans_customer": "SELECT * FROM fk_loans",
    "fk_payments_loan": "SELECT * FROM fk_loan_payments",
    "rule_cards_savings": "SELECT * FROM savings_cards",
    "quality_counts": _union([
        f"SELECT '{name}' AS entity, count(*) AS total_rows, "
        f"count(*) - count(quality_error) AS valid_rows, count(quality_error) AS invalid_rows FROM ck_{name}"
        for name in KEYS
    ]),
})

# Gold
QUERIES.update({
    "gold_daily_transaction_summary": "SELECT * FROM go_daily",
    "gold_customer_transaction_metrics": "SELECT * FROM go_customer",
    "gold_merchant_performance": "SELECT * FROM go_merchant",
    "gold_loan_portfolio": "SELECT * FROM go_loan",
    "gold_customer_360": "SELECT * FROM go_c360",
    "top_merchants": "SELECT * FROM go_merchant ORDER BY total_transaction_amount DESC, merchant_id LIMIT 10",
    "loan_status_counts": "SELECT status AS loan_status, count(*) AS loan_count FROM si_loans GROUP BY 1",
    "customer_segment_counts": "SELECT customer_segment, count(*) AS customer_count FROM si_customers GROUP BY 1",
    "c360_account_metrics": "SELECT * FROM pt_account",
    "c360_transaction_metrics": "SELECT * FROM pt_transaction",
    "c360_card_metrics": "SELECT * FROM pt_card",
    "c360_loan_metrics": "SELECT * FROM pt_loan",
    "c360_payment_metrics": "SELECT * FROM pt_payment",
})

# SQL models
QUERIES.update({f"stg_{name}": f"SELECT * FROM st_{name}" for name in KEYS})
QUERIES.update({
    "int_customer_transactions": "SELECT * FROM ma_customer_tx",
    "int_merchant_transactions": "SELECT * FROM ma_merchant_tx",
    "int_loan_payments": "SELECT * FROM ma_loan_payments",
    "int_customer_loans": "SELECT * FROM ma_customer_loans",
    "fct_daily_transactions": "SELECT * FROM go_daily",
    "fct_customer_transactions": "SELECT * FROM ma_customer_fact",
    "fct_merchant_performance": "SELECT * FROM ma_merchant_fact",
    "fct_loan_portfolio": "SELECT * FROM ma_loan_fact",
    "customer_360_mart": "SELECT * FROM ma_c360",
})

# Quality assurance
_TYPES = "('PIX', 'CARD_PURCHASE', 'TRANSFER', 'DEPOSIT', 'WITHDRAWAL', 'TED', 'DOC')"
_STATUSES = "('COMPLETED', 'PENDING', 'FAILED', 'CANCELLED')"
QUERIES.update({
    "qa_silver_pk": _union([_keys(name, f"si_{name}", key) for name, key in KEYS.items()]),
    "qa_fk": _references("si", optional_merchant=True),
    "qa_business_rules": _union([
        _check("savings_with_credit_card", "cards",
               "SELECT count(*) FROM si_cards c JOIN si_accounts a ON c.account_id = a.account_id "
               "WHERE a.account_type = 'SAVINGS' AND c.card_type = 'CREDIT'", "0"),
        _check("invalid_transaction_type", "transactions",
               _rows("si_transactions", f"transaction_type NOT IN {_TYPES}"), "0"),
        _check("invalid_transaction_status", "transactions",
               _rows("si_transactions", f"status NOT IN {_STATUSES}"), "0"),
        _check("card_purchase_without_merchant", "transactions",
               _rows("si_transactions", "transaction_type = 'CARD_PURCHASE' AND merchant_id IS NULL"), "0"),
        _check("credit_limit_violation", "cards", _rows(
            "si_cards", "(card_type = 'CREDIT' AND credit_limit IS NULL) OR "
                        "(card_type = 'DEBIT' AND credit_limit IS NOT NULL)"), "0"),
        _check("paid_without_date", "loan_payments",
               _rows("si_loan_payments", "status = 'PAID' AND payment_date IS NULL"), "0"),
        _check("pending_with_date", "loan_payments",
               _rows("si_loan_payments", "status = 'PENDING' AND payment_date IS NOT NULL"), "0"),
    ]),
    **{
        f"dist_{entity}_{column}": _counts(f"si_{entity}", column)
        for entity, columns in {
            "transactions": "transaction_type status currency", "cards": "card_type status brand",
            "loans": "loan_type status", "loan_payments": "status",
        }.items() for column in columns.split()
    },
    "stats_transactions": f"""
        SELECT count(*) AS transactions, {cents('sum(amount)', 'total_amount')},
          {fine('avg(amount)', 'average_amount')}, min(amount) AS minimum_amount, max(amount) AS maximum_amount
        FROM si_transactions""",
    "stats_loans": f"""
        SELECT count(*) AS loans, {cents('sum(principal_amount)', 'total_principal')},
          {fine('avg(principal_amount)', 'average_principal')}, {fine('avg(interest_rate)', 'average_interest_rate')}
        FROM si_loans""",
    "stats_payments": f"""
        SELECT count(*) AS payments, {cents('sum(amount)', 'total_amount')}, {fine('avg(amount)', 'average_amount')}
        FROM si_loan_payments""",
    "null_counts": _union([
        f"SELECT '{column}' AS column_name, count(*) - count({column}) AS null_count FROM si_transactions"
        for column in ("transaction_id", "account_id", "transaction_type", "amount", "currency", "status",
                       "transaction_timestamp", "merchant_id", "description")
    ]),
    "qa_gold_composite_key": _keys(
        "daily_transaction_summary", "go_daily", "transaction_date,transaction_type,status"),
    "qa_gold_pk": _union([
        _keys("customer_transaction_metrics", "go_customer", "customer_id"),
        _keys("merchant_performance", "go_merchant", "merchant_id"),
        _keys("loan_portfolio", "go_loan", "loan_id"),
        _keys("customer_360", "go_c360", "customer_id"),
    ]),
    "recon_daily": _union([
        _check("transactions", "daily_transaction_summary",
               "SELECT sum(transaction_count) FROM go_daily", _rows("si_transactions")),
        _check("invalid_total_amount", "daily_transaction_summary", _rows("go_daily", "total_amount <= 0"), "0"),
    ]),
    "recon_customer_tx": _union([
        _check("transactions", "customer_transaction_metrics",
               "SELECT sum(transaction_count) FROM go_customer", _rows("si_transactions")),
        _info("customers_with_transactions", "customer_transaction_metrics", _rows("go_customer")),
        _check("negative_metrics", "customer_transaction_metrics",
               _rows("go_customer", "transaction_count < 0 OR total_transaction_amount < 0"), "0"),
    ]),
    "recon_merchant": _union([
        _check("merchant_transactions", "merchant_performance",
               "SELECT sum(transaction_count) FROM go_merchant", _rows("si_transactions", "merchant_id IS NOT NULL")),
        _check("negative_metrics", "merchant_performance",
               _rows("go_merchant", "transaction_count < 0 OR total_transaction_amount < 0"), "0"),
    ]),
    "recon_loan": _union([
        _check("loans", "loan_portfolio", _rows("go_loan"), _rows("si_loans")),
        _check("payments", "loan_portfolio", "SELECT sum(total_payments) FROM go_loan", _rows("si_loan_payments")),
        _check("negative_remaining", "loan_portfolio", _rows("go_loan", "remaining_amount < 0"), "0"),
    ]),
    "recon_c360": _union([
        _check("customers", "customer_360", _rows("go_c360"), _rows("si_customers")),
        *(_check(part, "customer_360", f"SELECT sum(total_{part}) FROM go_c360", _rows(f"si_{part}"))
          for part in ("accounts", "transactions", "cards", "loans")),
        _check("negative_metrics", "customer_360", _rows(
            "go_c360", "total_accounts < 0 OR total_transactions < 0 OR total_cards < 0 OR total_loans < 0 "
                       "OR total_loan_payments < 0"), "0"),
    ]),
    "dt_staging": _union(_tests("stg_customers", "st_customers", "customer_id customer_segment", "customer_id")),
    "dt_intermediate": _union([
        *_tests("int_customer_transactions", "ma_customer_tx", "transaction_id customer_id", "transaction_id"),
        *_tests("int_merchant_transactions", "ma_merchant_tx", "transaction_id merchant_id", "transaction_id"),
        *_tests("int_loan_payments", "ma_loan_payments", "payment_id loan_id", "payment_id"),
        *_tests("int_customer_loans", "ma_customer_loans", "customer_id", "customer_id"),
    ]),
    "dt_marts": _union([
        *_tests("fct_daily_transactions", "go_daily", "transaction_date transaction_type status"),
        *_tests("fct_merchant_performance", "ma_merchant_fact", "merchant_id merchant_name", "merchant_id"),
        *_tests("fct_loan_portfolio", "ma_loan_fact", "loan_id customer_id", "loan_id"),
        *_tests("fct_customer_transactions", "ma_customer_fact", "customer_id", "customer_id"),
        *_tests("customer_360_mart", "ma_c360", "customer_id", "customer_id"),
    ]),
})

# Raw profile
QUERIES.update({
    "profile_columns": _profile_columns(),
    "profile_duplicate_rows": _union([
        f"SELECT '{name}' AS entity, (SELECT count(*) FROM in_{name}) - "
        f"(SELECT count(*) FROM (SELECT DISTINCT * FROM in_{name})) AS duplicate_rows" for name in KEYS
    ]),
    "profile_pk": _union([_keys(name, f"in_{name}", key) for name, key in KEYS.items()]),
    "profile_fk": _references("in", optional_merchant=False),
    "profile_transactions": _profile("in_transactions", "transaction_type", "amount"),
    "profile_loans": _profile("in_loans", "loan_type", "principal_amount"),
    "card_merchant_check": _union([
        _info("card_purchases", "transactions", _rows("in_transactions", "transaction_type = 'CARD_PURCHASE'")),
        _check("missing_merchant", "transactions",
               _rows("in_transactions", "transaction_type = 'CARD_PURCHASE' AND merchant_id IS NULL"), "0"),
        _check("invalid_merchant", "transactions",
               _orphans("in_transactions", "merchant_id", "in_merchants", "merchant_id")
               + " AND x.transaction_type = 'CARD_PURCHASE'", "0"),
    ]),
    "amount_outliers_iqr": f"""
        SELECT {fine('q1', 'q1')}, {fine('q3', 'q3')}, {fine('(q3 + 1.5E0 * (q3 - q1))', 'upper_limit')},
          (SELECT count(*) FROM in_transactions WHERE amount > q3 + 1.5E0 * (q3 - q1)) AS outliers
        FROM (SELECT quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM in_transactions)""",
})

# Publication and derived tables
_PUBLISHED = {
    "daily_transaction_summary": "go_daily", "customer_transaction_metrics": "go_customer",
    "merchant_performance": "go_merchant", "loan_portfolio": "go_loan", "customer_360": "go_c360",
}
QUERIES.update({
    "publish_nonempty_guard": _union([
        f"SELECT '{name}' AS table_name, count(*) AS row_count, "
        f"CASE WHEN count(*) > 0 THEN 'publish' ELSE 'refuse' END AS verdict FROM {table}"
        for name, table in {
            **_PUBLISHED, "customer_360_without_customers": "go_c360 WHERE customer_id IS NULL",
        }.items()
    ]),
    "publish_prepare": "SELECT * FROM go_customer",
    "publish_create": "SELECT * FROM go_daily",
    "publish_overwrite_partitions": """
        SELECT * FROM go_daily WHERE status = 'COMPLETED' OR transaction_date NOT IN
          (SELECT transaction_date FROM go_daily WHERE status = 'COMPLETED')""",
    "publish_schema_check": """
        SELECT (SELECT count(*) FROM go_c360) AS row_count, column_name, finding, detail FROM (VALUES
          ('blocked_accounts', 'missing', 'bigint'), ('closed_accounts', 'missing', 'bigint'),
          ('completed_transactions', 'missing', 'bigint'), ('failed_transactions', 'missing', 'bigint'),
          ('pending_transactions', 'missing', 'bigint'), ('cancelled_transactions', 'missing', 'bigint'),
          ('debit_cards', 'missing', 'bigint'), ('total_cards', 'type', 'string <> bigint'),
          ('total_loans', 'extra', 'bigint')) AS f(column_name, finding, detail)""",
    "publish_count_check": _union([
        _check("rows", name, _rows(table), _rows(table))
        for name, table in _PUBLISHED.items()
    ] + [
        _check("rows", "daily_transaction_summary_without_first_day", _rows("go_daily"), _rows(
            "go_daily", "transaction_date IS DISTINCT FROM (SELECT min(transaction_date) FROM go_daily)"))
    ]),
    "publish_history": """
        SELECT 'merchant_performance' AS table_name, 'overwrite' AS operation,
          (SELECT count(*) FROM go_merchant) AS record_count FROM range(5)""",
    "installment_schedule": """
        SELECT loan_id, payment_number, created_at + to_months(CAST(payment_number AS INTEGER)) AS due_date,
          CAST(round(CAST(principal_amount * (1.0E0 + interest_rate / 100) / term_months AS DECIMAL(28, 10)), 2)
            AS DOUBLE) AS amount
        FROM (SELECT *, unnest(generate_series(1, term_months)) AS payment_number FROM si_loans)""",
    "eligible_card_accounts": """
        SELECT account_id, account_type,
          CASE WHEN account_type = 'SAVINGS' THEN 'DEBIT' ELSE 'DEBIT,CREDIT' END AS allowed_card_types
        FROM si_accounts WHERE status = 'ACTIVE'""",
})
