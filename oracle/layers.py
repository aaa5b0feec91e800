"""Normalised, checked, Silver, quarantine, Gold and mart tables as SQL."""

from __future__ import annotations

# The lists of allowed values, the error codes and the column names below.
LAYERS: dict[str, str] = {
    "nm_customers": """
        SELECT * REPLACE (trim(first_name) AS first_name, trim(last_name) AS last_name, trim(document) AS document,
          trim(phone) AS phone, trim(city) AS city, lower(trim(email)) AS email, upper(trim(state)) AS state,
          upper(trim(customer_segment)) AS customer_segment) FROM br_customers""",
    "nm_accounts": """
        SELECT * REPLACE (upper(trim(account_type)) AS account_type, upper(trim(status)) AS status,
          trim(branch) AS branch, trim(account_number) AS account_number) FROM br_accounts""",
    "nm_merchants": """
        SELECT * REPLACE (trim(merchant_name) AS merchant_name, trim(city) AS city, upper(trim(state)) AS state,
          upper(trim(merchant_category)) AS merchant_category) FROM br_merchants""",
    "nm_transactions": """
        SELECT * REPLACE (upper(trim(transaction_type)) AS transaction_type, upper(trim(status)) AS status,
          upper(trim(currency)) AS currency, trim(description) AS description) FROM br_transactions""",
    "nm_cards": """
        SELECT * REPLACE (upper(trim(card_type)) AS card_type, upper(trim(brand)) AS brand,
          upper(trim(status)) AS status) FROM br_cards""",
    "nm_loans": """
        SELECT * REPLACE (upper(trim(loan_type)) AS loan_type, upper(trim(status)) AS status) FROM br_loans""",
    "nm_loan_payments": "SELECT * REPLACE (upper(trim(status)) AS status) FROM br_loan_payments",
    "va_customers": """
        SELECT *, CASE WHEN customer_id IS NULL THEN 'NULL_CUSTOMER_ID'
          WHEN coalesce(trim(first_name), '') = '' THEN 'INVALID_FIRST_NAME'
          WHEN coalesce(trim(last_name), '') = '' THEN 'INVALID_LAST_NAME'
          WHEN coalesce(trim(document), '') = '' THEN 'INVALID_DOCUMENT'
          WHEN coalesce(trim(email), '') = '' THEN 'INVALID_EMAIL'
          WHEN customer_segment NOT IN ('BASIC', 'STANDARD', 'PREMIUM') THEN 'INVALID_CUSTOMER_SEGMENT'
          WHEN birth_date IS NULL THEN 'NULL_BIRTH_DATE'
          WHEN birth_date > created_at THEN 'INVALID_BIRTH_DATE'
          WHEN created_at IS NULL THEN 'NULL_CREATED_AT' END AS quality_error FROM nm_customers""",
    "va_accounts": """
        SELECT *, CASE WHEN account_id IS NULL THEN 'NULL_ACCOUNT_ID'
          WHEN customer_id IS NULL THEN 'NULL_CUSTOMER_ID'
          WHEN coalesce(trim(branch), '') = '' THEN 'INVALID_BRANCH'
          WHEN coalesce(trim(account_number), '') = '' THEN 'INVALID_ACCOUNT_NUMBER'
          WHEN account_type NOT IN ('CHECKING', 'SAVINGS') THEN 'INVALID_ACCOUNT_TYPE'
          WHEN status NOT IN ('ACTIVE', 'BLOCKED', 'CLOSED') THEN 'INVALID_STATUS'
          WHEN opened_at IS NULL THEN 'NULL_OPENED_AT'
          WHEN status = 'CLOSED' AND closed_at IS NULL THEN 'MISSING_CLOSED_AT'
          WHEN status <> 'CLOSED' AND closed_at IS NOT NULL THEN 'UNEXPECTED_CLOSED_AT' END AS quality_error
        FROM nm_accounts""",
    "va_merchants": """
        SELECT *, CASE WHEN merchant_id IS NULL THEN 'NULL_MERCHANT_ID'
          WHEN coalesce(trim(merchant_name), '') = '' THEN 'INVALID_MERCHANT_NAME'
          WHEN merchant_category NOT IN ('SUPERMARKET', 'RESTAURANT', 'GAS_STATION', 'PHARMACY', 'CLOTHING',
            'ELECTRONICS', 'ENTERTAINMENT', 'TRAVEL', 'SERVICES', 'OTHER') THEN 'INVALID_MERCHANT_CATEGORY'
          WHEN coalesce(trim(city), '') = '' THEN 'INVALID_CITY'
          WHEN state NOT IN ('AC', 'AL', 'AP', 'AM', 'BA', 'CE', 'DF', 'ES', 'GO', 'MA', 'MT', 'MS', 'MG', 'PA',
            'PB', 'PR', 'PE', 'PI', 'RJ', 'RN', 'RS', 'RO', 'RR', 'SC', 'SP', 'SE', 'TO') THEN 'INVALID_STATE'
          WHEN created_at IS NULL THEN 'NULL_CREATED_AT' END AS quality_error FROM nm_merchants""",
    "va_transactions": """
        SELECT *, CASE WHEN transaction_id IS NULL THEN 'NULL_TRANSACTION_ID'
          WHEN account_id IS NULL THEN 'NULL_ACCOUNT_ID'
          WHEN coalesce(amount, 0) <= 0 THEN 'INVALID_AMOUNT'
          WHEN currency <> 'BRL' THEN 'INVALID_CURRENCY'
          WHEN transaction_type NOT IN ('PIX', 'CARD_PURCHASE', 'TRANSFER', 'DEPOSIT', 'WITHDRAWAL', 'TED', 'DOC')
            THEN 'INVALID_TRANSACTION_TYPE'
          WHEN status NOT IN ('COMPLETED', 'PENDING', 'FAILED', 'CANCELLED') THEN 'INVALID_STATUS'
          WHEN transaction_type = 'CARD_PURCHASE' AND merchant_id IS NULL THEN 'MISSING_MERCHANT_ID'
          END AS quality_error FROM nm_transactions""",
    "va_cards": """
        SELECT *, CASE WHEN card_id IS NULL THEN 'NULL_CARD_ID'
          WHEN account_id IS NULL THEN 'NULL_ACCOUNT_ID'
          WHEN coalesce(trim(brand), '') = '' THEN 'INVALID_BRAND'
          WHEN card_type NOT IN ('DEBIT', 'CREDIT') THEN 'INVALID_CARD_TYPE'
          WHEN status NOT IN ('ACTIVE', 'BLOCKED', 'EXPIRED', 'CANCELLED') THEN 'INVALID_STATUS'
          WHEN issued_at IS NULL THEN 'NULL_ISSUED_AT'
          WHEN expires_at IS NULL THEN 'NULL_EXPIRES_AT'
          WHEN expires_at <= issued_at THEN 'INVALID_EXPIRATION_DATE'
          WHEN card_type = 'CREDIT' AND credit_limit IS NULL THEN 'MISSING_CREDIT_LIMIT'
          WHEN card_type = 'DEBIT' AND credit_limit IS NOT NULL THEN 'UNEXPECTED_CREDIT_LIMIT'
          END AS quality_error FROM nm_cards""",
    "va_loans": """
        SELECT *, CASE WHEN loan_id IS NULL THEN 'NULL_LOAN_ID'
          WHEN customer_id IS NULL THEN 'NULL_CUSTOMER_ID'
          WHEN loan_type NOT IN ('PERSONAL', 'PAYROLL', 'AUTO') THEN 'INVALID_LOAN_TYPE'
          WHEN coalesce(principal_amount, 0) <= 0 THEN 'INVALID_PRINCIPAL_AMOUNT'
          WHEN coalesce(interest_rate, -1) < 0 THEN 'INVALID_INTEREST_RATE'
          WHEN coalesce(term_months, 0) <= 0 THEN 'INVALID_TERM_MONTHS'
          WHEN status NOT IN ('ACTIVE', 'PAID', 'DEFAULTED', 'CANCELLED') THEN 'INVALID_STATUS'
          WHEN created_at IS NULL THEN 'NULL_CREATED_AT' END AS quality_error FROM nm_loans""",
    "va_loan_payments": """
        SELECT *, CASE WHEN payment_id IS NULL THEN 'NULL_PAYMENT_ID'
          WHEN loan_id IS NULL THEN 'NULL_LOAN_ID'
          WHEN coalesce(payment_number, 0) <= 0 THEN 'INVALID_PAYMENT_NUMBER'
          WHEN due_date IS NULL THEN 'NULL_DUE_DATE'
          WHEN coalesce(amount, 0) <= 0 THEN 'INVALID_AMOUNT'
          WHEN status NOT IN ('PAID', 'PENDING', 'LATE') THEN 'INVALID_STATUS'
          WHEN status = 'PAID' AND payment_date IS NULL THEN 'MISSING_PAYMENT_DATE'
          WHEN status = 'PENDING' AND payment_date IS NOT NULL THEN 'UNEXPECTED_PAYMENT_DATE'
          END AS quality_error FROM nm_loan_payments""",
}


def _referenced(rows: str, column: str, parents: str, parent_key: str, code: str) -> str:
    return f"""
        SELECT v.* REPLACE (coalesce(quality_error, CASE WHEN p.parent IS NULL THEN '{code}' END) AS quality_error)
        FROM {rows} v LEFT JOIN (SELECT DISTINCT {parent_key} AS parent FROM {parents}) p ON v.{column} = p.parent"""


def _deduplicated(rows: str, key: str) -> str:
    return f"""
        SELECT v.* REPLACE (coalesce(quality_error, CASE WHEN d.twin IS NOT NULL THEN 'DUPLICATE_{key.upper()}' END)
          AS quality_error)
        FROM {rows} v LEFT JOIN (SELECT {key} AS twin FROM {rows} GROUP BY {key} HAVING count(*) > 1) d
          ON v.{key} = d.twin"""


SAVINGS = """
        SELECT v.* REPLACE (coalesce(quality_error,
          CASE WHEN a.account_type = 'SAVINGS' AND card_type <> 'DEBIT' THEN 'INVALID_CARD_TYPE_FOR_SAVINGS' END)
          AS quality_error)
        FROM {rows} v LEFT JOIN (SELECT account_id AS parent, min(account_type) AS account_type FROM br_accounts
          GROUP BY account_id) a ON v.account_id = a.parent"""

LAYERS["typed_accounts"] = "SELECT account_id FROM br_accounts GROUP BY account_id HAVING min(account_type) IS NOT NULL"
LAYERS.update({
    "fk_accounts": _referenced("va_accounts", "customer_id", "br_customers", "customer_id", "INVALID_CUSTOMER_ID"),
    "fk_transactions": _referenced("va_transactions", "account_id", "br_accounts", "account_id", "INVALID_ACCOUNT_ID"),
    "fk_cards_missing": _referenced("va_cards", "account_id", "typed_accounts", "account_id", "INVALID_ACCOUNT_ID"),
    "fk_loans": _referenced("va_loans", "customer_id", "br_customers", "customer_id", "INVALID_CUSTOMER_ID"),
    "fk_loan_payments": _referenced("va_loan_payments", "loan_id", "br_loans", "loan_id", "INVALID_LOAN_ID"),
    "fk_cards": SAVINGS.format(rows="fk_cards_missing"),
    "savings_cards": SAVINGS.format(rows="va_cards"),
})

KEYS = {
    "customers": "customer_id", "accounts": "account_id", "merchants": "merchant_id",
    "transactions": "transaction_id", "cards": "card_id", "loans": "loan_id", "loan_payments": "payment_id",
}
for _name, _key in KEYS.items():
    _rows = f"va_{_name}" if _name in ("customers", "merchants") else f"fk_{_name}"
    LAYERS[f"du_{_name}"] = _deduplicated(f"va_{_name}", _key)
    LAYERS[f"ck_{_name}"] = _deduplicated(_rows, _key)
    LAYERS[f"si_{_name}"] = f"SELECT * EXCLUDE (quality_error) FROM ck_{_name} WHERE quality_error IS NULL"
    LAYERS[f"qu_{_name}"] = f"SELECT * FROM ck_{_name} WHERE quality_error IS NOT NULL"


def n_of(condition: str, name: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT) AS {name}"


def cents(expression: str, name: str) -> str:
    return f"CAST(floor({expression} * 1e2 + 0.50001E0) AS DOUBLE) / 1e2 AS {name}"


def fine(expression: str, name: str) -> str:
    return f"CAST(floor({expression} * 1e4 + 0.50001E0) AS DOUBLE) / 1e4 AS {name}"


TOTALS = f"{cents('sum(amount)', 'total_transaction_amount')}, {fine('avg(amount)', 'average_transaction_amount')}"
STATES = {
    status: n_of(f"t.status = '{status.upper()}'", f"{status}_transactions")
    for status in ("completed", "failed", "pending", "cancelled")
}
OWNED = ("si_transactions t JOIN si_accounts a ON t.account_id = a.account_id")
PAID = "CASE WHEN p.status = 'PAID' THEN p.amount ELSE 0 END"

LAYERS.update({
    "go_daily": f"""
        SELECT CAST(transaction_timestamp AS DATE) AS transaction_date, transaction_type, status,
          count(*) AS transaction_count, {cents('sum(amount)', 'total_amount')},
          {fine('avg(amount)', 'average_amount')}, min(amount) AS minimum_amount, max(amount) AS maximum_amount
        FROM si_transactions GROUP BY 1, 2, 3""",
    "go_customer": f"""
        SELECT c.customer_id, c.customer_segment, count(*) AS transaction_count, {TOTALS},
          {n_of("transaction_type = 'PIX'", "pix_count")},
          {n_of("transaction_type = 'CARD_PURCHASE'", "card_purchase_count")},
          {n_of("transaction_type = 'TRANSFER'", "transfer_count")},
          {n_of("transaction_type = 'DEPOSIT'", "deposit_count")},
          {n_of("transaction_type = 'WITHDRAWAL'", "withdrawal_count")},
          {STATES["completed"]}, {STATES["failed"]}, {STATES["pending"]},
          min(transaction_timestamp) AS first_transaction_at, max(transaction_timestamp) AS last_transaction_at
        FROM {OWNED} JOIN si_customers c ON a.customer_id = c.customer_id GROUP BY 1, 2""",
    "go_merchant": f"""
        SELECT m.merchant_id, merchant_name, merchant_category, city, m.state, count(*) AS transaction_count, {TOTALS},
          {STATES["completed"]}, {STATES["failed"]}, {STATES["pending"]},
          count(DISTINCT account_id) AS unique_accounts
        FROM si_transactions t JOIN si_merchants m ON t.merchant_id = m.merchant_id GROUP BY 1, 2, 3, 4, 5""",
    "go_loan": f"""
        SELECT l.loan_id, any_value(customer_id) AS customer_id, any_value(loan_type) AS loan_type,
          any_value(principal_amount) AS principal_amount, any_value(interest_rate) AS interest_rate,
          any_value(term_months) AS term_months, any_value(l.status) AS loan_status,
          any_value(created_at) AS created_at, count(payment_id) AS total_payments,
          {n_of("p.status = 'PAID'", "paid_payments")}, {n_of("p.status = 'PENDING'", "pending_payments")},
          {n_of("p.status = 'LATE'", "late_payments")}, {cents(f"sum({PAID})", "total_paid_amount")},
          {cents(f"(any_value(principal_amount) - sum({PAID}))", "remaining_amount")}
        FROM si_loans l LEFT JOIN si_loan_payments p ON l.loan_id = p.loan_id GROUP BY l.loan_id""",
    "pt_account": f"""
        SELECT customer_id, count(*) AS total_accounts, {n_of("status = 'ACTIVE'", "active_accounts")}
        FROM si_accounts GROUP BY customer_id""",
    "pt_transaction": f"""
        SELECT a.customer_id, count(*) AS total_transactions, {TOTALS} FROM {OWNED} GROUP BY 1""",
    "pt_card": f"""
        SELECT a.customer_id, count(*) AS total_cards, {n_of("card_type = 'CREDIT'", "credit_cards")}
        FROM si_cards c JOIN si_accounts a ON c.account_id = a.account_id GROUP BY 1""",
    "pt_loan": f"""
        SELECT customer_id, count(*) AS total_loans, {cents('sum(principal_amount)', 'total_loan_amount')},
          {n_of("status = 'ACTIVE'", "active_loans")}, {n_of("status = 'DEFAULTED'", "defaulted_loans")}
        FROM si_loans GROUP BY customer_id""",
    "pt_payment": f"""
        SELECT l.customer_id, count(*) AS total_loan_payments, {n_of("p.status = 'PAID'", "paid_payments")},
          {n_of("p.status = 'LATE'", "late_payments")}, {cents(f"sum({PAID})", "total_paid_amount")}
        FROM si_loan_payments p JOIN si_loans l ON p.loan_id = l.loan_id GROUP BY 1""",
    "go_c360": """
        SELECT customer_id, customer_segment,
          coalesce(total_accounts, 0) AS total_accounts, coalesce(active_accounts, 0) AS active_accounts,
          coalesce(total_transactions, 0) AS total_transactions,
          coalesce(total_transaction_amount, 0) AS total_transaction_amount,
          coalesce(average_transaction_amount, 0) AS average_transaction_amount,
          coalesce(total_cards, 0) AS total_cards, coalesce(credit_cards, 0) AS credit_cards,
          coalesce(total_loans, 0) AS total_loans, coalesce(total_loan_amount, 0) AS total_loan_amount,
          coalesce(active_loans, 0) AS active_loans, coalesce(defaulted_loans, 0) AS defaulted_loans,
          coalesce(total_loan_payments, 0) AS total_loan_payments, coalesce(paid_payments, 0) AS paid_payments,
          coalesce(late_payments, 0) AS late_payments, coalesce(total_paid_amount, 0) AS total_paid_amount
        FROM si_customers LEFT JOIN pt_account USING (customer_id) LEFT JOIN pt_transaction USING (customer_id)
          LEFT JOIN pt_card USING (customer_id) LEFT JOIN pt_loan USING (customer_id)
          LEFT JOIN pt_payment USING (customer_id)""",
    "st_customers": "SELECT * EXCLUDE (year, month) FROM si_customers",
    "st_accounts": "SELECT * EXCLUDE (year, month) FROM si_accounts",
    "st_merchants": "SELECT * EXCLUDE (year, month) FROM si_merchants",
    "st_transactions": "SELECT * EXCLUDE (year, month) FROM si_transactions",
    "st_cards": "SELECT * EXCLUDE (year, month) FROM si_cards",
    "st_loans": "SELECT * EXCLUDE (year, month) FROM si_loans",
    "st_loan_payments": "SELECT * EXCLUDE (year, month) FROM si_loan_payments",
    "ma_customer_tx": """
        SELECT t.transaction_id, t.account_id, a.customer_id, c.customer_segment, t.transaction_type, t.amount,
          t.currency, t.status, t.transaction_timestamp, t.merchant_id, t.description
        FROM st_transactions t JOIN st_accounts a ON t.account_id = a.account_id
          JOIN st_customers c ON a.customer_id = c.customer_id""",
    "ma_merchant_tx": """
        SELECT t.transaction_id, t.account_id, t.merchant_id, m.merchant_name, m.merchant_category,
          m.city AS merchant_city, m.state AS merchant_state, t.transaction_type, t.amount, t.currency, t.status,
          t.transaction_timestamp
        FROM st_transactions t JOIN st_merchants m ON t.merchant_id = m.merchant_id""",
    "ma_loan_payments": """
        SELECT p.payment_id, l.loan_id, l.customer_id, l.loan_type, l.principal_amount, l.interest_rate, l.term_months,
          l.status AS loan_status, p.payment_number, p.due_date, p.payment_date, p.amount AS payment_amount,
          p.status AS payment_status
        FROM st_loan_payments p JOIN st_loans l ON p.loan_id = l.loan_id""",
    "ma_customer_loans": """
        SELECT customer_id, customer_segment, coalesce(total_loans, 0) AS total_loans,
          coalesce(total_loan_amount, 0) AS total_loan_amount, coalesce(active_loans, 0) AS active_loans,
          coalesce(defaulted_loans, 0) AS defaulted_loans, coalesce(total_loan_payments, 0) AS total_loan_payments,
          coalesce(paid_payments, 0) AS paid_payments, coalesce(late_payments, 0) AS late_payments,
          coalesce(total_paid_amount, 0) AS total_paid_amount
        FROM st_customers LEFT JOIN pt_loan USING (customer_id) LEFT JOIN pt_payment USING (customer_id)""",
    "ma_customer_fact": f"""
        SELECT customer_id, customer_segment, count(*) AS total_transactions, {TOTALS},
          min(amount) AS minimum_transaction_amount, max(amount) AS maximum_transaction_amount,
          {", ".join(STATES.values())}
        FROM ma_customer_tx t GROUP BY 1, 2""",
    "ma_merchant_fact": f"""
        SELECT merchant_id, merchant_name, merchant_category, merchant_city, merchant_state,
          count(*) AS transaction_count, {TOTALS},
          {STATES["completed"]}, {STATES["failed"]}, {STATES["cancelled"]}
        FROM ma_merchant_tx t GROUP BY 1, 2, 3, 4, 5""",
    "ma_loan_fact": f"""
        SELECT loan_id, customer_id, loan_type, principal_amount, interest_rate, term_months, loan_status,
          count(payment_id) AS total_payments, {n_of("payment_status = 'PAID'", "paid_payments")},
          {n_of("payment_status = 'LATE'", "late_payments")}, {n_of("payment_status = 'PENDING'", "pending_payments")},
          {cents("sum(CASE WHEN payment_status = 'PAID' THEN payment_amount ELSE 0 END)", "total_paid_amount")},
          {cents("sum(CASE WHEN payment_status = 'LATE' THEN payment_amount ELSE 0 END)", "total_late_amount")}
        FROM ma_loan_payments GROUP BY 1, 2, 3, 4, 5, 6, 7""",
    "ma_accounts": f"""
        SELECT customer_id, {n_of("status = 'BLOCKED'", "blocked_accounts")},
          {n_of("status = 'CLOSED'", "closed_accounts")} FROM st_accounts GROUP BY 1""",
    "ma_debit": f"""
        SELECT a.customer_id, {n_of("card_type = 'DEBIT'", "debit_cards")}
        FROM st_cards c JOIN st_accounts a ON c.account_id = a.account_id GROUP BY 1""",
    "ma_c360": """
        SELECT g.*, coalesce(blocked_accounts, 0) AS blocked_accounts, coalesce(closed_accounts, 0) AS closed_accounts,
          coalesce(completed_transactions, 0) AS completed_transactions,
          coalesce(failed_transactions, 0) AS failed_transactions,
          coalesce(pending_transactions, 0) AS pending_transactions,
          coalesce(cancelled_transactions, 0) AS cancelled_transactions, coalesce(debit_cards, 0) AS debit_cards
        FROM go_c360 g LEFT JOIN ma_accounts USING (customer_id) LEFT JOIN ma_debit USING (customer_id)
          LEFT JOIN (SELECT customer_id, completed_transactions, failed_transactions, pending_transactions,
            cancelled_transactions FROM ma_customer_fact) USING (customer_id)""",
})
