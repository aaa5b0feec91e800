"""The seven banking entities: schemas, keys, references and allowed values.

Everything that differs between entities and is not a validation rule is declared here, so that the plans can be
written once and applied to every entity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The allowed text domains, after upper-casing and trimming.
CUSTOMER_SEGMENTS = ("BASIC", "STANDARD", "PREMIUM")
ACCOUNT_TYPES = ("CHECKING", "SAVINGS")
ACCOUNT_STATUSES = ("ACTIVE", "BLOCKED", "CLOSED")
MERCHANT_CATEGORIES = (
    "SUPERMARKET", "RESTAURANT", "GAS_STATION", "PHARMACY", "CLOTHING",
    "ELECTRONICS", "ENTERTAINMENT", "TRAVEL", "SERVICES", "OTHER",
)
STATES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)
TRANSACTION_TYPES = ("PIX", "CARD_PURCHASE", "TRANSFER", "DEPOSIT", "WITHDRAWAL", "TED", "DOC")
TRANSACTION_STATUSES = ("COMPLETED", "PENDING", "FAILED", "CANCELLED")
CURRENCY = "BRL"
CARD_TYPES = ("DEBIT", "CREDIT")
CARD_STATUSES = ("ACTIVE", "BLOCKED", "EXPIRED", "CANCELLED")
LOAN_TYPES = ("PERSONAL", "PAYROLL", "AUTO")
LOAN_STATUSES = ("ACTIVE", "PAID", "DEFAULTED", "CANCELLED")
PAYMENT_STATUSES = ("PAID", "PENDING", "LATE")

PARTITION_COLUMNS = ("year", "month")
PARTITION_FIELDS = [T.StructField(name, T.IntegerType()) for name in PARTITION_COLUMNS]
ERROR_FIELD = T.StructField("quality_error", T.StringType())


@dataclass(frozen=True)
class Reference:
    """A foreign key: `column` must exist as `parent_key` in the parent's Bronze table."""

    column: str
    parent: str
    parent_key: str
    code: str


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    date_column: str
    columns: T.StructType
    references: tuple[Reference, ...] = ()
    partitioned: bool = False  # Silver and quarantine are laid out by year and month

    @property
    def duplicate_code(self) -> str:
        return f"DUPLICATE_{self.key.upper()}"

    @property
    def bronze_schema(self) -> T.StructType:
        return T.StructType(self.columns.fields + PARTITION_FIELDS)

    @property
    def quarantine_schema(self) -> T.StructType:
        return T.StructType(self.columns.fields + [ERROR_FIELD] + PARTITION_FIELDS)

    @property
    def layout(self) -> tuple[str, ...]:
        return PARTITION_COLUMNS if self.partitioned else ()


def flat_schema(ddl: str) -> T.StructType:
    """A flat schema from `name type, name type`; nothing here needs a running session."""
    types = {
        "long": T.LongType(), "string": T.StringType(), "double": T.DoubleType(),
        "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
    }
    pairs = (column.split() for column in ddl.split(","))
    return T.StructType([T.StructField(name, types[kind]) for name, kind in pairs])


# Names and types of the columns, and the codes of the references.
ENTITIES: dict[str, Entity] = {
    entity.name: entity
    for entity in (
        Entity(
            "customers", "customer_id", "created_at",
            flat_schema(
                "customer_id long, first_name string, last_name string, birth_date date, document string, "
                "email string, phone string, city string, state string, customer_segment string, "
                "created_at timestamp_ntz"
            ),
        ),
        Entity(
            "accounts", "account_id", "opened_at",
            flat_schema(
                "account_id long, customer_id long, account_type string, branch string, account_number string, "
                "status string, opened_at timestamp_ntz, closed_at timestamp_ntz"
            ),
            (Reference("customer_id", "customers", "customer_id", "INVALID_CUSTOMER_ID"),),
        ),
        Entity(
            "merchants", "merchant_id", "created_at",
            flat_schema(
                "merchant_id long, merchant_name string, merchant_category string, city string, state string, "
                "created_at timestamp_ntz"
            ),
            partitioned=True,
        ),
        Entity(
            "transactions", "transaction_id", "transaction_timestamp",
            flat_schema(
                "transaction_id long, account_id long, transaction_type string, amount double, currency string, "
                "status string, transaction_timestamp timestamp_ntz, merchant_id long, description string"
            ),
            (Reference("account_id", "accounts", "account_id", "INVALID_ACCOUNT_ID"),),
            partitioned=True,
        ),
        Entity(
            "cards", "card_id", "issued_at",
            flat_schema(
                "card_id long, account_id long, card_type string, brand string, status string, "
                "credit_limit double, issued_at timestamp_ntz, expires_at timestamp_ntz"
            ),
            (Reference("account_id", "accounts", "account_id", "INVALID_ACCOUNT_ID"),),
        ),
        Entity(
            "loans", "loan_id", "created_at",
            flat_schema(
                "loan_id long, customer_id long, loan_type string, principal_amount double, interest_rate double, "
                "term_months long, status string, created_at timestamp_ntz"
            ),
            (Reference("customer_id", "customers", "customer_id", "INVALID_CUSTOMER_ID"),),
            partitioned=True,
        ),
        Entity(
            "loan_payments", "payment_id", "due_date",
            flat_schema(
                "payment_id long, loan_id long, payment_number long, due_date timestamp_ntz, "
                "payment_date timestamp_ntz, amount double, status string"
            ),
            (Reference("loan_id", "loans", "loan_id", "INVALID_LOAN_ID"),),
        ),
    )
}
