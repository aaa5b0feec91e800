"""Text normalisation per entity. Spark's trim removes spaces only, which is the wanted behaviour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER = "upper(trim({0}))"
_LOWER = "lower(trim({0}))"
_TRIM = "trim({0})"

NORMALISED: dict[str, dict[str, tuple[str, ...]]] = {
    "customers": {
        _TRIM: ("first_name", "last_name", "document", "phone", "city"),
        _LOWER: ("email",),
        _UPPER: ("state", "customer_segment"),
    },
    "accounts": {_UPPER: ("account_type", "status"), _TRIM: ("branch", "account_number")},
    "merchants": {_TRIM: ("merchant_name", "city"), _UPPER: ("merchant_category", "state")},
    "transactions": {_UPPER: ("transaction_type", "status", "currency"), _TRIM: ("description",)},
    "cards": {_UPPER: ("card_type", "brand", "status")},
    "loans": {_UPPER: ("loan_type", "status")},
    "loan_payments": {_UPPER: ("status",)},
}


def normalised_columns(entity: str) -> dict[str, Column]:
    return {
        column: F.expr(template.format(column))
        for template, columns in NORMALISED[entity].items()
        for column in columns
    }


def normalise(entity: str, rows: DataFrame) -> DataFrame:
    """Trim and case-fold the text columns of an entity; every other column passes through."""
    return rows.withColumns(normalised_columns(entity))
