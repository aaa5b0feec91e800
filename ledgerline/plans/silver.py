"""Silver: normalise, validate, check references and duplicates, then split valid from quarantined rows.

A row carries the first error found, in the order row rules, reference, savings-account card rule, duplicate. The
reference and duplicate checks come down to key sets computed from single columns (see operators.keys); the wide rows
are then marked through `lookup`, which leaves them unshuffled as long as the offending keys are few. Where they are many,
`checked_parts` marks them through `Membership`, which shuffles keys alone.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rules import RULES, first_failure, validate
from ledgerline.functions.text import normalise, normalised_columns
from ledgerline.model import ENTITIES, Entity, Reference
from ledgerline.operators.keys import matched_keys, repeated_keys, unmatched_keys
from ledgerline.operators.lookup import lookup, measured_bytes
from ledgerline.operators.membership import Membership
from ledgerline.operators.sieve import Sieve
from ledgerline.session import broadcast_budget, materialise

Tables = Callable[[str], DataFrame]  # entity name -> its Bronze rows

SAVINGS_CARD_CODE = "INVALID_CARD_TYPE_FOR_SAVINGS"


class Marks(NamedTuple):
    """Boolean columns for the rows whose key is in a set; `members` has one row a key, with those of `flags` that hold."""

    key: str
    members: DataFrame
    flags: tuple[str, ...]


def _members(key: str, marks: Mapping[str, DataFrame]) -> Marks:
    """One key set for all of `marks` (flag -> keys), written once."""
    flagged = [keys.where(F.col(key).isNotNull()).select(key, F.lit(flag).alias("_flag")) for flag, keys in marks.items()]
    if len(flagged) == 1:
        flag = next(iter(marks))
        return Marks(key, materialise(flagged[0].select(key)).withColumn(flag, F.lit(True)), (flag,))
    either = [F.max(F.when(F.col("_flag") == flag, F.lit(True))).alias(flag) for flag in marks]
    return Marks(key, materialise(reduce(DataFrame.unionByName, flagged).groupBy(key).agg(*either)), tuple(marks))


def _mark(rows: DataFrame, marks: Sequence[Marks], source: DataFrame, shuffled: list[str] | None) -> DataFrame:
    """Add the flags, one lookup a key. `source` has the same keys as `rows`, before they were normalised and marked."""
    for one in marks:
        rows = lookup(rows, one.members, one.key, "left", counted=source, shuffled=shuffled)
    return rows


def _parents(entity: Entity, reference: Reference, tables: Tables) -> DataFrame:
    """Parents are Bronze rows, so a child of a quarantined parent stays valid. A card needs its account's type, so
    an account that has none counts as missing."""
    parents = tables(reference.parent)
    return parents.where("account_type IS NOT NULL") if entity.name == "cards" else parents


def _savings_accounts(tables: Tables) -> DataFrame:
    """Accounts whose Bronze type, as written, is SAVINGS; the smallest one if an account has several."""
    kinds = tables("accounts").groupBy("account_id").agg(F.min("account_type").alias("account_type"))
    return kinds.where("account_type = 'SAVINGS'")


def _offending_cards(tables: Tables) -> DataFrame:
    """Savings accounts that have a card other than a debit card."""
    card_type = normalised_columns("cards")["card_type"]
    not_debit = tables("cards").where(card_type != "DEBIT")
    return matched_keys(not_debit, "account_id", _savings_accounts(tables), "account_id")


def _savings_error() -> Column:
    return F.when(F.col("_savings") & (F.col("card_type") != "DEBIT"), F.lit(SAVINGS_CARD_CODE))


def reference_marks(name: str, tables: Tables) -> tuple[list[Marks], list[Column]]:
    """Rows whose reference has no parent, and credit cards on savings accounts; with the error columns."""
    entity = ENTITIES[name]
    errors: list[Column] = []
    marks: dict[str, dict[str, DataFrame]] = {}
    for reference in entity.references:
        flag = f"_no_{reference.parent}"
        marks.setdefault(reference.column, {})[flag] = unmatched_keys(
            tables(name), reference.column, _parents(entity, reference, tables), reference.parent_key)
        unmatched = F.col(reference.column).isNull() | F.coalesce(F.col(flag), F.lit(False))
        errors.append(F.when(unmatched, F.lit(reference.code)))
    if name == "cards":
        marks.setdefault("account_id", {})["_savings"] = _offending_cards(tables)
        errors.append(_savings_error())
    return [_members(key, sets) for key, sets in marks.items()], errors


def duplicate_marks(name: str, tables: Tables) -> tuple[list[Marks], Column]:
    """Every copy of a repeated key is an error, including copies that already carry another one."""
    entity = ENTITIES[name]
    marks = _members(entity.key, {"_repeated": repeated_keys(tables(name), entity.key)})
    return [marks], F.when(F.col("_repeated"), F.lit(entity.duplicate_code))


def mark_references(
    name: str, rows: DataFrame, tables: Tables, shuffled: list[str] | None = None,
) -> tuple[DataFrame, list[Column]]:
    marks, errors = reference_marks(name, tables)
    return _mark(rows, marks, tables(name), shuffled), errors


def mark_duplicates(
    name: str, rows: DataFrame, tables: Tables, shuffled: list[str] | None = None,
) -> tuple[DataFrame, Column]:
    marks, error = duplicate_marks(name, tables)
    return _mark(rows, marks, tables(name), shuffled), error


def normalised(name: str, tables: Tables) -> DataFrame:
    return normalise(name, tables(name))


def validated(name: str, tables: Tables) -> DataFrame:
    """Normalised rows with the error of the row rules."""
    return validate(name, normalised(name, tables))


def _finish(name: str, rows: DataFrame, errors: list[Column]) -> DataFrame:
    schema = ENTITIES[name].quarantine_schema
    return rows.withColumn("quality_error", F.coalesce(*errors)).select(schema.names)


def _parts(name: str, marks: Sequence[Marks], errors: list[Column], tables: Tables) -> list[DataFrame]:
    """All rows with their error, in parts: one that is shuffled nowhere and, where key sets are too large for `Membership`, one of
    the rows that a sieve of these keys lets through, the only ones that meet them in a shuffle."""
    found = [first_failure(RULES[name]), *errors]
    rows = normalised(name, tables)
    budget = broadcast_budget(rows.sparkSession)
    wide = [one for one in marks if measured_bytes(one.members) > budget]
    rows = _mark(rows, [one for one in marks if one not in wide], tables(name), None)
    for one in list(wide):
        sets = {flag: Membership(one.members.where(flag), one.key, tables(name)) for flag in one.flags}
        if all(members.settled for members in sets.values()):
            for flag, members in sets.items():
                rows = members.marked(rows, flag)
            wide.remove(one)
    if not wide:
        return [_finish(name, rows, found)]
    names = [f"_maybe_{number}" for number in range(len(wide))]
    for one, maybe in zip(wide, names):
        rows = Sieve(one.members, one.key).marked(rows, maybe)
    possible = reduce(Column.__or__, map(F.col, names))
    apart = {flag: F.lit(None).cast("boolean") for one in wide for flag in one.flags}
    few = rows.where(possible)
    return [_finish(name, rows.where(~possible).withColumns(apart), found),
            _finish(name, _mark(few, wide, few.select(*{one.key for one in wide}), None), found)]


def checked_references(name: str, tables: Tables) -> DataFrame:
    """Row rules, then references."""
    marks, errors = reference_marks(name, tables)
    return reduce(DataFrame.unionByName, _parts(name, marks, errors, tables))


def checked_savings_cards(tables: Tables) -> DataFrame:
    """The savings-account card rule on its own, after the row rules."""
    marks = _members("account_id", {"_savings": _offending_cards(tables)})
    return reduce(DataFrame.unionByName, _parts("cards", [marks], [_savings_error()], tables))


def checked_duplicates(name: str, tables: Tables) -> DataFrame:
    """Row rules, then duplicates."""
    marks, error = duplicate_marks(name, tables)
    return reduce(DataFrame.unionByName, _parts(name, marks, [error], tables))


def checked(name: str, tables: Tables, shuffled: list[str] | None = None) -> DataFrame:
    """All rows with their error, NULL for a valid row. Keys whose lookup shuffled the rows are added to `shuffled`."""
    rows, references = mark_references(name, normalised(name, tables), tables, shuffled)
    rows, duplicate = mark_duplicates(name, rows, tables, shuffled)
    return _finish(name, rows, [first_failure(RULES[name]), *references, duplicate])


def checked_parts(name: str, tables: Tables) -> list[DataFrame]:
    """The rows of `checked` in parts, for a writer that leaves all but the last ones where they are (see `_parts`)."""
    references, errors = reference_marks(name, tables)
    duplicates, duplicate = duplicate_marks(name, tables)
    return _parts(name, [*references, *duplicates], [*errors, duplicate], tables)


def valid_rows(name: str, rows: DataFrame) -> DataFrame:
    return rows.where("quality_error IS NULL").select(ENTITIES[name].bronze_schema.names)


def quarantined_rows(name: str, rows: DataFrame) -> DataFrame:
    return rows.where("quality_error IS NOT NULL").select(ENTITIES[name].quarantine_schema.names)


def error_counts(quarantined: DataFrame) -> DataFrame:
    """Rows per error code, most frequent first."""
    counts = quarantined.groupBy("quality_error").agg(F.count(F.lit(1)).alias("error_count"))
    return counts.orderBy(F.desc("error_count"), "quality_error")
