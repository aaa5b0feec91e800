"""Aggregates that can be taken in two steps: first by the fact's own key, then through a bridge by another key.

`roll_up` is how transactions reach customers: they are aggregated by account before the join, so the join and the
second aggregate see one row per account, however many transactions one account or customer has.

Sums of doubles depend on the order of addition. Where every value of a group is a whole number of cents, the sum is taken
over cents, as integers, and is the same however the rows are partitioned; otherwise (or beyond 64 bits) it is the plain sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """One output column: `kind` of `value`, an SQL expression."""

    name: str
    kind: str
    value: str = "1"

    def _pieces(self) -> dict[str, tuple[Column, str]]:
        """Stored column -> (its first-step aggregate, the function that merges it)."""
        value = F.expr(self.value)
        if self.kind == "count":
            return {self.name: (F.count(value), "sum")}
        if self.kind in ("min", "max"):
            return {self.name: (getattr(F, self.kind)(value), self.kind)}
        cents = f"try_cast(rint(({self.value}) * 100) AS bigint)"
        odd = f"({self.value}) IS NOT NULL AND NOT coalesce({cents} / 100D = ({self.value}), false)"
        pieces = {
            f"{self.name}_sum": (F.sum(value), "sum"), f"{self.name}_cents": (F.try_sum(F.expr(cents)), "try_sum"),
            f"{self.name}_odd": (F.count_if(F.expr(odd)), "sum"),
        }
        return pieces | ({f"{self.name}_n": (F.count(value), "sum")} if self.kind == "mean" else {})

    def collected(self) -> list[Column]:
        return [first.alias(name) for name, (first, _) in self._pieces().items()]

    def merged(self) -> list[Column]:
        return [getattr(F, merge)(name).alias(name) for name, (_, merge) in self._pieces().items()]

    def finished(self) -> Column:
        if self.kind not in ("sum", "mean"):
            return F.col(self.name)
        total = f"coalesce(CASE WHEN {self.name}_odd = 0 THEN {self.name}_cents / 100D END, {self.name}_sum)"
        return F.expr(total if self.kind == "sum" else f"try_divide({total}, {self.name}_n)").alias(self.name)


def count_rows(name: str) -> Measure:
    return Measure(name, "count")


def count_where(name: str, condition: str) -> Measure:
    return Measure(name, "count", f"CASE WHEN {condition} THEN 1 END")


def sum_of(name: str, value: str) -> Measure:
    return Measure(name, "sum", value)


def sum_where(name: str, value: str, condition: str) -> Measure:
    return Measure(name, "sum", f"CASE WHEN {condition} THEN {value} ELSE 0.0D END")


def mean_of(name: str, value: str) -> Measure:
    return Measure(name, "mean", value)


def min_of(name: str, value: str) -> Measure:
    return Measure(name, "min", value)


def max_of(name: str, value: str) -> Measure:
    return Measure(name, "max", value)


def _step(rows: DataFrame, by: Sequence[str], aggregates: list[Column]) -> DataFrame:
    return rows.groupBy(*by).agg(*aggregates)


def summarise(rows: DataFrame, by: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """One row per `by`, in one aggregation."""
    collected = [column for measure in measures for column in measure.collected()]
    return _step(rows, by, collected).select(*by, *(measure.finished() for measure in measures))


def gather(
    base: DataFrame, key: str, by: Sequence[str], own: Sequence[Measure],
    facts: Sequence[tuple[DataFrame, Sequence[Measure]]],
) -> DataFrame:
    """One row per `by` of `base`, with measures of its rows and of all `facts` that refer to them by `key`.

    Each fact is aggregated by the key before it is joined, and `base` is read and aggregated once for all of them.
    A measure without any rows is NULL, a count of them too.
    """
    joined = base
    for rows, measures in facts:
        collected = [column for measure in measures for column in measure.collected()]
        joined = joined.join(_step(rows.where(F.col(key).isNotNull()), [key], collected), key, "left")
    aggregates = [column for measure in own for column in measure.collected()]
    aggregates += [column for _, measures in facts for measure in measures for column in measure.merged()]
    names = [measure for measures in (own, *(held for _, held in facts)) for measure in measures]
    return _step(joined, by, aggregates).select(*by, *(measure.finished() for measure in names))


def roll_up(
    rows: DataFrame, key: str, bridge: DataFrame, by: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """One row per `by`, where `by` are columns of `bridge`, joined to `rows` on `key` (inner)."""
    collected = [column for measure in measures for column in measure.collected()]
    merged = [column for measure in measures for column in measure.merged()]
    per_key = _step(rows.where(F.col(key).isNotNull()), [key], collected)
    per_target = _step(per_key.join(bridge.select(key, *by), key), by, merged)
    return per_target.select(*by, *(measure.finished() for measure in measures))
