"""Exact, linearly interpolated quantiles by narrowing down, without sorting or shuffling the values.

Each pass over the column counts the values of the spans that still hold a wanted rank in BUCKETS equal steps, and keeps the
smallest and largest value of every step. A step whose ends are equal is the answer for its ranks; the others are the next
pass's spans. A pass leaves at most one span a rank, and its counts, BUCKETS rows a span, are all that leaves the executors,
however many values there are. Amounts take two or three passes; every pass parts the ends of a span, so it always ends.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 4_096


class Span(NamedTuple):
    """Values from `low` to `high`, `before` of all values being smaller."""

    low: float
    high: float
    before: int
    ranks: tuple[int, ...]


def _step(span: Span) -> str:
    """SQL for the step of a value within the span. NaN, which comes after all other values, and infinities have steps of
    their own."""
    low, high = (f"CAST('{value!r}' AS DOUBLE)" for value in (span.low, span.high))
    share = f"(value - {low}) / ({high} - {low})"
    if math.isinf(span.high - span.low):
        share = f"(value / 2 - {low} / 2) / ({high} / 2 - {low} / 2)"
    return (f"CASE WHEN isnan(value) THEN {BUCKETS + 1} WHEN value = CAST('inf' AS DOUBLE) THEN {BUCKETS} "
            f"WHEN value = CAST('-inf' AS DOUBLE) THEN -1 ELSE CAST(least(floor({share} * {BUCKETS}), {BUCKETS - 1}) AS INT) END")


def _counted(values: DataFrame, spans: Sequence[Span]) -> list:
    """Rows (span, step, n, low, high) of one pass, in order."""
    step, number = F.lit(None).cast("int"), F.lit(None).cast("int")
    for at, span in enumerate(spans):
        inside = F.lit(True)
        if len(spans) > 1 or span.before:
            inside = F.expr(f"value >= CAST('{span.low!r}' AS DOUBLE) AND value <= CAST('{span.high!r}' AS DOUBLE)")
        number = F.when(inside, at).otherwise(number)
        step = F.when(inside, F.expr(_step(span))).otherwise(step)
    held = values.withColumn("span", number).where("span IS NOT NULL").withColumn("step", step)
    return held.groupBy("span", "step").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).orderBy("span", "step").collect()


def values_at(values: DataFrame, ranks: Sequence[int], low: float, high: float) -> dict[int, float]:
    """The values at these ranks, from 0, of the column `value`, whose finite values lie between `low` and `high`."""
    found: dict[int, float] = {}
    spans = [Span(low, high, 0, tuple(sorted(set(ranks))))] if ranks else []
    while spans:
        narrower: list[Span] = []
        before, last = 0, -1
        for row in _counted(values, spans):
            if row.span != last:
                before, last = spans[row.span].before, row.span
            inside = tuple(rank for rank in spans[row.span].ranks if before <= rank < before + row.n)
            if inside and (row.low == row.high or math.isnan(row.low)):
                found.update(dict.fromkeys(inside, row.low))
            elif inside:
                narrower.append(Span(row.low, row.high, before, inside))
            before += row.n
        spans = narrower
    return found


def exact_quantiles(rows: DataFrame, column: str, probabilities: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row with the quantiles of `column` (NULLs left out) under the given names, NULL if there are no values."""
    values = rows.select(F.col(column).cast("double").alias("value")).where("value IS NOT NULL")
    finite = F.when(~F.isnan("value") & (F.abs("value") < float("inf")), F.col("value"))
    ends = values.agg(F.count(F.lit(1)).alias("n"), F.min(finite).alias("low"), F.max(finite).alias("high")).first()
    places = [(ends.n - 1) * probability for probability in probabilities] if ends.n else []
    ranks = [rank for place in places for rank in (math.floor(place), math.ceil(place))]
    low, high = (0.0, 0.0) if ends.low is None else (ends.low, ends.high)
    if low == high:  # one finite value, or none: steps need some width
        low, high = min(low, 0.0) - 1.0, max(high, 0.0) + 1.0
    found = values_at(values, ranks, low, high)
    answers = [found[math.floor(place)] + (found[math.ceil(place)] - found[math.floor(place)]) * (place - math.floor(place))
               if place > math.floor(place) else found[math.floor(place)] for place in places]
    schema = T.StructType([T.StructField(name, T.DoubleType()) for name in names])
    return rows.sparkSession.createDataFrame([tuple(answers) or (None,) * len(names)], schema)
