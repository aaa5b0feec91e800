"""Columns that sum up an array of (start, end, kind) spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, in their order, joined by commas."""
    return F.array_join(F.transform(spans, lambda one: F.format_string("%s:%d:%d", one["kind"], one["start"], one["end"])), ",")


def digest(column: str, kinds: tuple[str, ...]) -> list[Column]:
    """n_<kind> for each of the rules' kinds, base_sha256 of their spans, and spans: all of them.

    A span that the method adds has a kind of its own."""
    held = F.col(column)

    def of(*wanted: str) -> Column:
        return F.filter(held, lambda one: one["kind"].isin(*wanted))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in kinds]
    return [*counts, F.sha2(joined(of(*kinds)), 256).alias("base_sha256"), joined(held).alias("spans")]
