"""Spark-side helpers: text keys, written intermediates, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import materialise

__all__ = ["components", "free_name", "materialise", "sampled", "text_key", "whole_text"]

ROUNDS = 60  # label rounds double the reach, so this is beyond any real chain


def whole_text(column: str = "text") -> Column:
    """The text, NULL taken as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> Column:
    """128 bits of the whole text: equal texts share it wherever and whenever they are read."""
    return F.unhex(F.md5(whole_text(column)))


def sampled(rows: DataFrame, limit: int, *keys: str) -> DataFrame:
    """At most `limit` rows, those whose keys have the smallest hashes. Only about so many are ever sorted together."""
    total = rows.count()
    number = F.xxhash64(*[F.col(key).cast("string") for key in keys])
    if total > limit:
        share = 1.2 * limit / total + 10 / total
        rows = rows.where(F.pmod(number, F.lit(1 << 40)) < int(min(1.0, share) * (1 << 40)))
    return rows.orderBy(F.pmod(number, F.lit(1 << 40)), *keys).limit(limit)


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores in front until no column of `df` has that name (compared as Spark does)."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected `edges` (a, b); root is the smallest node of its component.

    Alternates large-star and small-star: every round links nodes to the smallest of their neighbourhood. A node with
    many neighbours meets its minimum as one pre-aggregated row, and the shuffle join that follows can be split.
    """
    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        if large:
            both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        linked = both.join(low, "a")
        if large:
            out = linked.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = linked.select(F.col("b").alias("a"), F.col("low").alias("b"))
            out = out.union(low.select("a", F.col("low").alias("b")))
        return out.where("a <> b").distinct()

    def mark(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    now = materialise(edges.select("a", "b").where("a <> b").distinct())
    seen = mark(now)
    for _ in range(ROUNDS):
        if not seen[0]:
            break
        now = materialise(stars(stars(now, True), False))
        after = mark(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
