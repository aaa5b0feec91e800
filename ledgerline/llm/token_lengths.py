"""Token counts: an exact histogram of documents by encoded length, with suffix sums.

Every whole text is encoded; documents are counted by length in a pre-aggregated group-by, so what is kept grows with the
number of different lengths and not with the documents. Suffix sums over the lengths (within ranges of `RANGE` lengths,
and over the ranges) answer totals, quantiles and truncated totals for every context limit.

Defined results: NULL and empty texts have length 0. Repeated rows count each. An empty table gives an empty histogram,
for which totals are 0 and quantiles None. Very long texts are encoded whole and have a length like others; texts of equal
length are one row, so there are no ties. Only the text column is read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.frames import materialise, whole_text
from ledgerline.llm.token_ids import encoder, vocabulary

RANGE = 1024


def lengths(docs: DataFrame, path: str) -> DataFrame:
    """(n_tokens) of each document."""
    def count(batches):
        encode = encoder(path).encode
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.diff(encode(batch.column("text").to_pylist()).starts), pa.int64())], names=["n_tokens"])

    return docs.select(whole_text().alias("text")).mapInArrow(count, "n_tokens bigint")


def histogram(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row for each length: n_tokens, n_docs, and with this length as the context limit: docs_at_least, tokens_at_least
    (documents that long or longer), docs_at_most, and truncated_total (all documents cut to the limit)."""
    counts = lengths(docs, path or vocabulary("byte_bpe_50k.json")).groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = materialise(counts)  # it is read twice, the texts once
    ranged = counts.withColumn("range", F.floor(F.col("n_tokens") / RANGE))
    totals = ranged.groupBy("range").agg(
        F.sum("n_docs").alias("docs"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("tokens"))
    above = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select(
        "range", *[F.coalesce(F.sum(name).over(above), F.lit(0)).alias(f"{name}_above") for name in ("docs", "tokens")],
        *[F.sum(name).over(whole).alias(f"{name}_all") for name in ("docs", "tokens")])
    inside = Window.partitionBy("range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.join(totals, "range").select(
        "n_tokens", "n_docs", "docs_all", "tokens_all",
        (F.sum("n_docs").over(inside) + F.col("docs_above")).alias("docs_at_least"),
        (F.sum(F.col("n_docs") * F.col("n_tokens")).over(inside) + F.col("tokens_above")).alias("tokens_at_least"))
    return summed.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("docs_all") - F.col("docs_at_least") + F.col("n_docs")).alias("docs_at_most"),
        (F.col("tokens_all") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"))


def total(counted: DataFrame) -> int:
    """All tokens, from the histogram."""
    return counted.agg(F.max("tokens_at_least").alias("value")).first()["value"] or 0


def truncated_total(counted: DataFrame, limit: int) -> int:
    """All tokens with every document cut to `limit`."""
    row = counted.where(F.col("n_tokens") > limit).agg(F.max("docs_at_least").alias("docs"), F.max("tokens_at_least").alias("tokens")).first()
    longer, held = row["docs"] or 0, row["tokens"] or 0
    return total(counted) - held + longer * limit


def quantile(counted: DataFrame, share: float) -> int | None:
    """The smallest length that at least this share of the documents does not exceed."""
    documents = counted.agg(F.max("docs_at_least").alias("value")).first()["value"]
    if not documents:
        return None
    return counted.where(F.col("docs_at_most") >= share * documents).agg(F.min("n_tokens").alias("value")).first()["value"]
