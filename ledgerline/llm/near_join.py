"""N-gram Jaccard join: a MinHash LSH forest with exact verification.

Texts are sets of five-word shingles. A signature has `TREES` times `DEPTH` minimum hashes; each tree is a sorted trie of
its prefixes, kept as byte strings, so a prefix of any depth is a substring. Texts that share a prefix meet; the depth is
the largest at which a pair right at the threshold meets with a chance of `RECALL` or more (depth 5 at 0.8: a pair is
missed with a chance of 3 in a million there, of 7 in a billion at 0.85). Nothing is estimated from the links found, so
skewed data cannot hide losses; a threshold too low for any depth is refused. Texts that meet, directly or through
others, form a cluster, and inside clusters every pair is verified exactly from whole shingle sets, block against block;
pairs never leave their task, only counts of links and a spanning forest do. Equal texts are verified once and counted
by their number.

Work: a cluster of k different texts costs k*k/`BLOCK` shipped texts, which counting its links exactly needs.

Defined results: NULL text counts as empty; a text without words has no links and is a class of its own, row by row;
one to four words are one shingle. Equal texts (and equal rows) are one class and link to each other. The class id is
the smallest doc_id of the class, NULL only if all are NULL. An empty table gives an empty result. Very long texts are compared
whole. `near_classes` reads the id and the text only; `one_of_each` keeps all columns, whatever their names.

The depth follows from the threshold and the wanted recall, the same for every text: since no link may be lost, a text that
has found many near copies cannot stop above that depth, and none gains from going below it.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import components, free_name, materialise, text_key, whole_text
from ledgerline.llm.words import mix, numbers_of, shingle_numbers, shingles_of, slices, words_of
from ledgerline.operators.lookup import lookup

TREES, DEPTH, LABEL = 32, 6, 2  # bytes of a label
THRESHOLD, RECALL = 0.8, 0.99999
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
COLUMNS = 4096

_SEEDS = mix(np.arange(1, 2 * TREES * DEPTH + 1, dtype=np.uint64))
_ADD = (_SEEDS[0::2] >> np.uint64(32)).astype(np.uint32)
_TIMES = (_SEEDS[1::2] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def chance(similarity, depth: int, trees: int = TREES):
    """That two texts of this similarity share a prefix of `depth` in some tree."""
    return 1 - (1 - similarity ** depth) ** trees


def signatures(texts: list[str]) -> tuple[np.ndarray, list[bytes]]:
    """Number of shingles (repeats included) and signature of each text; texts without shingles have an empty one."""
    counts, out = [], []
    for begin, end in slices(texts):
        grams = shingles_of(words_of(texts[begin:end]))
        sizes = np.diff(grams.starts)
        filled = np.flatnonzero(sizes)
        table = np.zeros((len(filled), len(_ADD)), dtype=">u2")
        if len(filled):
            at = grams.starts[:-1][filled]
            hashes = (grams.hashes >> np.uint64(32)).astype(np.uint32)
            for number in range(len(_ADD)):
                lowest = np.minimum.reduceat((hashes ^ _ADD[number]) * _TIMES[number], at)
                table[:, number] = (lowest * np.uint32(0x9E3779B1)) >> np.uint32(16)
        blobs = [b""] * len(sizes)
        for row, text in enumerate(filled):
            blobs[text] = table[row].tobytes()
        counts.append(sizes)
        out.extend(blobs)
    return (np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)), out


def _sign(batches):
    for batch in batches:
        counts, blobs = signatures(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())],
            names=["doc_id", "key", "shingles", "signature"])


def blocks_linked(texts: list[str], copies: np.ndarray, side: np.ndarray, threshold: float):
    """(links, root) of each text: its linked copies, and the first text of its component.

    `side` 0 or 1 tells the two blocks apart; if both occur only pairs across are looked at, else all pairs.
    """
    count = len(texts)
    grams = shingle_numbers(numbers_of(texts))  # the words themselves decide, not their hashes
    owner = np.repeat(np.arange(count), np.diff(grams.starts))
    order = np.lexsort((owner, grams.hashes))
    hashes, owner = grams.hashes[order], owner[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    sizes = np.bincount(owner, minlength=count).astype(float)
    column = np.cumsum(np.concatenate([[0], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, dtype=np.int64)
    shared = np.bincount(column)[column] > 1 if len(column) else np.zeros(0, dtype=bool)
    owner, column = owner[shared], column[shared]
    common = np.zeros((count, count), dtype=np.float64)
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
        for low in range(0, int(column[-1]) + 1, COLUMNS):
            part = slice(*np.searchsorted(column, [low, low + COLUMNS]))
            held = np.zeros((count, min(COLUMNS, int(column[-1]) + 1 - low)), dtype=np.float32)
            held[owner[part], column[part] - low] = 1
            common += held @ held.T
    union = sizes[:, None] + sizes[None, :] - common
    similarity = common / np.maximum(union, 1)
    linked = (similarity >= threshold) & (union > 0)
    np.fill_diagonal(linked, False)
    if side.any() and not side.all():
        linked &= side[:, None] != side[None, :]
    links = linked @ copies
    root = np.arange(count)
    while True:  # smallest root among the linked, until nothing changes
        lower = np.minimum(root, np.where(linked, root[None, :], count).min(axis=1, initial=count))
        lower = lower[lower]
        if (lower == root).all():
            return links, root
        root = lower


def _verify(threshold: float):
    def verify(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("key", kind="stable").reset_index(drop=True)
        copies = group["copies"].to_numpy(dtype=np.int64)
        side = (group["block"] != group["low_block"]).to_numpy()
        links, root = blocks_linked(group["text"].tolist(), copies, side, threshold)
        out = pd.DataFrame({"key": group["key"], "links": links, "root": group["key"].to_numpy()[root]})
        return out[links > 0]

    return verify


def _clusters(texts: DataFrame, depth: int) -> DataFrame:
    """(key, cluster) of the texts that share a prefix of `depth` with another one, directly or through others."""
    prefix = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda tree: F.xxhash64(tree, F.substring(F.col("signature"), tree * (DEPTH * LABEL) + 1, F.lit(depth * LABEL))))
    places = texts.where("shingles > 0").select("key", F.explode(prefix).alias("place"))
    met = places.groupBy("place").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
    edges = places.join(met.select("place", "low"), "place").where("key <> low").select(
        F.col("key").alias("a"), F.col("low").alias("b"))
    return components(edges).select(F.col("node").alias("key"), F.col("root").alias("cluster"))


def _links(docs: DataFrame, texts: DataFrame, depth: int, threshold: float) -> DataFrame:
    """(key, links, root) of linked texts, in one row for each pair of blocks that has such links."""
    members = materialise(_clusters(texts, depth).join(texts.select("key", "doc_id", "copies", "shingles"), "key"))
    sizes = members.groupBy("cluster").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    keyed = docs.select("doc_id", text_key().alias("key"), whole_text().alias("text"))
    named = dealt.select("key", F.col("doc_id").alias("_first"), "cluster", "copies", "block", "blocks")
    once = keyed.join(named, (keyed["key"] == named["key"]) & keyed["doc_id"].eqNullSafe(named["_first"])).select(
        named["key"], "cluster", "copies", "block", "blocks", "text").dropDuplicates(["key"])
    spread = once.select("key", "cluster", "copies", "block", "text",
                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    paired = spread.select("key", "cluster", "copies", "block", "text", F.least("block", "other").alias("low_block"),
                           F.greatest("block", "other").alias("high_block"))
    return paired.groupBy("cluster", "low_block", "high_block").applyInPandas(
        _verify(threshold), "key binary, links long, root binary")


def near_classes(docs: DataFrame, *, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row for each document: doc_id, key (of its text), class_id, n_links, worded (it has words), keep (it stays).

    `keep` is set for the rows of the smallest doc_id (of its smallest key); repeats of that very row have it too.
    """
    depth = max((depth for depth in range(1, DEPTH + 1) if chance(threshold, depth) >= recall), default=0)
    if not depth:
        raise ValueError(f"{TREES} trees cannot keep {recall} of the links at {threshold}")
    signed = docs.select("doc_id", text_key().alias("key"), whole_text().alias("text")).mapInArrow(
        _sign, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key binary, shingles long, signature binary")
    signed = materialise(signed)
    texts = signed.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id"), F.first("shingles").alias("shingles"),
        F.first("signature").alias("signature"))
    linked = materialise(_links(docs, texts, depth, threshold))
    degrees = linked.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b")))
    small = texts.select("key", "doc_id", "copies").join(degrees, "key", "left").join(
        roots.select(F.col("node").alias("key"), "root"), "key", "left")
    small = small.where("links > 0 OR copies > 1").withColumn("root", F.coalesce("root", "key"))  # all others stand alone
    first = small.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    named = materialise(small.join(first, "root").select(
        "key", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.col("first.doc_id").alias("class"),
        F.col("first.key").alias("kept_key")))
    rows = lookup(signed.select("doc_id", "key", "shingles"), named, "key", "left")  # a text copied very often is spread
    worded = F.col("shingles") > 0
    joined = worded & F.col("copies").isNotNull()
    first_of_class = (F.col("key") == F.col("kept_key")) & F.col("doc_id").eqNullSafe(F.col("class"))
    return rows.select(
        "doc_id", "key", worded.alias("worded"), F.when(joined, F.col("class")).otherwise(F.col("doc_id")).alias("class_id"),
        F.when(joined, F.col("links") + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(joined, first_of_class).otherwise(F.lit(True)).alias("keep"))


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """`docs` without all but one of each class: the row of the smallest doc_id, one of them if that very row repeats."""
    key, repeats, worded = (free_name(docs, name) for name in ("text_key", "kept_repeats", "kept_worded"))
    kept = near_classes(docs, **settings).where("keep").groupBy("key", "doc_id", "worded").agg(
        F.count(F.lit(1)).alias("repeats"))
    kept = kept.select(F.col("key").alias("_kept_key"), F.col("doc_id").alias("_kept_id"),
                       F.col("repeats").alias(repeats), F.col("worded").alias(worded))
    keyed = docs.withColumn(key, text_key())
    same = (keyed[key] == kept["_kept_key"]) & keyed["doc_id"].eqNullSafe(kept["_kept_id"])
    joined = keyed.join(kept, same).select(
        *[keyed[name] for name in docs.columns], keyed[key], kept[repeats], kept[worded])
    again = F.col(worded) & (F.col(repeats) > 1)
    return joined.where(~again).select(docs.columns).unionByName(
        joined.where(again).dropDuplicates(["doc_id", key]).select(docs.columns))
