"""Benchmark decontamination: greedy string tiling of documents with benchmark items.

Items are cut into seeds, hashes of five words in a row. A pass over whole documents keeps those that hold a seed
(tested against a bitmap of fixed size, so that false ones may pass and nothing is lost); a join on the seeds gives the
pairs of document and item. Each pair is tiled: the longest match of unmarked words, from rolling (Karp-Rabin) hashes of
every window, is marked in both, again and again, until none of five words is left. Tiles never overlap, and their order
does not matter, so reordered passages count in full. Seeds and windows meet by hashes; the words of every window that
met are compared before it counts. A pair is contaminated if the tiles cover enough of the item.

Defined results: NULL texts count as empty. Items of fewer than five words have no seed and contaminate nothing. Repeated
items (equal id and text) are one; repeated documents each give their pairs. Empty tables give no pairs. A document's id
may be NULL or repeat; pairs carry it as it is. Very long texts are tiled whole. Ties between matches go to the one that
comes first in the item, then in the document. Other columns of the documents are not read, so none can clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import free_name, materialise, text_key, whole_text
from ledgerline.llm.words import SHINGLE, Words, grams_of, numbers_of, slices, words_of

COVERAGE = 0.5
MAP_BITS = 26  # of the bitmap of seeds: 8 MB, whatever the benchmark's size
SMALL_SEEDS = 500_000  # up to so many seeds (of 40 bytes) are broadcast in the join, more are shuffled


def _seeds(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        words = words_of(texts)
        grams = grams_of(words, SHINGLE)
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), batch.column("text"),
             pa.array([np.unique(grams.hashes[a:b]).view(np.int64) for a, b in zip(grams.starts, grams.starts[1:])],
                      pa.list_(pa.int64()))],
            names=["item", "item_text", "seeds"])


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Which of 2**MAP_BITS values the seeds' last bits take, from at most 2**(MAP_BITS - 6) rows."""
    low = F.col("seed").bitwiseAND((1 << MAP_BITS) - 1)
    words = seeds.select(F.shiftright(low, 6).alias("word"), F.expr(f"shiftleft(1L, cast(seed & 63 as int))").alias("bit"))
    held = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(1 << (MAP_BITS - 6), dtype=np.uint64)
    table[held["word"].to_numpy(dtype=np.int64)] = held["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return table


def _suspects(table):
    def found(batches):
        bits = table.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids, held_seeds = [], []
            for begin, end in slices(texts):
                words = words_of(texts[begin:end])
                grams = grams_of(words, SHINGLE)
                low = grams.hashes & np.uint64((1 << MAP_BITS) - 1)
                hit = (bits[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1)
                places = np.flatnonzero(hit)
                owner = np.searchsorted(grams.starts, places, side="right") - 1
                for text in np.unique(owner).tolist():
                    ids.append(begin + text)
                    held_seeds.append(np.unique(grams.hashes[places[owner == text]]).view(np.int64))
            chosen = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(chosen), batch.column("key").take(chosen),
                 pa.array(held_seeds, pa.list_(pa.int64())), batch.column("text").take(chosen)],
                names=["doc_id", "key", "seeds", "text"])

    return found


def tile(item: np.ndarray, document: np.ndarray, least: int = SHINGLE) -> list[tuple[int, int, int]]:
    """Non-overlapping tiles (item place, document place, words), longest first, of two arrays of word numbers.

    Windows meet by their rolling hashes, as Karp and Rabin have it, and are then compared word by word.
    """
    def windows(words: np.ndarray) -> np.ndarray:
        return grams_of(Words(words, np.array([0, len(words)])), least).hashes

    inside, around = windows(item), windows(document)
    places = np.flatnonzero(np.isin(around, inside))
    order = np.argsort(inside, kind="stable")
    sorted_inside = inside[order]
    low, high = (np.searchsorted(sorted_inside, around[places], side=side) for side in ("left", "right"))
    repeat = high - low
    there = np.repeat(places, repeat)
    here = order[np.arange(repeat.sum()) + np.repeat(low - (np.cumsum(repeat) - repeat), repeat)]
    for step in range(least):
        same = item[here + step] == document[there + step]
        here, there = here[same], there[same]
    tiles = []
    while len(here):
        by_diagonal = np.lexsort((here, there - here))
        here, there = here[by_diagonal], there[by_diagonal]
        new = np.ones(len(here), dtype=bool)
        new[1:] = (np.diff(here) != 1) | (np.diff(there) != 1)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(here))) + least - 1
        best = np.lexsort((there[first], here[first], -length))[0]
        size, at, to = int(length[best]), int(here[first[best]]), int(there[first[best]])
        tiles.append((at, to, size))
        free = ((here + least <= at) | (here >= at + size)) & ((there + least <= to) | (there >= to + size))
        here, there = here[free], there[free]
    return tiles


def _tiled(coverage: float):
    def tiled(batches):
        for batch in batches:
            rows = {"doc_id": [], "key": [], "item_id": [], "coverage": [], "tiles": []}
            for at, items in enumerate(batch.column("items").to_pylist()):
                held_words = numbers_of([batch.column("text")[at].as_py(), *(held["item_text"] for held in items)])
                document, *parts = np.split(held_words.hashes, held_words.starts[1:-1])
                for held, item in zip(items, parts):
                    found = tile(item, document)
                    share = sum(size for _, _, size in found) / len(item)
                    if share >= coverage:
                        for name, value in zip(rows, (at, at, held["item_id"], share, len(found))):
                            rows[name].append(value)
            chosen = pa.array(rows["doc_id"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(chosen), batch.column("key").take(chosen), pa.array(rows["item_id"], pa.int64()),
                 pa.array(rows["coverage"], pa.float64()), pa.array(rows["tiles"], pa.int64())], names=list(rows))

    return tiled


def contaminated(docs: DataFrame, benchmark: DataFrame, *, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, key of the text, item_id, coverage, tiles) for each document and item with enough of the item in tiles."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), whole_text().alias("text")).distinct()
    items = materialise(items.select(F.struct("item_id").alias("item"), "text").mapInArrow(
        _seeds, "item struct<item_id bigint>, item_text string, seeds array<bigint>"))
    seeds = items.select(F.explode("seeds").alias("seed"), F.struct("item.item_id", "item_text").alias("held"))
    table = spark.sparkContext.broadcast(_bitmap(seeds))
    suspects = docs.select("doc_id", text_key().alias("key"), whole_text().alias("text")).mapInArrow(
        _suspects(table), f"doc_id {kind}, key binary, seeds array<bigint>, text string")
    suspects = materialise(suspects.withColumn("row", F.monotonically_increasing_id()))
    entries = F.broadcast(seeds) if seeds.count() <= SMALL_SEEDS else seeds
    pairs = suspects.select("row", F.explode("seeds").alias("seed")).join(entries, "seed").groupBy("row").agg(
        F.collect_set("held").alias("items"))
    return suspects.select("row", "doc_id", "key", "text").join(pairs, "row").drop("row").mapInArrow(
        _tiled(coverage), f"doc_id {kind}, key binary, item_id bigint, coverage double, tiles bigint")


def clean(docs: DataFrame, benchmark: DataFrame, *, coverage: float = COVERAGE) -> DataFrame:
    """`docs` without the contaminated ones."""
    key = free_name(docs, "text_key")
    bad = contaminated(docs, benchmark, coverage=coverage).select(F.col("key").alias("_bad_key")).distinct()
    keyed = docs.withColumn(key, text_key())
    return keyed.join(bad, keyed[key] == bad["_bad_key"], "left_anti").drop(key)
