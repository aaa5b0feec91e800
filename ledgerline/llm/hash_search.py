"""Approximate nearest neighbours by inner product: multi-index hashing with exact reranking.

Vectors (with one more component that makes their norms equal, so that the angle orders them as the inner product does)
are rotated by a matrix learned on a bounded sample (principal axes, then iterative quantisation) and their signs are a
code of `BITS` bits, split into `PARTS` substrings. Every shard of vectors holds a table for each substring, from its
values to the vectors that have them. A query within the radius of a code is, by the pigeonhole principle, near it in some
substring: all values near enough in each substring are probed, the codes found are kept if within the radius, and their
vectors are ranked by inner product in double precision. The radius is the smallest that holds `SHARE` of the true
neighbours within the sample. A query that finds too few gets the full radius, which is exact.

Shards and query blocks have bounded sizes and meet as packed rows, one task group for each pair of them; each emits the
best of its shard for each query, and a pre-aggregated merge picks the best of all.

Defined results: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no part, neither do those
whose length is not the commonest one (the longer of equally common ones) nor rows without an id. Equal rows are one; a
row of a query's own id is no candidate; rows of one id with different vectors are candidates each. Ties go to smaller ids.
Rows of one id with different vectors share one list as queries: it holds the best of all of them. Fewer candidates than
wanted are all returned. An empty table gives no rows. Only the id and the vector are read, so other columns cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.frames import materialise, sampled

BITS, PARTS = 64, 8
SAMPLE, SAMPLE_QUERIES, SHARE = 4_000, 400, 0.98
SHARD, QUERY_BLOCK = 16_384, 1_024
WANTED = 20

_VALUES = np.arange(256, dtype=np.uint8)
_DISTANCE = np.unpackbits((_VALUES[:, None] ^ _VALUES[None, :])[:, :, None], axis=2).sum(axis=2)  # of two substrings
_BITS_SET = _DISTANCE[0].astype(np.uint8)


class Coder(NamedTuple):
    rotation: np.ndarray  # dimensions + 1, BITS
    norm: float  # the largest
    radius: int

    def codes(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        """PARTS bytes for each vector."""
        if queries:
            lifted = np.concatenate([vectors / np.linalg.norm(vectors, axis=1, keepdims=True), np.zeros((len(vectors), 1))], axis=1)
        else:
            scaled = vectors / self.norm
            rest = np.sqrt(np.maximum(1 - (scaled ** 2).sum(axis=1, keepdims=True), 0))
            lifted = np.concatenate([scaled, rest], axis=1)
        return np.packbits(lifted @ self.rotation > 0, axis=1)


def _rotation(lifted: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Principal axes, made BITS wide, then turned until signs lose least (iterative quantisation)."""
    chance = np.random.default_rng(11)
    axes = np.linalg.eigh(lifted.T @ lifted)[1][:, ::-1][:, :BITS]
    if axes.shape[1] < BITS:  # fewer dimensions than bits: more directions than axes
        axes = axes @ np.linalg.qr(chance.standard_normal((BITS, BITS)))[0][:axes.shape[1]]
    turn = np.linalg.qr(chance.standard_normal((BITS, BITS)))[0]
    held = lifted @ axes
    for _ in range(rounds):
        left, _, right = np.linalg.svd(np.sign(held @ turn).T @ held)
        turn = (left @ right).T
    return axes @ turn


def learn(sample: np.ndarray, norm: float, wanted: int = WANTED, share: float = SHARE) -> Coder:
    """The coder of a sample of vectors."""
    scaled = sample / norm
    lifted = np.concatenate([scaled, np.sqrt(np.maximum(1 - (scaled ** 2).sum(axis=1, keepdims=True), 0))], axis=1)
    coder = Coder(_rotation(lifted), norm, BITS)
    asked = min(SAMPLE_QUERIES, len(sample))
    products = sample[:asked] @ sample.T
    products[np.arange(asked), np.arange(asked)] = -np.inf
    near = np.argsort(-products, axis=1, kind="stable")[:, :max(1, min(wanted, len(sample) - 1))]
    codes, questions = coder.codes(sample), coder.codes(sample[:asked], queries=True)
    apart = _BITS_SET[questions[:, None, :] ^ codes[near]].sum(axis=2)
    return coder._replace(radius=int(np.quantile(apart, share, method="higher")))


class Shard(NamedTuple):
    ids: np.ndarray
    vectors: np.ndarray
    codes: np.ndarray
    order: np.ndarray  # PARTS, vectors: by substring value
    starts: np.ndarray  # PARTS, 257: where each value's vectors start in `order`

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray) -> "Shard":
        order = np.stack([np.argsort(codes[:, part], kind="stable") for part in range(PARTS)])
        starts = np.stack([np.searchsorted(codes[order[part], part], np.arange(257)) for part in range(PARTS)])
        return cls(ids, vectors, codes, order, starts)

    def probe(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All vectors whose codes are within the radius, by the pigeonhole principle."""
        if radius >= BITS:
            return np.arange(len(self.ids))
        whole, more = divmod(radius, PARTS)
        seen = np.zeros(len(self.ids), dtype=bool)
        for part in range(PARTS):
            reach = whole if part <= more else whole - 1  # more + 1 substrings take one more than the rest
            starts, order = self.starts[part], self.order[part]
            for value in np.flatnonzero(_DISTANCE[code[part]] <= reach):
                seen[order[starts[value]:starts[value + 1]]] = True
        found = np.flatnonzero(seen)
        return found[_BITS_SET[self.codes[found] ^ code].sum(axis=1) <= radius]


def best(shard: Shard, asked: np.ndarray, questions: np.ndarray, codes: np.ndarray, radius: np.ndarray, wanted: int) -> pd.DataFrame:
    """The best of a shard for each query: query_id, vec_id, score."""
    queries, found, scores = [], [], []
    for own, question, code, reach in zip(asked, questions, codes, radius):
        near = shard.probe(code, int(reach))
        near = near[shard.ids[near] != own]
        if len(near):
            value = (shard.vectors[near] * question).sum(axis=1)  # the same order of addition for every vector
            if len(near) > wanted:
                least = np.partition(value, len(value) - wanted)[len(value) - wanted]
                near, value = near[value >= least], value[value >= least]
            top = np.lexsort((shard.ids[near], -value))[:wanted]
            queries.append(np.full(len(top), own))
            found.append(shard.ids[near[top]])
            scores.append(value[top])
    empty = [np.zeros(0)]
    return pd.DataFrame({"query_id": np.concatenate(queries or empty).astype(np.int64),
                         "vec_id": np.concatenate(found or empty).astype(np.int64),
                         "score": np.concatenate(scores or empty).astype(float)})


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, vector of doubles) of the rows that take part, each once."""
    held = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    fine = held.where("vec_id IS NOT NULL AND size(vector) > 0").where(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))).where(
        F.exists("vector", lambda x: x != 0))
    size = fine.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if size is None:
        return fine
    return fine.where(F.size("vector") == size["size"]).dropDuplicates(["vec_id", "vector"])


def search(vectors: DataFrame, *, every: int = 20, wanted: int = WANTED) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found for each row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = materialise(usable(vectors))
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda held, x: held + x * x))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("norm"),
                    F.count_if(F.col("vec_id") % every == 0).alias("asked"), F.count_distinct("vec_id").alias("ids")).first()
    if not seen["asked"] or seen["ids"] < 2:
        return spark.createDataFrame([], schema)
    sample = sampled(rows, SAMPLE, "vec_id", "vector").toPandas()
    coder = learn(np.array(sample["vector"].tolist()), float(seen["norm"]), wanted)
    shards, blocks = -(-seen["n"] // SHARD), -(-seen["asked"] // QUERY_BLOCK)
    packed = "number int, ids binary, vectors binary, codes binary"

    def pack(queries: bool):
        def packed_group(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("vec_id", kind="stable")
            held = np.array(group["vector"].tolist(), dtype="<f8")
            return pd.DataFrame([{"number": group["number"].iloc[0], "ids": group["vec_id"].to_numpy(dtype="<i8").tobytes(),
                                  "vectors": held.tobytes(), "codes": coder.codes(held, queries).tobytes()}])

        return packed_group

    def dealt(source: DataFrame, parts: int, queries: bool) -> DataFrame:
        number = F.pmod(F.xxhash64("vec_id", F.lit(parts)), F.lit(parts)).cast("int")
        return materialise(source.withColumn("number", number).groupBy("number").applyInPandas(pack(queries), packed))

    index = dealt(rows, shards, False)
    questions = rows.where(F.col("vec_id") % every == 0)

    def merged(asked: DataFrame, blocks: int, radius: int) -> DataFrame:
        def meet(group: pd.DataFrame) -> pd.DataFrame:
            group = group.sort_values("asks", kind="stable")
            if len(group) < 2:
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
            (ids, held, codes), (own, wants, wanted_codes) = (
                (np.frombuffer(row.ids, dtype="<i8"), np.frombuffer(row.vectors, dtype="<f8"), np.frombuffer(row.codes, dtype=np.uint8))
                for row in group.itertuples())
            size = len(held) // len(ids)
            shard = Shard.of(ids, held.reshape(-1, size), codes.reshape(-1, PARTS))
            return best(shard, own, wants.reshape(-1, size), wanted_codes.reshape(-1, PARTS), np.full(len(own), radius), wanted)

        block = dealt(asked, blocks, True)
        one = index.select(F.col("number").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                           F.lit(False).alias("asks"), "ids", "vectors", "codes")
        other = block.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.col("number").alias("block"),
                             F.lit(True).alias("asks"), "ids", "vectors", "codes")
        found = one.unionByName(other).groupBy("shard", "block").applyInPandas(meet, "query_id long, vec_id long, score double")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted).select(
            "query_id", "rank", "vec_id", "score")

    found = materialise(merged(questions, blocks, coder.radius))
    enough = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(wanted, seen["ids"] - 1))
    short = materialise(questions.join(enough, questions["vec_id"] == enough["query_id"], "left_anti"))
    missing = short.count()
    if not missing:
        return found
    again = merged(short, -(-missing // QUERY_BLOCK), BITS)
    return found.join(short.select(F.col("vec_id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
