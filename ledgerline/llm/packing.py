"""Best-fit packing: a grouping genetic algorithm on islands.

Documents are cut into pieces of at most `CAPACITY` tokens; full pieces are sequences as they are. All others are dealt
by hash into blocks of about `BLOCK` pieces. Every block evolves on `ISLANDS` islands, one Spark task each: a population
of packings starts from best fits in disturbed decreasing orders; crossover injects whole well-filled bins of one parent
into another, bins that held any of their pieces are dissolved (no piece twice), and the displaced pieces go to the best
fit, largest first. Between epochs each island's elite migrates to the next island of its block. Afterwards the pieces of
the badly filled bins of all blocks are dealt anew, into fewer blocks, and packed once more.

Only numbers and lengths travel: no task holds more than a block. All chance comes from block and island numbers, and
pieces are numbered in a checkpoint, so a repeated task gives the same rows.

Defined results: NULL and empty texts are documents of one id, the end. Repeated rows and ids are documents of their own.
Ties go to the lower piece number. An empty table gives no rows. Columns of `pieces` pass through; `sequence_id` and
`offset` are added, and replace columns of these names.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.frames import free_name, materialise, whole_text
from ledgerline.llm.token_ids import encoder, vocabulary
from ledgerline.llm.words import slices

CAPACITY, END = 2048, 0
BLOCK, ISLANDS, EPOCHS = 4096, 2, 2
POPULATION, GENERATIONS = 4, 5
WELL_FILLED = 0.995  # bins that crossover hands on
REPACKED = 0.98  # bins below it are packed once more, together with those of other blocks

_STATE = "block long, island int, numbers binary, lengths binary, packings array<binary>"


def pieces_of(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids) of every document: its ids and `end`, little-endian unsigned 32-bit, cut into
    pieces of `capacity` of which the first may be shorter."""
    def cut(batches):
        encode = encoder(path).encode
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for low, high in slices(texts, 5 << 19):
                ids = encode(texts[low:high])
                owner, number, start, length, held = [], [], [], [], []
                for at in range(high - low):
                    own = np.append(ids.flat[ids.starts[at]:ids.starts[at + 1]], np.uint32(end))
                    edges = [0, *range((len(own) - 1) % capacity + 1, len(own) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                        owner.append(low + at)
                        number.append(piece)
                        start.append(a)
                        length.append(b - a)
                        held.append(own[a:b].astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(owner, pa.int64())), pa.array(number, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(held, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(
        cut, f"doc_id {kind}, piece int, start bigint, length bigint, ids binary")


def best_fit(lengths: list[int], order: list[int], bins: np.ndarray, free: list[int], capacity: int) -> None:
    """Put the items of `order` one by one where least room is left over; `bins` and `free` are changed in place."""
    open_bins: dict[int, list[int]] = {}
    rooms = []  # distinct amounts of room, ascending
    for number, room in enumerate(free):
        if room > 0:
            if room in open_bins:
                open_bins[room].append(number)
            else:
                open_bins[room] = [number]
                rooms.append(room)
    rooms.sort()
    for item in order:
        length = lengths[item]
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            held = open_bins[room]
            number = held.pop()
            if not held:
                del open_bins[room], rooms[at]
        else:
            room, number = capacity, len(free)
            free.append(capacity)
        room -= length
        bins[item] = number
        free[number] = room
        if room:
            if room in open_bins:
                open_bins[room].append(number)
            else:
                open_bins[room] = [number]
                rooms.insert(bisect_left(rooms, room), room)


def _tight(bins: np.ndarray) -> np.ndarray:
    """The same packing with bins numbered gaplessly."""
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def fresh(lengths: np.ndarray, disturbance: float, chance: np.random.Generator, capacity: int) -> np.ndarray:
    """Best fit of a (disturbed) decreasing order."""
    weight = lengths * (1 + disturbance * chance.standard_normal(len(lengths))) if disturbance else lengths
    bins = np.zeros(len(lengths), dtype=np.int32)
    best_fit(lengths.tolist(), np.argsort(-weight, kind="stable").tolist(), bins, [], capacity)
    return bins


def fitness(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then unevenly filled ones: they leave room that can be used."""
    fill = np.bincount(bins, weights=lengths) / capacity
    return -len(fill), float((fill ** 2).sum())


def crossover(into: np.ndarray, donor: np.ndarray, lengths: np.ndarray, chance: np.random.Generator, capacity: int) -> np.ndarray:
    """`into` with whole well-filled bins of `donor`: what they displace is packed anew by best fit."""
    fill = np.bincount(donor, weights=lengths)
    good = np.flatnonzero(fill >= WELL_FILLED * capacity)
    if not len(good):
        good = np.flatnonzero(fill >= np.quantile(fill, 0.7))
    chosen = good[chance.random(len(good)) < chance.uniform(0.2, 0.6)]
    injected = np.isin(donor, chosen)
    dissolved = np.zeros(into.max() + 1, dtype=bool)
    dissolved[into[injected]] = True
    weak = np.bincount(into, weights=lengths) < 0.97 * capacity
    dissolved |= weak  # what is badly filled anyway goes as well
    displaced = dissolved[into] & ~injected
    child = into.copy()
    child[injected] = donor[injected] + into.max() + 1
    stays = ~displaced
    number = np.full(len(into), -1, dtype=np.int32)
    if stays.any():
        number[stays] = _tight(child[stays])
        free = (capacity - np.bincount(number[stays], weights=lengths[stays])).astype(np.int64).tolist()
    else:
        free = []
    order = np.flatnonzero(displaced)
    best_fit(lengths.tolist(), order[np.argsort(-lengths[order], kind="stable")].tolist(), number, free, capacity)
    return number


def evolve(lengths: np.ndarray, population: list[np.ndarray], seed: list[int], capacity: int) -> list[np.ndarray]:
    """The population some generations on, best first. It is filled up to `POPULATION` before."""
    chance = np.random.default_rng(seed)
    population = list(population)
    while len(population) < POPULATION:
        population.append(fresh(lengths, 0.0 if not population and seed[1] == 0 else 0.05 * (1 + len(population)), chance, capacity))
    bound = -int(-lengths.sum() // capacity)
    ranked = sorted(population, key=lambda bins: fitness(bins, lengths, capacity), reverse=True)
    for _ in range(GENERATIONS):
        if -fitness(ranked[0], lengths, capacity)[0] <= bound:
            break  # no packing can have fewer bins
        first, second = (ranked[min(chance.integers(0, len(ranked), 2))] for _ in range(2))
        child = crossover(first, second, lengths, chance, capacity)
        ranked = sorted([*ranked, child], key=lambda bins: fitness(bins, lengths, capacity), reverse=True)[:POPULATION]
    return ranked


def _epoch(number: int, capacity: int):
    def epoch(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("guest", kind="stable")
        own = group.iloc[0]
        lengths = np.frombuffer(own["lengths"], dtype="<i4")
        population = [np.frombuffer(held, dtype="<i4") for row in group["packings"] for held in row]
        ranked = evolve(lengths, population, [int(own["block"]) & 0x7FFFFFFF, int(own["island"]), number], capacity)
        return pd.DataFrame([{
            "block": own["block"], "island": own["island"], "numbers": own["numbers"], "lengths": own["lengths"],
            "packings": [held.astype("<i4").tobytes() for held in ranked]}])

    return epoch


def _dealt(items: DataFrame, block_size: int, count: int) -> DataFrame:
    blocks = max(1, -(-count // block_size))
    block = F.pmod(F.xxhash64("number", F.lit(count)), F.lit(blocks))
    grouped = items.groupBy(block.alias("block")).agg(F.sort_array(F.collect_list(F.struct("number", "length"))).alias("held"))
    return grouped


def _packed(items: DataFrame, capacity: int, block_size: int) -> DataFrame:
    """(number, length, bin, fill) of the best packing of each block; a bin is named by its smallest number."""
    count = items.count()
    blocks = _dealt(items, block_size, count).repartition("block")

    def start(frames):
        for frame in frames:
            for row in frame.itertuples():
                numbers = np.array([held["number"] for held in row.held], dtype="<i8")
                lengths = np.array([held["length"] for held in row.held], dtype="<i4")
                for island in range(ISLANDS):
                    yield pd.DataFrame([{"block": row.block, "island": island, "numbers": numbers.tobytes(),
                                         "lengths": lengths.tobytes(), "packings": []}])

    def best(frames):
        for frame in frames:
            for row in frame.itertuples():
                numbers, lengths = np.frombuffer(row.numbers, dtype="<i8"), np.frombuffer(row.lengths, dtype="<i4")
                bins = _tight(np.frombuffer(row.best, dtype="<i4"))
                name = np.full(bins.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(name, bins, numbers)
                fill = np.bincount(bins, weights=lengths).astype(np.int64)
                yield pd.DataFrame({"number": numbers, "length": lengths.astype(np.int64), "bin": name[bins], "fill": fill[bins]})

    state = blocks.mapInPandas(start, _STATE)
    for number in range(EPOCHS):
        own = state.withColumn("guest", F.lit(0))
        if number:  # the elite of each island goes to the next one of its block
            away = state.withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).cast("int"))
            own = own.union(away.withColumn("packings", F.slice("packings", 1, 1)).withColumn("guest", F.lit(1)))
        state = materialise(own.groupBy("block", "island").applyInPandas(_epoch(number, capacity), _STATE))
    elite = F.element_at("packings", 1)
    score = F.struct((-_bins(elite)).alias("fewer"), (-F.col("island")).alias("tie"))
    chosen = state.groupBy("block").agg(
        F.first("numbers").alias("numbers"), F.first("lengths").alias("lengths"), F.max_by(elite, score).alias("best"))
    return chosen.mapInPandas(best, "number long, length long, bin long, fill long")


def _bins(packing):
    @F.pandas_udf("int")
    def bins(held: pd.Series) -> pd.Series:
        return pd.Series([int(np.frombuffer(one, dtype="<i4").max(initial=-1)) + 1 for one in held])

    return bins(packing)


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """`pieces` (with `length`, at most `capacity`) with the sequence and the offset there of each."""
    number = free_name(pieces, "piece_number")
    pieces = pieces.drop("sequence_id", "offset")
    held = materialise(pieces.withColumn(number, F.monotonically_increasing_id()))
    items = held.where(F.col("length") < capacity).select(F.col(number).alias("number"), F.col("length").cast("int").alias("length"))
    first = materialise(_packed(items, capacity, block))
    loose = first.where(F.col("fill") < REPACKED * capacity)
    again = _packed(loose.select("number", F.col("length").cast("int").alias("length")), capacity, block)
    placed = first.where(F.col("fill") >= REPACKED * capacity).unionByName(again)
    earlier = Window.partitionBy("bin").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)  # within `capacity` rows
    places = placed.select(
        F.col("number").alias("_number"), (-1 - F.col("bin")).alias("sequence_id"),
        F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))
    full = held.where(F.col("length") >= capacity).withColumns({"sequence_id": F.col(number), "offset": F.lit(0).cast("long")})
    rest = held.where(F.col("length") < capacity).join(places, F.col(number) == F.col("_number")).drop("_number")
    return full.unionByName(rest).drop(number)


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of all documents."""
    return pack(pieces_of(docs, path or vocabulary("byte_bpe_50k.json")))
