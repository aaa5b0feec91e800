"""Frequent phrases of a corpus and how strongly their words hold together, by mergeable Misra-Gries summaries.

Texts are lower-cased in A-Z, cut at `[.,;:!?\\x0A-\\x0D]` into pieces and these at blanks and tabs into words. Everything is
counted for each language (NULL is `und`).

1. Every task gives summaries of its texts' n-grams: sorted 48-bit keys with exact counts, one summary for each hash partition.
2. A summary of a partition takes them in one after the other. Beyond its capacity it lowers all counters by the largest
   one that has to go, as Misra and Gries do, and remembers by how much in all. That is at most mass / capacity; a
   capacity beyond mass / threshold keeps it below the threshold, and where a partition's mass is larger than expected (one
   n-gram may hold a third of it) the capacity grows before the threshold is reached. So every n-gram that reaches the
   threshold has a counter left; those whose counter and loss together reach it survive. N-grams that share a key share a
   counter, which can only add survivors.
3. The survivors' keys become a bitmap of bounded size. Two rounds: words and word pairs first, then longer n-grams all of
   whose pairs survived, as an n-gram is no more frequent than its parts.
4. A last pass over the texts counts the n-grams whose keys are in the bitmaps, by their words themselves. What a bitmap let
   through in vain is dropped here; a full bitmap would cost work, not results.

The capacity counters are the only thing held a task; the number of hash partitions grows with the texts. Counts are
compared and scored in decimals of 38 digits, so no product overflows.

NULL and empty texts have no words. Very long texts are cut at line feeds and other piece ends for the work, never a piece.
Ties in the cut go to the smaller first part, ties in the ranking to the larger count, then to the phrase by its UTF-8
bytes. Repeated rows count each. An empty table gives an empty one. Only the text and the language column are read, so
other columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.frames import materialise, whole_text
from ledgerline.llm.words import mix
from ledgerline.operators.lookup import lookup

NO_LANGUAGE = "und"
KEY_BITS = 48
CAPACITY = 1 << 20  # counters of one partition's summary
PENDING = 1 << 20  # keys that a summary gathers before it merges them
SLICE_BYTES = 1 << 23
LEAST_BITS, MOST_BITS = 22, 28  # the sieves' sizes, as powers of two; they follow the survivors in between
PLACES_A_SURVIVOR = 64
_PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_PLAIN = bytes.maketrans(_PIECE_ENDS + b"\t", b"\n" * len(_PIECE_ENDS) + b" ")


class Words:
    """The words of one language's texts in a slice: numbers of distinct words, and the piece of each word."""

    def __init__(self, data: bytes, language: str):
        held = data.split()
        self.numbers, distinct = pd.factorize(np.array(held, dtype=object)) if held else (np.zeros(0, dtype=np.int64), [])
        self.distinct = list(distinct)
        codes = np.frombuffer(data, dtype=np.uint8)
        inside = (codes != 32) & (codes != 10)
        starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
        self.piece = np.searchsorted(np.flatnonzero(codes == 10), starts)
        seed = xxhash.xxh64_intdigest(language.encode("utf-8", "surrogatepass"))
        self.hashes = np.fromiter(
            (xxhash.xxh64_intdigest(word, seed) for word in self.distinct), dtype=np.uint64, count=len(self.distinct))

    def phrase(self, at: int, size: int) -> str:
        return b" ".join(self.distinct[number] for number in self.numbers[at:at + size]).decode("utf-8", "replace")


class Grams:
    """N-grams of one size in a slice: where each occurrence begins, which distinct n-gram it is, and these ones' keys."""

    def __init__(self, words: Words, at: np.ndarray, code: np.ndarray, size: int):
        self.size, self.at = size, at
        values, first, self.which, self.counts = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        self.first = at[first]
        keys = np.zeros(len(values), dtype=np.uint64)
        for step in range(size):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + words.hashes[words.numbers[self.first + step]] + np.uint64(size))
        self.keys = keys >> np.uint64(64 - KEY_BITS)


def grams(words: Words, longest: int, wanted) -> Iterator[Grams]:
    """All n-grams by size. `wanted(grams)` says which distinct ones may be part of longer ones; exact numbers, no hashes."""
    at = np.arange(len(words.numbers))
    code = words.numbers.astype(np.int64)
    many = max(len(words.distinct), 1)
    for size in range(1, longest + 1):
        found = Grams(words, at, code, size)
        yield found
        if size == longest:
            return
        # An n-gram goes on with the one that starts at its second word: both must be wanted, and in one piece.
        number = np.full(len(words.numbers) + 1, -1, dtype=np.int64)
        number[at] = np.where(wanted(found)[found.which], found.which, -1) if len(at) else 0
        keep = np.zeros(len(at), dtype=bool)
        inside = at + size < len(words.numbers)
        keep[inside] = words.piece[at[inside]] == words.piece[at[inside] + size]
        keep &= (number[at] >= 0) & (number[np.minimum(at + 1, len(words.numbers))] >= 0)
        at = at[keep]
        code = number[at] * many + words.numbers[at + size]


def _everything(found: Grams) -> np.ndarray:
    return np.ones(len(found.keys), dtype=bool)


def slices(frames: Iterable[pd.DataFrame]) -> Iterator[tuple[str, bytes]]:
    """(language, plain text) with about SLICE_BYTES each; pieces end with line feeds, words with blanks."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def cut(parts: list[bytes]) -> Iterator[bytes]:
        data = b"\n".join(parts) + b"\n"
        begin = 0
        while begin < len(data):
            end = data.find(b"\n", begin + SLICE_BYTES) + 1
            yield data[begin:end or len(data)]
            begin = end or len(data)

    for frame in frames:
        for language, text in zip(frame["_lang"], frame["_text"]):
            raw = text.encode("utf-8", "surrogatepass").lower().translate(_PLAIN)
            held.setdefault(language, []).append(raw)
            size += len(raw) + 1
            if size >= SLICE_BYTES:
                for one, parts in held.items():
                    yield from ((one, data) for data in cut(parts))
                held, size = {}, 0
    for one, parts in held.items():
        yield from ((one, data) for data in cut(parts))


class Summary:
    """A mergeable Misra-Gries summary whose loss stays below the threshold."""

    def __init__(self, threshold: int, capacity: int = CAPACITY):
        self.threshold, self.capacity = threshold, max(capacity, 1)
        self.keys = np.zeros(0, dtype=np.uint64)
        self.counts = np.zeros(0, dtype=np.int64)
        self.lost = self.mass = 0

    def absorb(self, keys: np.ndarray, counts: np.ndarray, lost: int = 0) -> None:
        """Take in another summary: its counters and what it has lost already."""
        self.lost += lost
        self.mass += int(counts.sum())
        merged, place = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        held = np.bincount(place, weights=np.concatenate([self.counts, counts]), minlength=len(merged)).astype(np.int64)
        while len(merged) > self.capacity:
            down = int(np.partition(held, len(held) - self.capacity - 1)[len(held) - self.capacity - 1])
            if self.lost + down >= self.threshold:
                self.capacity *= 2
                continue
            self.lost += down
            left = held > down
            merged, held = merged[left], held[left] - down
        self.keys, self.counts = merged, held

    def survivors(self) -> np.ndarray:
        return self.keys[self.counts + self.lost >= self.threshold]


class Sieve:
    """A set of keys as bits; a key that is not in it may be found by chance, one that is always is."""

    def __init__(self, bits: int, data: bytes):
        self.bits, self.data = bits, np.frombuffer(data, dtype=np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(KEY_BITS - self.bits)
        return (self.data[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("_lang"), whole_text(text).alias("_text"))


def _packed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as differences byte by byte, counts likewise, both compressed."""
    def planes(values: np.ndarray) -> bytes:
        return zlib.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)

    return planes(np.diff(keys, prepend=np.uint64(0))), planes(counts.astype(np.uint64))


def _unpacked(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    def values(data: bytes) -> np.ndarray:
        raw = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(8, -1)
        return np.ascontiguousarray(raw.T).view("<u8").ravel()

    return np.cumsum(values(keys), dtype=np.uint64), values(counts).astype(np.int64)


def survivors(texts: DataFrame, sizes: range, threshold: int, partitions: int, sieve) -> DataFrame:
    """(key) of the n-grams of these sizes that may reach the threshold; `sieve` limits what longer ones are made of."""
    def summarised(frames):
        known = sieve.value if sieve else None
        wanted = lambda found: known.has(found.keys) if known and found.size == 2 else _everything(found)
        out = []
        for language, data in slices(frames):
            for found in grams(Words(data, language), max(sizes), wanted):
                if found.size not in sizes:
                    continue
                order = np.argsort(found.keys)
                keys, counts = found.keys[order], found.counts[order]
                # The partition is the key's highest part, so each one's keys are a run of the sorted keys.
                part = ((keys >> np.uint64(KEY_BITS - 24)).astype(np.int64) * partitions) >> 24
                edges = np.searchsorted(part, np.arange(partitions + 1)) if partitions < len(keys) else None
                runs = (zip(range(partitions), edges[:-1], edges[1:]) if edges is not None else
                        ((int(part[a]), a, b) for a, b in _runs(part)))
                out += [(number, *_packed(keys[a:b], counts[a:b])) for number, a, b in runs if b > a]
            yield pd.DataFrame(out, columns=["part", "keys", "counts"])
            out = []

    def merged(frames):
        tables: dict[int, Summary] = {}
        waiting: dict[int, list] = {}
        pending = Counter()

        def settle(number):
            parts = waiting.pop(number)
            pending[number] = 0
            tables.setdefault(number, Summary(threshold)).absorb(
                np.concatenate([keys for keys, _ in parts]), np.concatenate([counts for _, counts in parts]))

        for frame in frames:
            for row in frame.itertuples(index=False):
                keys, counts = _unpacked(row.keys, row.counts)
                waiting.setdefault(row.part, []).append((keys, counts))
                pending[row.part] += len(keys)
                if pending[row.part] >= PENDING:
                    settle(row.part)
        for number in list(waiting):
            settle(number)
        for table in tables.values():
            yield pd.DataFrame({"key": table.survivors().astype(np.int64)})

    dealt = texts.mapInPandas(summarised, "part int, keys binary, counts binary").repartition(partitions, "part")
    return dealt.mapInPandas(merged, "key long")


def _runs(part: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(part, prepend=-1))
    return zip(edge.tolist(), np.append(edge[1:], len(part)).tolist())


def build_sieve(keys: DataFrame) -> Sieve:
    """The keys as bits. Its size follows their number up to MOST_BITS; it comes to the driver as blocks of 4 KB."""
    keys = materialise(keys)
    wanted = max(1, keys.count() * PLACES_A_SURVIVOR)
    bits = min(max(LEAST_BITS, (wanted - 1).bit_length()), MOST_BITS)
    place = F.shiftright("key", KEY_BITS - bits)
    blocks = keys.groupBy(F.shiftright(place, 15).alias("block")).agg(
        F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("held"))
    data = bytearray((1 << bits) // 8)
    for row in blocks.collect():
        data[row.block * 4096:(row.block + 1) * 4096] = row.held
    return Sieve(bits, bytes(data))


def phrase_counts(
    docs: DataFrame, words: int, *, text: str = "text", lang: str = "lang", least: int = 30, longest: int = 4,
) -> DataFrame:
    """(lang, phrase, size, a) of all phrases of one to `longest` words that occur `least` times or more in their language.

    `words` is the number of all words: no more n-grams of one size than that are counted.
    """
    spark = docs.sparkSession
    texts = _texts(docs, text, lang)
    sieves = []
    for sizes in (range(1, 3), range(3, longest + 1)):
        if len(sizes):
            partitions = words * len(sizes) // (least * CAPACITY) + 1
            first = sieves[0] if sieves else None
            sieves.append(spark.sparkContext.broadcast(
                build_sieve(survivors(texts, sizes, least, partitions, first))))

    def counted(frames):
        held = [sieve.value for sieve in sieves]
        wanted = lambda found: held[found.size > 2].has(found.keys)
        for language, data in slices(frames):
            words = Words(data, language)
            for found in grams(words, longest, wanted):
                kept = np.flatnonzero(wanted(found))
                if not len(kept):
                    continue
                yield pd.DataFrame({
                    "lang": language, "phrase": [words.phrase(at, found.size) for at in found.first[kept].tolist()],
                    "size": found.size, "a": found.counts[kept]})

    rows = texts.mapInPandas(counted, "lang string, phrase string, size int, a long")
    return rows.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def word_totals(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, n): all words of each language."""
    plain = F.regexp_replace(whole_text(text), "[.,;:!?\\x0A-\\x0D\\t ]+", " ")
    words = F.length(F.trim(plain)) - F.length(F.translate(F.trim(plain), " ", "")) + (F.trim(plain) != "").cast("int")
    language = F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE))
    return docs.select(language.alias("lang"), words.cast("long").alias("n")).groupBy("lang").agg(F.sum("n").alias("n"))


def _key(phrase: Column) -> Column:
    return F.concat_ws("\t", phrase, "lang")  # a phrase has no tab


def _times(name: str, number: int) -> Column:
    return F.lit(number).cast("decimal(10,0)") * F.col(name).cast("decimal(20,0)")


def cut_score() -> Column:
    """floor(2000000 * a / (l + r)), exact for all counts of 64 bits."""
    return F.call_function("div", _times("a", 2_000_000), F.col("l").cast("decimal(20,0)") + F.col("r").cast("decimal(20,0)"))


def collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 30, longest: int = 4, inside: int = 80,
    first: int = 2000,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `first` best phrases of two or more words of each language.

    A phrase is dropped if a longer frequent one that contains it has `inside` percent of its occurrences or more.
    """
    totals = materialise(word_totals(docs, text=text, lang=lang))
    words = totals.agg(F.sum("n").alias("n")).first()["n"] or 0
    counts = materialise(phrase_counts(docs, words, text=text, lang=lang, least=least, longest=longest))
    entries = counts.select(_key(F.col("phrase")).alias("key"), "a")
    candidates = counts.where("size > 1").withColumn("words", F.split("phrase", " "))

    def part(begin: Column | int, size: Column) -> Column:
        return F.array_join(F.slice("words", begin, size), " ")

    # Containment: the largest count of a longer phrase around each phrase.
    around = candidates.where("size > 2").select("lang", "words", "size", "a").withColumn(
        "length", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn(
        "begin", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    largest = around.groupBy(_key(part(F.col("begin"), F.col("length"))).alias("key")).agg(F.max("a").alias("around"))
    held = candidates.withColumn("key", _key(F.col("phrase"))).join(largest, "key", "left")
    held = held.where(F.col("around").isNull() | (_times("around", 100) < _times("a", inside)))

    # Every cut meets the counts of its two parts; a part of many phrases ("of the ...") is salted by the look-up.
    cuts = held.select("lang", "phrase", "words", "size", "a").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumn("left_key", _key(part(F.lit(1), F.col("k")))).withColumn(
        "right_key", _key(part(F.col("k") + 1, F.col("size") - F.col("k")))).drop("words")
    for side, name in (("left_key", "l"), ("right_key", "r")):
        cuts = lookup(cuts, entries.select(F.col("key").alias(side), F.col("a").alias(name)), side)
    cuts = cuts.withColumn("score", cut_score())
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    return lookup(best_of(best, first), totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def best_of(rows: DataFrame, first: int) -> DataFrame:
    """The `first` rows of each language in two steps, so that no task sorts a whole language."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    place = F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))
    few = dealt.withColumn("rank", place).where(F.col("rank") <= first).drop("rank", "share")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return few.withColumn("rank", rank).where(F.col("rank") <= first)
