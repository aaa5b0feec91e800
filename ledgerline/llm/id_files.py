"""Token-ID files: ids of all documents, in id order, as independently reset, checksummed, arithmetically coded blocks.

Documents are range-partitioned and sorted by id; every partition encodes its texts, appends the end id to each, and cuts
the stream into blocks of `id_coder.BLOCK` ids. A row of the files is one block: its file (the partition) and place there,
the documents it holds parts of, the coded bytes and their crc32. Rows are written by Spark into a Parquet folder, so the
files work wherever Spark can write, and any block can be read and checked alone. Ids are at most two bytes wide.

Reading checks every block, decodes many abreast, and puts documents together again: their place in the whole stream comes
from totals by file and running sums inside a file, their crc32 from the crc32s of their parts.

Defined results: NULL and empty texts are documents of the end id alone. Ids that repeat or are NULL are documents of
their own, in the order of their texts, NULL first. An empty table gives files without rows. Only id and text are read.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.frames import whole_text
from ledgerline.llm.id_coder import BLOCK, LANES, decode, encode
from ledgerline.llm.token_ids import encoder
from ledgerline.llm.words import slices

END = 2


def _coded(path: str, end: int):
    def flush(blocks, parts, file, first):
        order = sorted(range(len(blocks)), key=lambda at: -len(blocks[at]))
        payloads = dict(zip(order, encode([blocks[at] for at in order])))
        for at, block in enumerate(blocks):
            payload = payloads[at]
            yield (file, first + at, len(block), parts[at], payload, zlib.crc32(payload))

    def batch_of(rows, kind):
        columns = list(zip(*rows))
        held = pa.struct([("doc", pa.int64()), ("doc_id", kind), ("part", pa.int32()), ("length", pa.int64())])
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.list_(held), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(list(column), one) for column, one in zip(columns, kinds)],
                                          names=["file", "block", "n_ids", "docs", "payload", "crc32"])

    def coded(batches):
        encode_texts = encoder(path).encode
        file = TaskContext.get().partitionId()
        waiting: list[np.ndarray] = []
        held = number = done = 0  # ids waiting, documents seen, blocks written
        blocks, parts, part = [], [], []
        room, kind = BLOCK, pa.int64()

        def close():
            nonlocal waiting, part, room
            blocks.append(np.concatenate(waiting))
            parts.append(part)
            waiting, part, room = [], [], BLOCK

        for batch in batches:
            texts, ids_of = batch.column("text").to_pylist(), batch.column("doc_id")
            kind = ids_of.type
            for low, high in slices(texts, 5 << 19):
                ids = encode_texts(texts[low:high])
                for at in range(high - low):
                    own = np.append(ids.flat[ids.starts[at]:ids.starts[at + 1]], np.uint32(end))
                    if own.max() > 0xFFFF:
                        raise ValueError("ids wider than two bytes")
                    doc_id, piece = ids_of[low + at].as_py(), 0
                    while len(own):
                        take = min(room, len(own))
                        waiting.append(own[:take])
                        part.append({"doc": number, "doc_id": doc_id, "part": piece, "length": take})
                        own, room, piece = own[take:], room - take, piece + 1
                        if not room:
                            close()
                    number += 1
                if len(blocks) >= LANES:
                    yield batch_of(list(flush(blocks, parts, file, done)), kind)
                    done += len(blocks)
                    blocks, parts = [], []
        if waiting:
            close()
        if blocks:
            yield batch_of(list(flush(blocks, parts, file, done)), kind)

    return coded


def write(docs: DataFrame, folder: str, path: str, *, end: int = END) -> None:
    """Write the ids of all documents below `folder`, in ascending order of doc_id."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    tie = F.xxhash64("text")
    rows = docs.select("doc_id", whole_text().alias("text"))
    rows = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    rows.mapInArrow(
        _coded(path, end),
        f"file int, block long, n_ids int, docs array<struct<doc:bigint,doc_id:{kind},part:int,length:bigint>>, payload binary, crc32 long",
    ).write.parquet(folder)


def _decoded(kind: pa.DataType):
    def parts(batches):
        for batch in batches:
            counts = np.array(batch.column("n_ids").to_pylist(), dtype=np.int64)
            payloads, sums, docs = (batch.column(name).to_pylist() for name in ("payload", "crc32", "docs"))
            files, numbers = batch.column("file").to_pylist(), batch.column("block").to_pylist()
            if any(zlib.crc32(payload) != crc for payload, crc in zip(payloads, sums)):
                raise ValueError("a block does not match its checksum")
            order = np.argsort(-counts, kind="stable")
            for chosen in np.array_split(order, max(1, -(-len(order) // (LANES + LANES // 8)))):  # of about equal numbers
                chosen = chosen.tolist()
                rows = {name: [] for name in ("file", "block", "doc", "doc_id", "part", "length", "ids")}
                for at, ids in zip(chosen, decode([payloads[at] for at in chosen], [int(counts[at]) for at in chosen])):
                    place = 0
                    for one in docs[at]:
                        own = ids[place:place + one["length"]]
                        place += one["length"]
                        for name, value in (("file", files[at]), ("block", numbers[at]), ("ids", own.astype("<u4").tobytes())):
                            rows[name].append(value)
                        for name in ("doc", "doc_id", "part", "length"):
                            rows[name].append(one[name])
                kinds = [pa.int32(), pa.int64(), pa.int64(), kind, pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(rows[name], one) for name, one in zip(rows, kinds)], names=list(rows))

    return parts


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    """(file, block, doc, doc_id, part, length, ids) from the files: `doc` numbers documents in a file, `part` the parts
    of a document, `ids` are little-endian unsigned 32-bit."""
    from pyspark.sql.pandas.types import to_arrow_type

    blocks = spark.read.parquet(folder)
    kind = blocks.schema["docs"].dataType.elementType["doc_id"].dataType
    return blocks.mapInArrow(
        _decoded(to_arrow_type(kind)),
        f"file int, block bigint, doc bigint, doc_id {kind.simpleString()}, part int, length bigint, ids binary")


def _times(a: int, b: int) -> int:
    """The product of two polynomials of crc32's field, lowest powers in the highest bits."""
    out = 0
    while b:
        if b & 0x80000000:
            out ^= a
        a = (a >> 1) ^ (0xEDB88320 if a & 1 else 0)
        b = (b << 1) & 0xFFFFFFFF
    return out


@lru_cache(maxsize=1 << 14)  # parts within blocks have few different lengths
def _zeros(size: int) -> int:
    """What `size` zero bytes multiply a crc32 register by: x to the power of eight times `size`."""
    power, square = 0x80000000, 0x00800000  # 1, and x to the power of 8
    while size:
        if size & 1:
            power = _times(power, square)
        square = _times(square, square)
        size >>= 1
    return power


def joined_crc32(parts: list[tuple[int, int]]) -> int:
    """The crc32 of parts put together, from (crc32, bytes) of each."""
    whole = 0
    for crc, size in parts:
        whole = _times(_zeros(size), whole) ^ crc
    return whole


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    @F.pandas_udf("long")
    def whole_crc(parts: pd.Series) -> pd.Series:
        return pd.Series([joined_crc32([(one["crc"], 4 * one["length"]) for one in held]) for held in parts])

    parts = read_parts(spark, folder).select("file", "doc", "doc_id", "part", "length", F.crc32("ids").alias("crc"))
    held = parts.groupBy("file", "doc", "doc_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("part", "crc", "length"))).alias("parts"))
    blocks = spark.read.parquet(folder)
    files = blocks.groupBy("file").agg(F.sum("n_ids").cast("long").alias("ids"))
    earlier = F.sum("ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))  # one row for each file
    files = files.select(F.col("file").alias("_file"), F.coalesce(earlier, F.lit(0)).alias("before"))
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = blocks.select("file", "block", "docs", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)  # a block's documents
    firsts = places.select("file", "block", "ahead", F.posexplode("docs").alias("at", "one")).withColumn(
        "skip", F.col("ahead") + F.coalesce(F.sum("one.length").over(within), F.lit(0)))
    firsts = firsts.where("one.part = 0").select(
        F.col("file").alias("_at_file"), F.col("one.doc").alias("_at_doc"), "skip")
    return held.join(firsts, (held["file"] == firsts["_at_file"]) & (held["doc"] == firsts["_at_doc"])).join(
        files, F.col("file") == F.col("_file")).select(
        "doc_id", (F.col("before") + F.col("skip")).alias("start"), "n_tokens",
        F.when(F.size("parts") == 1, F.col("parts")[0]["crc"]).otherwise(whole_crc("parts")).alias("ids_crc32"))
