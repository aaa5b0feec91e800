"""The thirteen operators and the pipeline as registered queries over the whole tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    collocations, decontamination, fill_middle, hash_search, id_files, near_join, oracles, packing, personal_data, quality,
    secret_scan, token_lengths, url_trust, word_languages,
)
from ledgerline.llm.spans import digest
from ledgerline.llm.token_ids import vocabulary
from ledgerline.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pieces_of(table(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"))
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "tiles")


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = personal_data.scan(docs.select("doc_id", "text"), personal_data.fit(docs))
    return found.select("doc_id", *digest("found", personal_data.KINDS))


def op4_near_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_join.near_classes(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links")


def op5_url_trust(spark: SparkSession, folder: str) -> DataFrame:
    return url_trust.judge(table(spark, folder, "pages"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = quality.score(docs, quality.fit(docs, table(spark, folder, "labels")))
    held_out = F.coalesce(quality.remainder() == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_hash_search(spark: SparkSession, folder: str) -> DataFrame:
    return hash_search.search(table(spark, folder, "embeddings"))


def op8_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = secret_scan.scan(docs.select("doc_id", "text"), secret_scan.fit(docs))
    return found.select("doc_id", *digest("found", tuple(secret_scan.RULES)))


def op9_token_lengths(spark: SparkSession, folder: str) -> DataFrame:
    return token_lengths.histogram(table(spark, folder, "documents"))


def op10_id_files(spark: SparkSession, folder: str) -> DataFrame:
    files = f"{shared_folder(spark)}/ids-{uuid.uuid4().hex}"
    id_files.write(table(spark, folder, "documents"), files, vocabulary("word_bpe_49k.json"))
    return id_files.documents(spark, files)


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op12_word_languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    judged = word_languages.identify(docs.select("doc_id", "text"), word_languages.fit(docs))
    held_out = F.coalesce(word_languages.remainder() == 2, F.lit(False))
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle.restore(fill_middle.transform(table(spark, folder, "documents").select("doc_id", "text")))
    digest = lambda name: F.sha2(F.col(name).cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"),
                       digest("restored").alias("restored_sha256"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_personal_data": op3_personal_data,
    "op4_near_join": op4_near_join,
    "op5_url_trust": op5_url_trust,
    "op6_quality": op6_quality,
    "op7_hash_search": op7_hash_search,
    "op8_secrets": op8_secrets,
    "op9_token_lengths": op9_token_lengths,
    "op10_id_files": op10_id_files,
    "op11_collocations": op11_collocations,
    "op12_word_languages": op12_word_languages,
    "op13_fill_middle": op13_fill_middle,
}

ORACLES: dict[str, str] = {"op11_collocations": oracles.COLLOCATIONS, "op13_fill_middle": oracles.FILL_MIDDLE}
