"""The corpus pipeline: five stages over `documents`, each working on all that its predecessor kept.

What a stage makes of NULL, empty and very long texts, ties and repeated rows is stated by its operator's module. NULL and
empty texts are judged, scanned and packed like others (a text without words is a near copy of none and holds no benchmark
item); repeated rows of one text are near copies, of which one stays. Extra columns pass through all stages but the last,
whatever their names, which keeps the pieces alone. An empty table gives an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontamination, near_join, packing, quality, secret_scan
from ledgerline.session import shared_folder
from ledgerline.sources.files import remove


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return near_join.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold benchmark items."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secret_scan.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("secrets", secrets_masked),
    ("packing", packed),
]

ORACLE_SQL = None  # signatures, tiles, networks and packings are beyond SQL; tests/llm has brute-force versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet in the shared folder and read again by the next. What a stage has
    read is deleted once its own output is committed; the last output stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        out = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
        if number:
            remove(spark, f"{folder}/{number - 1}-{STAGES[number - 1][0]}")
    return docs
