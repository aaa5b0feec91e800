"""The pipeline's stages on the supplied documents and on odd ones: what they keep, and that it comes through whole."""

from __future__ import annotations

import corpus_pipeline
from ledgerline.llm import decontamination, near_join, quality, secret_scan
from llm_samples import documents
from tests.conftest import SMALL


def test_stages_run_in_order(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontamination", "secrets", "packing"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, before, SMALL).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        ids = {row.doc_id for row in docs.select("doc_id").collect()}
        assert ids <= {row.doc_id for row in before.select("doc_id").collect()}
        if name != "packing":
            assert docs.columns == columns
        if name == "quality":
            model = quality.fit(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
            assert docs.count() == quality.score(before, model).where("score >= 0.5").count()
        if name == "near_copies":
            assert near_join.near_classes(docs).agg({"n_links": "sum"}).first()[0] == 0
        if name == "decontamination":
            assert decontamination.contaminated(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet")).count() == 0
        if name == "secrets":
            assert ids == {row.doc_id for row in before.select("doc_id").collect()}
            assert not any(secret_scan.by_rules(row.text or "") for row in docs.collect())
    assert ids == {row.doc_id for row in before.select("doc_id").collect()}
    assert docs.count() == corpus_pipeline.run(spark, SMALL).count()


def test_odd_documents_come_through(spark, folder):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    assert docs.count() > 0
