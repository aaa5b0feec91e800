"""Collocations, word languages and fill-in-the-middle texts against brute force, SQL, round trips and held-out accuracy."""

from __future__ import annotations

import glob
import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import collocations, fill_middle, word_languages
from ledgerline.llm.queries import ORACLES, QUERIES
from llm_samples import documents
from tests.conftest import SMALL

A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(found.columns)
    assert Counter(tuple(row[column] for column in columns) for row in found.collect()) == Counter(result.fetchall())


# Collocations


def phrases(rows, least, longest=4, inside=80, first=2000):
    counts, words = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(A_TO_Z)):
            held = re.findall("[^\x20\x09]+", piece)
            words[lang] += len(held)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(held[at:at + size]) for at in range(len(held) - size + 1))
    out = []
    for lang, f in counts.items():
        frequent = {gram: a for gram, a in f.items() if len(gram) > 1 and a >= least}
        dropped = {gram[at:at + size] for gram, a in frequent.items() for size in range(2, len(gram))
                   for at in range(len(gram) - size + 1) if 100 * a >= inside * frequent[gram[at:at + size]]}
        best = []
        for gram, a in frequent.items():
            if gram not in dropped:
                score, cut = min((2_000_000 * a // (f[gram[:k]] + f[gram[k:]]), k) for k in range(1, len(gram)))
                best.append((-score, -a, " ".join(gram).encode(), f[gram[:cut]], f[gram[cut:]]))
        out += [(lang, rank, phrase.decode(), -a, l, r, words[lang], -score)
                for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:first], start=1)]
    return sorted(out)


def check_phrases(docs, **how):
    wanted = phrases([(row.lang, row.text) for row in docs.collect()], **how)
    assert sorted(tuple(row) for row in collocations.collocations(docs, **how).collect()) == wanted
    return wanted


def test_collocations(spark):
    assert check_phrases(table(spark, "documents"), least=5, first=40)


def test_collocations_of_odd_documents(spark):
    docs = documents(spark).withColumn("lang", F.when(F.col("doc_id") % 3 != 0, F.lit("en")))
    assert check_phrases(docs.withColumn("rank", F.lit(1)), least=2)


def test_collocations_with_full_summaries(spark, monkeypatch):
    """Few counters, many partitions, small slices and tiny sieves: the same phrases."""
    for name, value in (("CAPACITY", 60), ("PENDING", 50), ("SLICE_BYTES", 5_000), ("LEAST_BITS", 15), ("MOST_BITS", 15)):
        monkeypatch.setattr(collocations, name, value)
    chance = random.Random(4)
    common = ["the", "of", "a", "new", "york", "city", "in", "is"]
    texts = [(at, " ".join(chance.choice(common) if chance.random() < 0.8 else f"w{chance.randrange(3000)}" for _ in range(120)),
              chance.choice(["en", "xx", None])) for at in range(80)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, lang string").repartition(3)
    assert check_phrases(docs, least=12)


def test_summary_keeps_every_frequent_key():
    """Merging in any order, a key that reaches the threshold survives, also where one key has most of the mass."""
    chance = np.random.default_rng(2)
    stream = np.concatenate([chance.integers(0, 5_000, 20_000), np.full(9_000, 7), np.repeat(np.arange(100, 140), 25)]).astype(np.uint64)
    chance.shuffle(stream)
    true = Counter(stream.tolist())
    for capacity in (1, 50, 1_400):
        table = collocations.Summary(25, capacity)
        for part in np.array_split(stream, 30):
            table.absorb(*np.unique(part, return_counts=True))
        assert table.lost < 25 and table.mass == len(stream)
        assert {key for key, count in true.items() if count >= 25} <= set(table.survivors().tolist())
        assert all(true[key] - table.lost <= count <= true[key] for key, count in zip(table.keys.tolist(), table.counts.tolist()))
        assert len(table.keys) <= table.capacity < 2 * len(true) + 2
        assert capacity <= len(stream) // 25 or table.capacity == capacity  # beyond mass / threshold it never grows


def test_collocations_are_exact_beyond_64_bits(spark):
    rows = [(9 * 10**18, 9 * 10**18, 9 * 10**18), (7, 10**18, 3), (9 * 10**18 - 1, 9 * 10**18, 9 * 10**18), (30, 30, 31)]
    found = spark.createDataFrame(rows, "a long, l long, r long").select("a", "l", "r", collocations.cut_score().alias("score"))
    assert [row.score for row in found.collect()] == [2_000_000 * a // (l + r) for a, l, r in rows]


def test_collocations_of_no_rows(spark):
    assert collocations.collocations(table(spark, "documents").limit(0)).count() == 0


# Word languages


def test_forward_backward_is_exact():
    chance = np.random.default_rng(1)
    sizes = [1, 63, 64, 65, 200, 0, 7, 128]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    emission, start, chain = chance.normal(size=(starts[-1], 3)) * 3, chance.normal(size=3), chance.normal(size=(3, 3)) * 2
    found = word_languages.forward_backward(emission, starts, start, chain)

    def total(x, axis):
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for begin, end in zip(starts[:-1], starts[1:]):
        e = emission[begin:end]
        a, b = np.zeros_like(e), np.zeros_like(e)
        for t in range(len(e)):
            a[t] = e[t] + (start if t == 0 else total(a[t - 1][:, None] + chain, 0))
        for t in range(len(e) - 2, -1, -1):
            b[t] = total(chain + (e[t + 1] + b[t + 1])[None], 1)
        both = np.exp(a + b - (a + b).max(axis=1, keepdims=True)) if len(e) else e
        assert np.allclose(found[begin:end], both / both.sum(axis=1, keepdims=True) if len(e) else e)


@pytest.fixture(scope="module")
def model(spark):
    return word_languages.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_languages(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = word_languages.identify(docs, model).where(word_languages.remainder() == 2).select("lang", "lang_pred", "score").collect()
    assert len(judged) > 150 and np.mean([row.lang == row.lang_pred for row in judged]) > 0.98
    assert all(0 <= row.score <= 1 for row in judged)


def test_switches_are_labelled(model):
    parts = [("en", "the and of with that is for"), ("de", "der die und nicht ist das ein"), ("fr", "les des une dans pour est"),
             ("en", "the of and to with this")]
    text = ". ".join(words for _, words in parts)
    runs = word_languages.label([text], model)[0]
    assert [language for _, _, language in runs] == [language for language, _ in parts]
    assert [text[a:b] for a, b, _ in runs] == [words for _, words in parts]
    share = word_languages.shares([text], model)[0]
    assert model.languages[share.argmax()] == "en" and abs(share.sum() - 1) < 1e-9


def test_labels_are_never_inputs(spark, model):
    """Held-out rows teach nothing, and a prediction depends on the text alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lied = docs.withColumn("lang", F.when(word_languages.remainder() == 2, F.lit("zz")).otherwise(F.col("lang")))
    other = word_languages.fit(lied)
    assert other.languages == model.languages and np.array_equal(other.weights, model.weights) and other.lexicon == model.lexicon
    score = lambda rows: {row.doc_id: (row.lang_pred, row.score) for row in word_languages.identify(rows, model).collect()}
    assert score(docs) == score(lied.withColumn("source", F.lit("x")))


def test_languages_of_odd_documents(spark, model):
    docs = documents(spark)
    judged = word_languages.identify(docs.withColumn("lang_pred", F.lit(1)), model)
    assert judged.columns == [*docs.columns, "lang_pred", "score"] or set(judged.columns) == {*docs.columns, "lang_pred", "score"}
    rows = judged.collect()
    assert len(rows) == docs.count()
    for row in rows:
        letters = any(map(str.isalpha, row.text or ""))
        assert (row.lang_pred == "und") == (not letters) and (letters or row.score == 0)
    assert word_languages.label(["", "12 ½ !!", "x1y"], model)[:2] == [[], []]


def test_languages_without_teachers(spark, model):
    docs = table(spark, "documents")
    assert word_languages.fit(docs.limit(0)) is None and word_languages.fit(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {row.lang_pred for row in word_languages.identify(docs, None).collect()} == {"und"}
    assert word_languages.identify(docs.limit(0), model).count() == 0
    one = word_languages.fit(docs.where("lang = 'de'"))
    assert one.languages == ["de"] and word_languages.shares(["hello there"], one).tolist() == [[1.0]]


# Fill in the middle


def rebuilt(doc_id, text, share=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * group:8 * group + 8], 16) for group in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= share:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("how", [{}, {"share": 60, "spm": 20, "seed": 11}])
@pytest.mark.parametrize("kind", ["supplied", "odd"])
def test_fill_middle(spark, kind, how):
    docs = table(spark, "documents") if kind == "supplied" else documents(spark)
    rows = fill_middle.restore(fill_middle.transform(docs.withColumns({"N": F.lit(1), "form": F.lit("x"), "_body": F.lit(2)}), **how)).collect()
    wanted = Counter(rebuilt(row.doc_id, row.text, **how) for row in docs.collect())
    assert wanted == Counter((row.doc_id, row.n, row.form, row.prefix_chars, row.middle_chars, row.output) for row in rows)
    assert all(row.restored == (row.text or "") and row._body == 2 for row in rows)


def test_fill_middle_of_hard_texts(spark, monkeypatch):
    """Marks and halves of marks, line feeds alone, other line ends, astral characters, texts larger than a slice."""
    monkeypatch.setattr(fill_middle, "SLICE_BYTES", 50)
    texts = ["\n", "\n\n\n", "a\r\nb\rc", "<P", "x<\nS>\n<M", "<P>", "a<S>b", "mid <M> x\n", "\U0001f600\n\U0001f601\nz", "no end",
             "P>\nS>\nM>\n<", "line\n" * 400, "\x85 \n", "é\n" * 9, None, ""] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = fill_middle.restore(fill_middle.transform(docs)).collect()
    assert Counter(rebuilt(at, text) for at, text in enumerate(texts)) == Counter(
        (row.doc_id, row.n, row.form, row.prefix_chars, row.middle_chars, row.output) for row in rows)
    assert all(row.restored == (row.text or "") for row in rows)
    assert {row.form for row in rows} == {"plain", "psm", "spm"}


def test_fill_middle_of_no_rows(spark):
    assert fill_middle.restore(fill_middle.transform(table(spark, "documents").limit(0))).count() == 0
