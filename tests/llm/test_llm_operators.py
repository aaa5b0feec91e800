"""The ten operators against brute force, on the supplied documents and on odd ones, and on empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import (
    decontamination, hash_search, id_files, near_join, packing, personal_data, quality, secret_scan, token_lengths, url_trust,
)
from ledgerline.llm.queries import QUERIES
from ledgerline.llm.spans import digest
from ledgerline.llm.token_ids import encoder, vocabulary
from llm_samples import BENCHMARK, documents, words
from test_llm_texts import colliding
from tests.conftest import SMALL


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


@pytest.fixture(scope="module", params=["supplied", "odd"])
def docs(request, spark):
    return (table(spark, "documents") if request.param == "supplied" else documents(spark)).cache()


def pairs(docs):
    return [(row.doc_id, row.text or "") for row in docs.collect()]


def library_ids(name, text, end):
    return [*encoder(vocabulary(name)).library.encode(text, add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_packing(docs):
    rows = packing.pack(packing.pieces_of(docs, vocabulary("byte_bpe_50k.json")).withColumn("crc", F.crc32("ids"))).collect()
    wanted = Counter()
    for doc_id, text in pairs(docs):
        ids = library_ids("byte_bpe_50k.json", text, 0)
        edges = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        wanted.update((doc_id, at, a, b - a, crc(ids[a:b])) for at, (a, b) in enumerate(zip(edges, edges[1:])))
    assert wanted == Counter((row.doc_id, row.piece, row.start, row.length, row.crc) for row in rows)
    held = defaultdict(list)
    for row in rows:
        held[row.sequence_id].append((row.offset, row.length))
    for places in held.values():
        ends = np.cumsum([length for _, length in sorted(places)])
        assert [at for at, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(held) <= -(-sum(row.length for row in rows) // 2048) + 2


def test_packing_evolves_and_repacks_across_blocks(spark):
    chance = random.Random(3)
    pieces = spark.createDataFrame([(chance.choice((700, 1024, 300, 1500, 90, 2048)),) for _ in range(900)], "length long").repartition(4)
    rows = packing.pack(pieces, block=100)
    rest = np.array([row["length"] for row in pieces.collect() if row["length"] < 2048])
    single = packing.fresh(rest, 0.0, None, 2048).max() + 1 + 900 - len(rest)  # best fit of all pieces in one task
    fill = rows.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("k"))
    assert rows.count() == 900 and fill.where("n > 2048").count() == 0
    assert fill.count() <= single + 2


def test_crossover_keeps_every_piece():
    chance = np.random.default_rng(1)
    lengths = chance.integers(1, 2048, 300).astype(np.int32)
    one, other = (packing.fresh(lengths, share, chance, 2048) for share in (0.0, 0.3))
    child = packing.crossover(one, other, lengths, chance, 2048)
    assert (child >= 0).all() and np.bincount(child, weights=lengths).max() <= 2048
    assert packing.fitness(packing.evolve(lengths, [one], [1, 1, 1], 2048)[0], lengths, 2048) >= packing.fitness(one, lengths, 2048)


def tiles(item, document):
    """Greedy string tiling by trying everything."""
    marked, used, covered = [False] * len(item), [False] * len(document), 0
    while True:
        best = (4, 0, 0)
        for i in range(len(item)):
            for j in range(len(document)):
                k = 0
                while (i + k < len(item) and j + k < len(document) and item[i + k] == document[j + k]
                       and not marked[i + k] and not used[j + k]):
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        if best[0] < 5:
            return covered
        for k in range(best[0]):
            marked[best[1] + k] = used[best[2] + k] = True
        covered += best[0]


def plain_words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def test_decontamination(spark):
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    docs = documents(spark)
    found = decontamination.contaminated(docs, benchmark, coverage=0.2)
    wanted = Counter()
    for doc_id, text in pairs(docs):
        document = plain_words(text)
        for item_id, item in set(BENCHMARK):
            words = plain_words(item)
            if 5 <= len(words) and len(document) < 5_000 and (share := tiles(words, document) / len(words)) >= 0.2:
                wanted[doc_id, item_id, round(share, 9)] += 1
    assert wanted == Counter((row.doc_id, row.item_id, round(row.coverage, 9)) for row in found.collect())
    assert (11, 0, 1.0) in wanted and (12, 0, 0.225) in wanted
    kept = decontamination.clean(docs, benchmark)
    assert kept.columns == docs.columns and Counter(pairs(kept)) == Counter(p for p in pairs(docs) if p[0] != 11)


def test_tiles_of_repeats():
    chance = np.random.default_rng(2)
    for _ in range(40):
        item, document = (chance.integers(1, 4, size).astype(np.uint64) for size in (18, 40))
        found = decontamination.tile(item, document)
        assert all((item[a:a + n] == document[b:b + n]).all() for a, b, n in found)
        places = [place for a, _, n in found for place in range(a, a + n)]
        assert len(places) == len(set(places)) and sum(n for *_, n in found) >= 0.6 * tiles(item.tolist(), document.tolist())


def test_colliding_words_are_no_leak_and_no_copy(spark):
    """Words that share a polynomial hash are different words."""
    one, other = colliding(1_024)
    item = " ".join([one, "alpha", one, "beta", one, "gamma", one, "delta"])
    assert decontamination.contaminated(
        spark.createDataFrame([(1, item.replace(one, other)), (2, item)], "doc_id long, text string"),
        spark.createDataFrame([(7, item)], "item_id long, text string")).select("doc_id").collect() == [(2,)]
    rest = " ".join(words(30, 40))
    docs = spark.createDataFrame([(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, one), (4, other), (5, one)], "doc_id long, text string")
    found = {row.doc_id: (row.class_id, row.n_links) for row in near_join.near_classes(docs, threshold=0.99).collect()}
    assert found == {1: (1, 0), 2: (2, 0), 3: (3, 1), 4: (4, 0), 5: (3, 1)}


def shingles(text):
    words = plain_words(text)
    return {tuple(words[at:at + 5]) for at in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("block", [256, 2])
def test_near_join(docs, monkeypatch, block):
    monkeypatch.setattr(near_join, "BLOCK", block)
    rows = [(doc_id, text, shingles(text)) for doc_id, text in pairs(docs)]
    root, links = list(range(len(rows))), Counter()

    def find(at):
        while root[at] != at:
            at = root[at]
        return at

    for a in range(len(rows)):
        for b in range(a):
            one, other = rows[a][2], rows[b][2]
            if one and len(one & other) >= 0.8 * len(one | other):
                links.update((a, b))
                root[find(a)] = find(b)
    classes = defaultdict(list)
    for at in range(len(rows)):
        classes[find(at)].append(rows[at][0])
    least = {at: min((one for one in ids if one is not None), default=None) for at, ids in classes.items()}
    wanted = Counter((rows[at][0], least[find(at)], links[at]) for at in range(len(rows)))
    assert wanted == Counter((row.doc_id, row.class_id, row.n_links) for row in near_join.near_classes(docs).collect())
    kept = near_join.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(classes)


def test_near_join_counts_large_groups_without_pairs(spark):
    """A few hundred near copies over several blocks, and a copied text."""
    body = [f"word{at}" for at in range(200)]
    texts = [" ".join([*body[:at % 150], f"new{at}", *body[at % 150 + 1:]]) for at in range(300)] + ["same text here over and over"] * 200
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = {row.doc_id: (row.class_id, row.n_links) for row in near_join.near_classes(docs).collect()}
    assert all(found[at] == (0, 299) for at in range(300)) and all(found[at] == (300, 199) for at in range(300, 500))


def test_recall_is_kept_by_shortening():
    assert near_join.chance(0.8, near_join.DEPTH) < near_join.RECALL <= near_join.chance(0.8, near_join.DEPTH - 1)


def test_no_isolated_pair_at_the_threshold_is_lost(spark):
    """Pairs at 0.8 exactly, beside a text with very many near copies of higher similarity."""
    rows, chance = [], random.Random(8)
    for pair in range(2_000):
        body = [f"w{chance.getrandbits(40)}" for _ in range(49)]  # 45 shingles; 5 of them change with the last word but four
        rows += [(2 * pair, " ".join(body)), (2 * pair + 1, " ".join([*body[:-5], "changed", *body[-4:]]))]
    assert {len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for (_, a), (_, b) in zip(rows[::2], rows[1::2])} == {0.8}
    body = [f"word{at}" for at in range(100)]
    rows += [(10_000 + at, " ".join(body if at % 2 else [*body[:-1], "other"])) for at in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {row.doc_id: (row.class_id, row.n_links) for row in near_join.near_classes(docs).collect()}
    assert all(found[at] == (at - at % 2, 1) for at in range(4_000)) and all(found[at] == (10_000, 1_999) for at in range(10_000, 12_000))


def test_quality(spark):
    held = QUERIES["op6_quality"](spark, SMALL)
    rows = held.join(table(spark, "labels"), "doc_id").where("held_out").collect()
    assert held.count() == table(spark, "documents").count()
    assert np.mean([row.predicted == row.quality for row in rows]) > 0.9
    for row in held.collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) and 0 <= row.score <= 1
    docs = documents(spark)
    labels = spark.createDataFrame([(None, 1), (5, None), (5, 7), (77, 1), (5, 1), (9, 0), (9, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    scores = [row.score_ for row in quality.score(docs, model, name="score_").collect()]
    assert len(scores) == docs.count() and all(0 <= score <= 1 for score in scores)
    assert quality.keep_good(docs, labels.where("false")).columns == docs.columns
    assert quality.keep_good(docs, labels.where("false")).count() == docs.count()


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
PRIVATE = {"email": EMAIL, "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
           "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def private(kind, match):
    digits = re.sub(r"[^0-9]", "", match[0])
    if kind == "ip":
        return all(int(part) <= 255 for part in match[0].split("."))
    if kind == "card":
        doubled = [sum(divmod(2 * int(c), 10)) if at % 2 else int(c) for at, c in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def test_personal_data(docs):
    found = personal_data.scan(docs.select("doc_id", "text"), personal_data.fit(docs)).select(
        "doc_id", "text", *digest("found", personal_data.KINDS)).collect()
    for row in found:
        wanted = [f"{kind}:{m.start()}:{m.end()}" for kind, pattern in PRIVATE.items()
                  for m in re.finditer(pattern, row.text or "") if private(kind, m)]
        assert row.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        assert [span for span in row.spans.split(",") if span and not span.startswith("crf_")] == wanted
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s.startswith(kind) for s in wanted) for kind in PRIVATE]


def test_rules_on_random_text():
    chance = random.Random(8)
    for _ in range(300):
        text = "".join(chance.choice("a1.@+-_ 4()") for _ in range(80))
        wanted = [(m.start(), m.end(), kind) for kind, pattern in PRIVATE.items() for m in re.finditer(pattern, text) if private(kind, m)]
        assert personal_data.by_rules(text) == wanted


def test_messages_are_exact_on_trees():
    chance = np.random.default_rng(4)
    scores, tables = chance.normal(size=(4, 3)), chance.normal(size=(3, 3, 3))
    edges = np.array([(0, 1, 0), (1, 2, 1), (1, 3, 2)])
    total = np.zeros((4, 3))
    for labels in np.ndindex(3, 3, 3, 3):
        weight = np.exp(sum(scores[at, label] for at, label in enumerate(labels)) + sum(tables[k, labels[a], labels[b]] for a, b, k in edges))
        total[range(4), labels] += weight
    assert np.allclose(personal_data.beliefs(scores, edges, tables), total / total.sum(axis=1, keepdims=True), atol=1e-4)


def test_distant_mention_takes_the_label_of_its_like(docs):
    model = personal_data.fit(docs)
    text = "call +1 (017) 555-7713 now " + "word " * 40 + "or 555-7713 later"
    spans = personal_data.find([text], model)[0]
    assert spans[0] == (5, 22, "phone")
    assert all(kind in personal_data.LEARNED.values() and text[start:end] == "555-7713" for start, end, kind in spans[1:])


SECRETS = {
    "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 0, 20), "hex": (r"[0-9a-f]+", 0, 0, 24),
}


def test_secrets(docs):
    network = secret_scan.fit(docs)
    found = secret_scan.scan(docs.select("doc_id", "text"), network).select("doc_id", "text", *digest("found", tuple(secret_scan.RULES)))
    for row in found.collect():
        spans = sorted((m.start(), at, f"{kind}:{m.start()}:{m.end()}") for at, (kind, (pattern, flags, group, least)) in
                       enumerate(SECRETS.items()) for m in re.finditer(pattern, row.text or "", flags) if len(m[group]) >= least)
        wanted = [span for *_, span in spans]
        assert row.base_sha256 == hashlib.sha256(",".join(wanted).encode()).hexdigest()
        assert [span for span in row.spans.split(",") if span and not span.startswith("learned")] == wanted
    cleaned = secret_scan.mask(docs, network)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    for row in cleaned.collect():
        assert not secret_scan.by_rules(row.text or "") and (row.text is None or row.n_chars == len(row.text) or row.n_chars)


def test_network_learns_and_reads_whole_runs():
    chance = random.Random(6)
    runs = ["".join(chance.choice("0123456789abcdef") for _ in range(40)) for _ in range(200)]
    runs += ["".join(chance.choice(["tion", "ing", "the", "er"]) for _ in range(12)) for _ in range(200)]
    labels = np.array([1] * 200 + [0] * 200)
    order = np.array(chance.sample(range(400), 400))
    texts = [(f"x {runs[at]} y", (2, 2 + len(runs[at]))) for at in order]
    net = secret_scan.train([secret_scan.windows(*one) for one in texts], [secret_scan.windows(*one, False) for one in texts], labels[order])
    fresh = "q " + "".join(chance.choice("0123456789abcdef") for _ in range(40)) + " " + "thetioning" * 6
    found = secret_scan.find([fresh], net._replace(threshold=net.threshold))[0]
    assert [kind for *_, kind in found] == ["hex"]
    chances = net.chance([secret_scan.windows(*one) for one in texts])
    assert ((chances >= net.threshold) == labels[order]).mean() > 0.97
    assert sum(map(len, secret_scan.windows("a" * 3_000, (0, 3_000)))) >= 3_000
    assert secret_scan.train([], [], np.zeros(0, dtype=int)) is None


@pytest.mark.parametrize("mixed", [0, 30])
def test_threshold_keeps_the_recall(mixed):
    """Also where some findings look like what no rule names, so that the quantile is below one half."""
    chance = random.Random(9)
    plain = ["tion", "ing", "the", "er"]
    runs = ["".join(chance.choice(plain if at < mixed else "0123456789abcdef") for _ in range(12 if at < mixed else 40)) for at in range(200)]
    runs += ["".join(chance.choice(plain) for _ in range(12)) for _ in range(600)]
    labels = np.array([1] * 200 + [0] * 600)
    order = np.array(chance.sample(range(800), 800))
    texts = [(f"x {runs[at]} y", (2, 2 + len(runs[at]))) for at in order]
    labels = labels[order]
    net = secret_scan.train([secret_scan.windows(*one) for one in texts], [secret_scan.windows(*one, False) for one in texts], labels)
    back = (np.arange(800) % 4 == 3) & (labels == 1)
    kept = net.chance([secret_scan.windows(*one) for one in texts])[back] >= net.threshold
    assert kept.mean() >= secret_scan.RECALL
    assert (net.threshold < 0.5) == bool(mixed)


def test_short_secrets_are_candidates(spark):
    """Values of 6 to 15 characters are learned from the rules' own and found beside a word the rules lack."""
    cut = lambda text: [text[start:end] for start, end in secret_scan.candidates(text)]
    assert cut('pwd: "hunter" key= 123456 auth Xy7kQ2p ------ plainword LOUDER 1234567 aB-cde') == ["hunter", "123456", "Xy7kQ2p", "aB-cde"]
    assert cut("abcde x:abcde " + "a" * 16) == ["a" * 16]
    chance = random.Random(10)
    value = lambda: "".join(chance.choice("abcdefghijkmnpqrstuvwxyz23456789QRSTUVWXYZ") for _ in range(10))
    rows = [(at, f"some text password: {value()} and Capital Letters note: nothing api_key = {value()} Another") for at in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network = secret_scan.fit(docs)
    hidden = [value() for _ in range(50)]
    found = [[kind for *_, kind in spans] for spans in secret_scan.find([f"some text pwd: {one} and Capital" for one in hidden], network)]
    assert sum(kinds == ["learned"] for kinds in found) >= 45
    assert not any(kind == "learned" for _, _, kind in secret_scan.find(["note: nothing and Capital Letters Another"], network)[0])


def test_the_network_learns_from_all_documents(spark):
    """The only findings are in the documents of the largest hashes, of more documents than any bound was."""
    ids = spark.range(0, 24_000, 1, 4).withColumnRenamed("id", "doc_id")
    last = [row.doc_id for row in ids.orderBy(F.desc(F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 40)))).limit(40).collect()]
    value = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 10)
    docs = ids.withColumn("text", F.when(F.col("doc_id").isin(last), F.concat(F.lit("password: "), value)).otherwise(
        F.concat(F.lit("Capital Letters Another"), F.col("doc_id") % 50)))
    assert secret_scan.fit(docs) is not None


def test_shards_learn_together(spark, monkeypatch):
    """Several shards whose networks are averaged in two steps; documents that repeat teach once."""
    monkeypatch.setattr(secret_scan, "SHARD_ROWS", 100)
    monkeypatch.setattr(secret_scan, "MERGED", 2)
    chance = random.Random(10)
    value = lambda: "".join(chance.choice("abcdefghijkmnpqrstuvwxyz23456789QRSTUVWXYZ") for _ in range(10))
    rows = [(at, f"some text password: {value()} and Capital{at} Letters note: nothing{at} api_key = {value()} Another") for at in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    network = secret_scan.fit(docs)
    again = secret_scan.fit(docs.unionAll(docs).repartition(3))
    assert all(np.array_equal(one, other) for one, other in zip(network[:4], again[:4]))
    texts = [f"some text pwd: {value()} and Capital" for _ in range(50)]
    assert sum([kind for *_, kind in spans] == ["learned"] for spans in secret_scan.find(texts, network)) >= 45


def test_the_curve_of_all_rows_is_that_of_the_driver(spark):
    chance = np.random.default_rng(3)
    x = chance.normal(0, 3, 500)
    labels = (x + chance.normal(0, 2, 500) > 1).astype(int)
    rows = spark.createDataFrame(list(zip(x.tolist(), labels.tolist())), "x double, label int")
    assert np.allclose(quality.logistic_over(rows, "x", "label"), quality.logistic(x, labels), atol=1e-6)


def test_token_lengths(docs):
    held = token_lengths.histogram(docs).cache()
    lengths = [len(library_ids("byte_bpe_50k.json", text, 0)) - 1 for _, text in pairs(docs)]
    assert {row.n_tokens: row.n_docs for row in held.collect()} == Counter(lengths)
    for row in held.collect():
        assert row.docs_at_least == sum(n >= row.n_tokens for n in lengths) and row.docs_at_most == sum(n <= row.n_tokens for n in lengths)
        assert row.tokens_at_least == sum(n for n in lengths if n >= row.n_tokens)
        assert row.truncated_total == sum(min(n, row.n_tokens) for n in lengths)
    assert token_lengths.total(held) == sum(lengths)
    assert all(token_lengths.truncated_total(held, limit) == sum(min(n, limit) for n in lengths) for limit in (0, 5, 333, 10**9))
    assert token_lengths.quantile(held, 0.5) == sorted(lengths)[-(-len(lengths) // 2) - 1]


def test_id_files(spark, docs, folder):
    id_files.write(docs, f"{folder}/ids", vocabulary("word_bpe_49k.json"))
    rows = sorted(id_files.documents(spark, f"{folder}/ids").collect(), key=lambda row: row.start)
    ids = [row.doc_id for row in rows]
    assert ids == sorted(ids, key=lambda one: (one is not None, one))
    assert [row.start for row in rows] == [0, *np.cumsum([row.n_tokens for row in rows])[:-1]]
    coded = [(doc_id, library_ids("word_bpe_49k.json", text, 2)) for doc_id, text in pairs(docs)]
    assert Counter((row.doc_id, row.n_tokens, row.ids_crc32) for row in rows) == Counter((a, len(b), crc(b)) for a, b in coded)


def test_damaged_blocks_are_noticed(spark, folder):
    id_files.write(documents(spark), f"{folder}/ids", vocabulary("word_bpe_49k.json"))
    bad = spark.read.parquet(f"{folder}/ids").withColumn("crc32", F.col("crc32") + 1)
    bad.write.parquet(f"{folder}/bad")
    with pytest.raises(Exception, match="checksum"):
        id_files.read_parts(spark, f"{folder}/bad").collect()


def test_search(spark):
    vectors = [(row.vec_id, row.embedding) for row in table(spark, "embeddings").collect()]
    chance = np.random.default_rng(9)
    odd = [(10_000, None), (10_020, [0.0] * 64), (10_040, [float("nan")] * 64), (10_060, [1.0, 2.0]), (None, vectors[0][1]),
           (10_080, vectors[0][1]), (10_081, vectors[0][1]), (10_081, vectors[0][1]), (10_100, [None] * 64),
           (10_120, [float(x) for x in 3 * chance.standard_normal(64)])]
    frame = spark.createDataFrame([*vectors, *odd], "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    found = defaultdict(list)
    for row in hash_search.search(frame).orderBy("query_id", "rank").collect():
        found[row.query_id].append((row["rank"], row.vec_id, row.score))
    fine = {(key, tuple(np.float32(v).astype(float))) for key, v in [*vectors, odd[5], odd[6], odd[9]]}
    ids, held = np.array([key for key, _ in fine]), np.array([v for _, v in fine])
    hits = total = 0
    assert set(found) == {key for key in ids if key % 20 == 0}
    for key, question in fine:
        if key % 20 == 0:
            scores = np.where(ids == key, -np.inf, held @ np.array(question))
            top = ids[np.lexsort((ids, -scores))][:20]
            assert [rank for rank, *_ in found[key]] == list(range(1, 21))
            hits, total = hits + len({one for _, one, _ in found[key]} & set(top.tolist())), total + 20
            for _, other, score in found[key]:
                assert any(abs(score - v) < 1e-9 for v in scores[ids == other])
    assert hits / total >= 0.9


def test_probing_finds_every_code_within_the_radius():
    chance = np.random.default_rng(12)
    codes = chance.integers(0, 256, (3_000, 8)).astype(np.uint8)
    shard = hash_search.Shard.of(np.arange(3_000), np.zeros((3_000, 1)), codes)
    for radius in (0, 7, 20, 26, 64):
        code = codes[radius]
        apart = np.unpackbits(codes ^ code, axis=1).sum(axis=1)
        assert shard.probe(code, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def test_few_vectors_find_all(spark):
    frame = spark.createDataFrame([(at, [float(at), 1.0]) for at in range(5)], "vec_id long, embedding array<double>")
    assert [(row["rank"], row.vec_id) for row in hash_search.search(frame).orderBy("rank").collect()] == [(1, 1), (2, 2), (3, 3), (4, 4)]


def pages_of(spark):
    link = '<a href="{}">x</a>'
    rows = [
        (1, "http://A.Example.NET/en/x?q#f", link.format("https://bad.example.com/de/1")), (2, "https://bad.example.com/de/1", "<p>"),
        (3, "https://bad.example.com/de/2", None), (4, "https://near.example.com/x", link.format("//bad.example.com/") * 3),
        (5, "https://x.org/fr/1", link.format("HTTP://good.info/")), (6, "http://good.info/z", link.format("/local")),
        (7, None, "<a>"), (8, "no scheme", ""), (9, "http://net", ""), (10, "ftp://net/?x", ""), (10, "ftp://net/?x", ""),
        (11, "http://far.info/", link.format("http://near.example.com/")), (None, "http://bad.example.com/en/", ""),
        (12, "a://b://c/d", ""),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("z"), "path": F.lit("y")})


def judged(pages):
    """The filter in plain Python, with dense vectors."""
    rows, links = [], Counter()
    for page_id, url, html in pages:
        rest = (url or "").partition("://")[2]
        cut = lambda text, marks: re.split(f"[{marks}]", text, maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in cut(rest, "/?#"))
        path = cut(rest[len(host):], "?#")
        fits = [rule for rule in url_trust.RULES if (host == rule.host or host.endswith(f".{rule.host}")) and path.startswith(rule.path)]
        rule = max(fits, key=lambda one: len(one.name), default=None)
        rows.append((page_id, host, path, rule))
        for target in re.findall(r"(?i)href\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)", html or ""):
            if host and target.lower() != host:
                links[host, target.lower()] += 1
    hosts = sorted({host for _, host, *_ in rows if host})
    for host in hosts:
        parent = host.partition(".")[2]
        if parent in hosts:
            links[host, parent] += 1
            links[parent, host] += 1
    weights = np.array([[links[a, b] for b in hosts] for a in hosts], dtype=float)
    ranks = {}
    for verdict, matrix in (("allow", weights), ("block", weights.T)):
        seed = np.array([2 * sum(r is not None and r.verdict == verdict for _, h, _, r in rows if h == host) >
                         sum(h == host for _, h, *_ in rows) for host in hosts], dtype=float)
        share = matrix / np.maximum(matrix.sum(axis=1, keepdims=True), 1e-12)
        value = seed
        for _ in range(url_trust.ROUNDS):
            value = (1 - url_trust.DAMPING) * seed + url_trust.DAMPING * value @ share
        ranks[verdict] = value
    bad = {host for host, good, ill in zip(hosts, ranks["allow"], ranks["block"]) if ill >= url_trust.THRESHOLD and ill > good}
    return Counter((page_id, host, path, rule and rule.name, rule.verdict if rule else "block" if host in bad else "allow")
                   for page_id, host, path, rule in rows)


@pytest.mark.parametrize("source", ["supplied", "odd"])
def test_urls(spark, source):
    pages = table(spark, "pages") if source == "supplied" else pages_of(spark)
    plain = [(row.page_id, row.url, row.html) for row in pages.collect()]
    found = url_trust.judge(pages)
    assert judged(plain) == Counter(map(tuple, found.collect()))
    if source == "odd":
        verdicts = {row.page_id: row.verdict for row in found.collect()}
        assert verdicts[4] == verdicts[11] == verdicts[None] == "block" and verdicts[6] == verdicts[7] == "allow"
        plan = found._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan


def dense_trust(seeds, edges):
    """The solved equations of trust over weighted edges between named hosts."""
    hosts = sorted({*seeds, *(host for edge in edges for host in edge)})
    matrix = np.array([[edges.get((a, b), 0) for b in hosts] for a in hosts], dtype=float)
    share = matrix / np.maximum(matrix.sum(axis=1, keepdims=True), 1e-12)
    start = (1 - url_trust.DAMPING) * np.array([host in seeds for host in hosts], dtype=float)
    return dict(zip(hosts, np.linalg.solve(np.eye(len(hosts)) - url_trust.DAMPING * share.T, start)))


def reversed_edges(edges):
    return {(b, a): weight for (a, b), weight in edges.items()}


def linking_pages(spark, links):
    """A page for each source, on a path no rule fits, with links to the targets."""
    rows = [(number, f"http://{source}/x", "".join(f'<a href="http://{target}/">x</a>' for target in targets))
            for number, (source, targets) in enumerate(links.items())]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_hosts_without_pages_carry_trust(spark):
    """Distrust comes from a linked host without pages, through another one, and shares count links to such hosts."""
    links = {"a.info": ["spam.net"], "b.info": ["a.info"], "c.info": ["hub.biz"], "sub.hub.biz": ["spam.net"],
             "d.info": ["ok.xyz"], "e.info": ["good.site", *[f"u{at}.biz" for at in range(9)]], "good.site": []}
    pages = linking_pages(spark, links)
    rules = (*url_trust.RULES, url_trust.Rule("allow", "ok.xyz", "/"), url_trust.Rule("allow", "e.info", "/"))
    edges = Counter((source, target) for source, targets in links.items() for target in targets)
    edges["sub.hub.biz", "hub.biz"] = edges["hub.biz", "sub.hub.biz"] = 1
    found = {row.host: row for row in url_trust.trust(pages, url_trust.judged_by_rules(pages, rules), rules).collect()}
    good, bad = dense_trust({"ok.xyz", "e.info"}, edges), dense_trust({"spam.net"}, reversed_edges(edges))
    assert found.keys() == good.keys()
    for host, row in found.items():
        assert abs(row.trust - good[host]) < 0.2 * url_trust.THRESHOLD and abs(row.distrust - bad[host]) < 0.2 * url_trust.THRESHOLD
    verdicts = {row.host: row.verdict for row in url_trust.judge(pages, rules).collect()}
    assert verdicts.keys() == links.keys() and verdicts["good.site"] == verdicts["d.info"] == "allow"
    assert verdicts["a.info"] == verdicts["b.info"] == verdicts["sub.hub.biz"] == "block"


@pytest.mark.parametrize("part", [10_000, 2])
def test_trust_is_converged(spark, monkeypatch, part):
    """A chain towards a blocked seed, and a parent domain with eight children, one of them a blocked seed."""
    monkeypatch.setattr(url_trust, "PART", part)
    links = {f"h{at}.info": [f"h{at - 1}.info"] for at in range(1, 13)} | {"h0.info": []}
    links |= {f"s{at}.big.org": [] for at in range(8)} | {"big.org": []}
    pages = linking_pages(spark, links)
    rules = (url_trust.Rule("block", "h0.info", "/"), url_trust.Rule("block", "s0.big.org", "/"))
    edges = {(source, target): 1 for source, targets in links.items() for target in targets}
    edges |= {edge: 1 for at in range(8) for edge in ((f"s{at}.big.org", "big.org"), ("big.org", f"s{at}.big.org"))}
    wanted = dense_trust({"h0.info", "s0.big.org"}, reversed_edges(edges))
    found = {row.host: row for row in url_trust.trust(pages, url_trust.judged_by_rules(pages, rules), rules).collect()}
    assert found.keys() == wanted.keys()
    assert all(abs(row.distrust - wanted[host]) <= url_trust.TOLERANCE and row.trust == 0 for host, row in found.items())
    blocked = {row.host for row in url_trust.judge(pages, rules).collect() if row.verdict == "block"}
    assert blocked == {host for host, value in wanted.items() if value >= url_trust.THRESHOLD}
    assert "h10.info" not in blocked and "s1.big.org" not in blocked


def test_empty_tables(spark, folder):
    docs = documents(spark).where("false")
    path = vocabulary("byte_bpe_50k.json")
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    assert packing.pack_documents(docs).count() == 0
    assert decontamination.contaminated(docs, benchmark).count() == 0
    assert decontamination.clean(documents(spark), benchmark.where("false")).count() == documents(spark).count()
    assert personal_data.fit(docs) is None and personal_data.scan(docs, None, name="spans").count() == 0
    assert near_join.near_classes(docs).count() == near_join.one_of_each(docs).count() == 0
    assert url_trust.judge(pages_of(spark).where("false")).count() == 0
    assert quality.keep_good(docs, table(spark, "labels")).count() == 0
    assert hash_search.search(table(spark, "embeddings").where("false")).count() == 0
    assert secret_scan.mask(docs).count() == 0
    held = token_lengths.histogram(docs)
    assert held.count() == 0 and token_lengths.total(held) == 0 and token_lengths.quantile(held, 0.5) is None
    id_files.write(docs, f"{folder}/ids", path)
    assert id_files.documents(spark, f"{folder}/ids").count() == 0
