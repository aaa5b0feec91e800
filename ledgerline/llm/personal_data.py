"""Personal data: rules, and a skip-chain conditional random field around them.

The rules find e-mail addresses, IPv4 addresses, card and phone numbers in whole texts. The field labels tokens (runs of
non-blank characters) as one of these or none. Only tokens with a digit or an at sign can be anything but none, so they
are the nodes; neighbours in the text are joined by chain edges, and equal or similar tokens anywhere in a document by
skip edges (each with the one before it of the same form, so their number is linear). Tokens that a rule has found are
fixed. Loopy sum-product messages carry their labels to other mentions, and one label wins for all.

Node weights (a multinomial logistic model of token shapes), chain and skip potentials (smoothed log odds) are learned
from the rules' labels in a bounded sample of documents. Nodes of at least `CERTAIN` probability that touch no rule's span
become spans of their own; what the rules find always stays.

Defined results: NULL texts count as empty; empty texts have no spans. Offsets are code points, end exclusive. A sample
without any finding teaches nothing, and only the rules speak. Rows repeat and tie freely: a result depends on the text
(and the model) alone. Very long texts are read whole. An empty table gives an empty one. Columns of any name pass through.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import sampled, whole_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
LEARNED = {kind: f"crf_{kind}" for kind in KINDS}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The rules' patterns; the e-mail rule's local part is found leftwards from its at sign.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_ACTIVE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_SIGN = re.compile(r"[0-9@]")

SAMPLE_DOCUMENTS, SAMPLE_TOKENS = 20_000, 20_000
CERTAIN = 0.9
ROUNDS, DAMPING = 12, 0.3

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str):
    reach, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > reach and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            reach = domain.end()
        at = text.find("@", max(at + 1, reach))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def by_rules(text: str) -> list[Span]:
    """(start, end, kind) of what the rules find, by kind as listed and then start."""
    found: list[Span] = []
    if "@" in text:
        found += [(start, end, "email") for start, end in _emails(text)]
    if not _SIGN.search(text):
        return found
    found += [(*m.span(), "ip") for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 16:
            digits = _NOT_DIGIT.sub("", match[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((*match.span(), "card"))
    if "+" in text:
        found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return found


class Token(NamedTuple):
    start: int
    end: int
    text: str
    joined: bool  # only blanks between it and the token before
    cue: str  # the last word before it, lower-cased letters only


def tokens(text: str) -> list[Token]:
    out, reach = [], -1
    for match in _ACTIVE.finditer(text):
        between = text[reach:match.start()] if reach >= 0 else "x"
        before = text[max(0, match.start() - 24):match.start()].split()
        cue = "".join(c for c in before[-1].lower() if c.isalpha()) if before else ""
        out.append(Token(match.start(), match.end(), match[0], not between.strip(), cue))
        reach = match.end()
    return out


_CUES = {
    **dict.fromkeys(("mail", "email", "e", "contact", "correo", "courriel"), 1),
    **dict.fromkeys(("ip", "address", "host", "server", "adresse"), 2),
    **dict.fromkeys(("card", "visa", "carte", "karte", "tarjeta", "mastercard"), 3),
    **dict.fromkeys(("phone", "tel", "call", "telephone", "telefon", "mobile", "fax"), 4),
}
_WIDTH = 26


def features(token: Token, before: Token | None, after: Token | None) -> np.ndarray:
    """What a token looks like, and the lengths of the digit runs that stand next to it."""
    out = np.zeros(_WIDTH)
    body = token.text.strip(".,;:!?\"'()[]{}<>#$%&*")
    digits = _NOT_DIGIT.sub("", body)
    parts = body.split(".")
    out[0] = 1
    out[1] = "@" in body
    out[2] = "@" in body and "." in body.rpartition("@")[2]
    out[3] = len(parts) == 4 and all(part.isdigit() for part in parts)
    out[4] = out[3] and all(_small(part) for part in parts if part.isdigit())
    out[5] = token.text.startswith("+")
    out[6] = "(" in token.text or ")" in token.text
    out[7] = "-" in body
    out[8] = any(c.isalpha() for c in body)
    out[9 + min(len(digits), 8) // 2] = 1  # five bins of up to nine digits
    out[14] = 10 <= len(digits) <= 15
    out[15] = 16 <= len(digits) <= 19
    out[16] = out[15] and luhn(digits)
    out[17 + _CUES.get(token.cue, 0)] = 1  # five places
    out[22] = token.joined
    out[23] = token.joined and before is not None and before.text.startswith("+")
    out[24] = after is not None and after.joined
    out[25] = token.joined and before is not None and "(" in before.text
    return out


def forms(token: Token) -> tuple[str, ...]:
    """What makes tokens the same (first) or similar (others), as far as it is long enough to mean something."""
    body = token.text.strip(".,;:!?\"'()[]{}<>#$%&*").lower()
    digits = _NOT_DIGIT.sub("", body)
    out = [f"={body}"] if len(body) >= 6 else [""]
    if len(digits) >= 7 and "@" not in body and body.count(".") != 3:
        out.append(f"#{digits[-7:]}")
    if "@" in body:
        out.append(f"@{body.partition('@')[0]}" if len(body.partition("@")[0]) >= 4 else "")
    return tuple(out)


class Model(NamedTuple):
    weights: np.ndarray  # labels, features
    chain: np.ndarray  # labels, labels
    same: np.ndarray
    similar: np.ndarray


class Graph(NamedTuple):
    nodes: list[Token]
    owner: list[int]  # text of each node
    fixed: np.ndarray  # label of a rule's token, or -1
    shapes: np.ndarray
    edges: np.ndarray  # (from, to, kind): 0 chain, 1 same, 2 similar


def graph(texts: list[str], found: list[list[Span]]) -> Graph:
    nodes, owner, fixed, shapes, edges = [], [], [], [], []
    for number, (text, spans) in enumerate(zip(texts, found)):
        if not _SIGN.search(text):
            continue
        own = tokens(text)
        ordered = sorted(spans)
        at, last = 0, {}
        for place, token in enumerate(own):
            node = len(nodes)
            while at < len(ordered) and ordered[at][1] <= token.start:
                at += 1
            hit = next((kind for start, end, kind in ordered[at:at + 4] if start < token.end and token.start < end), None)
            nodes.append(token)
            owner.append(number)
            fixed.append(LABELS.index(hit) if hit else -1)
            shapes.append(features(token, own[place - 1] if place else None, own[place + 1] if place + 1 < len(own) else None))
            if token.joined and place:
                edges.append((node - 1, node, 0))
            for kind, form in enumerate(forms(token)):
                if form:
                    if form in last:
                        edges.append((last[form], node, min(kind, 1) + 1))
                    last[form] = node
    return Graph(nodes, owner, np.array(fixed, dtype=int), np.array(shapes).reshape(len(nodes), _WIDTH),
                 np.array(edges, dtype=int).reshape(len(edges), 3))


def beliefs(scores: np.ndarray, edges: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Label probabilities of all nodes by loopy sum-product messages. `scores` are log potentials of the nodes,
    `tables` those of the three kinds of edges."""
    def normal(logs):
        logs = logs - logs.max(axis=1, keepdims=True)
        return logs - np.log(np.exp(logs).sum(axis=1, keepdims=True))

    if not len(edges):
        return np.exp(normal(scores))
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    table = np.concatenate([tables[edges[:, 2]], tables[edges[:, 2]].transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    messages = np.zeros((len(source), scores.shape[1]))
    total = scores.copy()
    for _ in range(ROUNDS):
        without = total[source] - messages[back]
        held = without[:, :, None] + table
        top = held.max(axis=1, keepdims=True)
        sent = normal((top + np.log(np.exp(held - top).sum(axis=1, keepdims=True)))[:, 0, :])
        messages = DAMPING * messages + (1 - DAMPING) * sent
        total = scores.copy()
        np.add.at(total, target, messages)
    return np.exp(normal(total))


def find(texts: list[str], model: Model | None) -> list[list[Span]]:
    """All spans of each text by kind and start: the rules', and the field's, whose kinds are in `LEARNED`."""
    found = [by_rules(text) for text in texts]
    if model is None:
        return found
    field = graph(texts, found)
    if not len(field.nodes):
        return found
    scores = field.shapes @ model.weights.T
    known = field.fixed >= 0
    scores[known] = -50.0
    scores[known, field.fixed[known]] = 0.0
    chances = beliefs(scores, field.edges, np.stack([model.chain, model.same, model.similar]))
    label = chances.argmax(axis=1)
    chosen = np.flatnonzero(~known & (label > 0) & (chances.max(axis=1) >= CERTAIN))
    added: list[list[Span]] = [[] for _ in texts]
    last = None
    for node in chosen.tolist():
        token, text = field.nodes[node], field.owner[node]
        start, end = token.start, token.end
        while start < end and token.text[start - token.start] in ".,;:!?\"'([{<#$%&*":
            start += 1
        while end > start and token.text[end - token.start - 1] in ".,;:!?\"')]}>#$%&*":
            end -= 1
        kind = LEARNED[LABELS[label[node]]]
        if last == (node - 1, kind) and token.joined and added[text]:
            added[text][-1] = (added[text][-1][0], end, kind)
        else:
            added[text].append((start, end, kind))
        last = (node, kind)
    order = [*KINDS, *LEARNED.values()]
    return [sorted(rules + more, key=lambda span: (order.index(span[2]), span[0])) for rules, more in zip(found, added)]


def learn(shapes: np.ndarray, labels: np.ndarray, pairs: np.ndarray) -> Model | None:
    """The model of labelled tokens; `pairs` counts edges by (kind, label, label)."""
    if not (labels > 0).any():
        return None
    count = len(LABELS)
    wanted = np.eye(count)[labels]
    weights = np.zeros((count, _WIDTH))
    share = 1.0 / np.maximum(np.bincount(labels, minlength=count), 1)
    rows = (share[labels] / share[labels].sum())[:, None] * 0.5 + 0.5 / len(labels)
    for _ in range(400):  # plain gradient steps on a convex loss, a small ridge
        logits = shapes @ weights.T
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        weights -= 1.0 * (((p - wanted) * rows).T @ shapes + 1e-4 * weights)
    tables = []
    for kind in range(3):
        smooth = pairs[kind] + pairs[kind].T if kind else pairs[kind]
        smooth = smooth + 0.5 + np.eye(count) * (2.0 if kind else 0.5)  # before any evidence, equal labels are likelier
        joint = smooth / smooth.sum()
        tables.append(np.clip(np.log(joint / (joint.sum(axis=1, keepdims=True) * joint.sum(axis=0, keepdims=True))), -4, 4))
    return Model(weights, *tables)


def fit(docs: DataFrame, *, text: str = "text", documents: int = SAMPLE_DOCUMENTS, tokens_: int = SAMPLE_TOKENS) -> Model | None:
    """The model of the rules' labels in a bounded sample: documents of the smallest hashes, at most so many tokens."""
    chosen = sampled(docs.select("doc_id"), documents, "doc_id").distinct()
    rows = docs.select("doc_id", whole_text(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    count = len(LABELS)

    def labelled(batches):
        for frame in batches:
            texts = frame["text"].tolist()
            field = graph(texts, [by_rules(body) for body in texts])
            labels = np.maximum(field.fixed, 0)
            out = [(int(label), shape.tolist(), -1, 1) for label, shape in zip(labels, field.shapes)]
            pairs = np.zeros((3, count, count), dtype=int)
            np.add.at(pairs, (field.edges[:, 2], labels[field.edges[:, 0]], labels[field.edges[:, 1]]), 1)
            out += [(-1, [], at, int(value)) for at, value in enumerate(pairs.ravel()) if value]
            yield pd.DataFrame(out, columns=["label", "shape", "pair", "number"])

    table = rows.mapInPandas(labelled, "label int, shape array<double>, pair int, number long")
    shaped = table.groupBy("label", "shape", "pair").agg(F.sum("number").alias("number"))  # equal shapes together
    sample = shaped.orderBy(F.col("pair").desc(), F.col("label").desc(), F.col("number").desc(), "shape").limit(tokens_).toPandas()
    pairs = np.zeros(3 * count * count)
    edges = sample[sample["pair"] >= 0]
    pairs[edges["pair"].to_numpy(dtype=int)] = edges["number"].to_numpy(dtype=float)
    nodes = sample[sample["pair"] < 0]
    if nodes.empty:
        return None
    weight = np.minimum(nodes["number"].to_numpy(dtype=int), 50)
    shapes = np.repeat(np.array(nodes["shape"].tolist()), weight, axis=0)
    return learn(shapes, np.repeat(nodes["label"].to_numpy(dtype=int), weight), pairs.reshape(3, count, count))


def scan(docs: DataFrame, model: Model | None, *, text: str = "text", name: str = "found") -> DataFrame:
    """`docs` with an array of (start, end, kind) for what each whole text holds."""
    @F.pandas_udf("array<struct<start:int,end:int,kind:string>>")
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "kind": kind} for a, b, kind in one] for one in find(texts.tolist(), model)])

    return docs.withColumn(name, spans(whole_text(text)))
