"""Secret scans: rules, and a character convolutional network over every candidate in its context.

The rules (`assign`, `access`, `hex`) are regular expressions over whole texts. Candidates for the network are all runs
of at least `LONG` characters that secrets are written in, and those of `LEAST` (as in `assign`) or more that mix lower
case, upper case, digits and signs or follow a colon or an equals sign; plain short words elsewhere are none. It reads the candidate and `CONTEXT` characters on either
side (as character classes, marked as inside or around), convolves, pools over the whole run, and gives a chance that is
calibrated on held-back findings. It is trained on the candidates of all documents, equal ones (with their context) once: a
quarter is held back, the others are dealt over cells, ROUNDS of them for each shard. A task learns the rows of one cell, all
of them, and the networks of a round's shards are averaged before the next round starts from them. Rows of the rarer kind are
put into several cells, so that every batch has at least RARE of them, which weigh as much as all others in it. Short and long runs weigh as STRATUM rows at most; the label
goes by the value a rule names, not the word before it, and the context is blanked for half of the rows so that the network
learns the run itself. Calibration and threshold come from all that is held back. The threshold is the highest that keeps
`RECALL` of the held-back findings that the rules name. Candidates at or above it that touch no rule's finding are
reported as `learned`; what the rules find always stays.

Defined results: NULL texts count as empty; empty texts have no spans. Offsets are code points, end exclusive. Without
findings of both kinds, learned from and held back, nothing is learned and only the rules speak. Rows repeat and tie freely: a result
depends on the text alone (and the model). Very long texts are read whole. An empty table gives an empty one. Columns of any
name pass through.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import free_name, materialise, whole_text
from ledgerline.llm.quality import logistic, logistic_over
from ledgerline.operators.quantiles import values_at

# The three rules, in the order in which findings that start together are listed.
RULES = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
KINDS = (*RULES, "learned")
_KEYWORDS = ("passw", "secret", "token", "api")

LEAST, LONG = 6, 16
CONTEXT = 24
WINDOW = 256  # characters convolved at once; longer candidates are read in overlapping windows, none is cut
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)
_ASSIGNED = re.compile(r"""[:=]["'\x20]*(?=%s)""" % RUN.pattern)
STRATUM = 1_500
RECALL = 0.99
FILTERS, WIDTH, STEPS, BATCH = 24, 5, 400, 64
RARE = 8  # rows of the rarer kind in a batch
ROUNDS = 4
SHARD_ROWS = STEPS * BATCH  # rows of the commoner kind in the cells of a shard, at least, where there are several
MERGED = 64  # networks averaged in one task
_ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-.:\"' \n"
_BLANK = len(_ALPHABET) + 1
_SYMBOLS = _BLANK + 1  # blank, and 0 for what the alphabet lacks
_CODES = np.zeros(128, dtype=np.int64)
for _at, _letter in enumerate(_ALPHABET, start=1):
    _CODES[ord(_letter)] = _at

Span = tuple[int, int, str]


def _findings(text: str) -> list[tuple[int, int, re.Match]]:
    """(start, number of the rule, match) of what the rules find, by start and then in the rules' order."""
    found = []
    lowered = text.lower()
    for number, (kind, (pattern, group, least)) in enumerate(RULES.items()):
        if kind == "assign" and not any(word in lowered for word in _KEYWORDS) or kind == "access" and "AKIA" not in text:
            continue
        for match in pattern.finditer(text):
            if match.end(group) - match.start(group) >= least:
                found.append((match.start(), number, match))
    return sorted(found, key=lambda one: (one[0], one[1], one[2].end()))


def by_rules(text: str) -> list[Span]:
    """(start, end, kind) of what the rules find, by start and then in the rules' order."""
    return [(start, match.end(), KINDS[number]) for start, number, match in _findings(text)]


def _mixed(run: str) -> bool:
    if run.isalpha():
        return not (run.islower() or run.isupper())
    return not run.isdigit() and any(map(str.isalnum, run))


def candidates(text: str) -> list[tuple[int, int]]:
    assigned = {match.end() for match in _ASSIGNED.finditer(text)}
    found = []
    for match in RUN.finditer(text):
        start, end = match.span()
        if end - start >= LONG or start in assigned or _mixed(match[0]):
            found.append((start, end))
    return found


def _touching(spans: list[tuple[int, int]], others: list[tuple]) -> list[bool]:
    """Whether each span overlaps one of the others (start, end, and more), which are in the order of their starts."""
    if not others:
        return [False] * len(spans)
    starts = [other[0] for other in others]
    reach = list(accumulate((other[1] for other in others), max, initial=-1))  # the furthest end so far
    return [reach[bisect_left(starts, end)] > start for start, end in spans]


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return np.where(points < 128, _CODES[np.minimum(points, 127)], 0)


def _windows(codes: np.ndarray, start: int, end: int, context: bool) -> list[np.ndarray]:
    low, high = max(0, start - CONTEXT), min(len(codes), end + CONTEXT)
    row = np.full(end - start + 2 * CONTEXT, _BLANK, dtype=np.int64)
    if context:
        row[CONTEXT - (start - low):CONTEXT + high - start] = codes[low:high]
    row[CONTEXT:CONTEXT + end - start] = codes[start:end] + _SYMBOLS
    step = WINDOW - WIDTH + 1
    return [row[at:at + WINDOW] for at in range(0, max(1, len(row) - WIDTH + 1), step)]


def windows(text: str, span: tuple[int, int], context: bool = True) -> list[np.ndarray]:
    """The candidate with its context as symbol numbers, inside ones shifted by `_SYMBOLS`; several if it is long."""
    return _windows(_codes(text), *span, context)


class Network(NamedTuple):
    """One convolution of one-hot symbols, the largest and the mean response of each filter, a logistic output."""

    filters: np.ndarray  # WIDTH, symbols, FILTERS
    bias: np.ndarray
    weights: np.ndarray  # 2 * FILTERS
    offset: float
    slope: float  # of the calibration
    shift: float
    threshold: float

    def respond(self, rows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The responses to padded rows, 0 where there are none, and how many places each row has."""
        places = rows.shape[1] - WIDTH + 1
        active = np.take(self.filters[0], rows[:, :places], axis=0)
        for step in range(1, WIDTH):
            active += np.take(self.filters[step], rows[:, step:step + places], axis=0)
        active += self.bias
        np.maximum(active, 0, out=active)
        held = np.maximum(sizes - WIDTH, 0) + 1
        if held.min() < places:
            active *= (np.arange(places)[None, :] < held[:, None])[:, :, None]
        return active, held

    def raw(self, held: list[list[np.ndarray]]) -> np.ndarray:
        """The output before calibration of each candidate, its windows pooled together."""
        out = np.zeros(len(held))
        flat = sorted(((at, row) for at, rows in enumerate(held) for row in rows), key=lambda one: len(one[1]))  # little padding
        largest, mean, parts = np.zeros((len(held), FILTERS)), np.zeros((len(held), FILTERS)), np.zeros(len(held))
        for low in range(0, len(flat), BATCH):
            part = flat[low:low + BATCH]
            rows, sizes = pad([row for _, row in part])
            active, places = self.respond(rows, sizes)
            owner = np.array([at for at, _ in part])
            np.maximum.at(largest, owner, active.max(axis=1))
            np.add.at(mean, owner, active.sum(axis=1) / places[:, None])
            np.add.at(parts, owner, 1)
        if len(held):
            out = np.concatenate([largest, mean / parts[:, None]], axis=1) @ self.weights + self.offset
        return out

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -60, 60)))

    def chance(self, held: list[list[np.ndarray]]) -> np.ndarray:
        return self.calibrated(self.raw(held))


def pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(row) for row in rows])
    out = np.full((len(rows), max(WIDTH, int(sizes.max()))), _BLANK, dtype=np.int64)
    for at, row in enumerate(rows):
        out[at, :len(row)] = row
    return out, sizes


Values = list[np.ndarray]  # filters, bias, weights, offset


def untrained() -> Values:
    chance = np.random.default_rng(17)
    shapes = [(WIDTH, 2 * _SYMBOLS, FILTERS), (FILTERS,), (2 * FILTERS,), (1,)]
    return [(chance.normal(0, 0.1, shape) if at in (0, 2) else np.zeros(shape)).astype(np.float32) for at, shape in enumerate(shapes)]


def network(values: Values) -> Network:
    """Not calibrated yet."""
    return Network(values[0], values[1], values[2], float(values[3][0]), 1.0, 0.0, 0.5)


def _gradients(values: Values, rows: np.ndarray, sizes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Values:
    active, held = network(values).respond(rows, sizes)
    place = active.argmax(axis=1)
    row_numbers, filters = np.arange(len(rows))[:, None], np.arange(FILTERS)[None, :]
    top = active[row_numbers, place, filters]
    pooled = np.concatenate([top, active.sum(axis=1) / held[:, None]], axis=1)
    p = 1 / (1 + np.exp(-np.clip(pooled @ values[2] + values[3], -30, 30)))
    error = ((p - labels) * weights / len(rows)).astype(np.float32)
    spread = (active > 0) * (error[:, None] * values[2][FILTERS:] / held[:, None].astype(np.float32))[:, None, :]
    spread[row_numbers, place, filters] += error[:, None] * values[2][:FILTERS] * (top > 0)
    places = spread.shape[1]
    grown = np.zeros_like(values[0])
    for shift in range(WIDTH):  # added up by symbol: brought into its order, then summed in runs
        symbols = rows[:, shift:shift + places].astype(np.int16).ravel()
        order = np.argsort(symbols, kind="stable")
        symbols = symbols[order]
        first = np.flatnonzero(np.diff(symbols, prepend=-1))
        grown[shift, symbols[first]] = np.add.reduceat(spread.reshape(-1, FILTERS)[order], first, axis=0)
    return [grown + 1e-4 * values[0], spread.sum(axis=(0, 1)), pooled.T @ error + 1e-3 * values[2], np.array([error.sum()])]


def learn(
    values: Values, part: Callable[[int, bool], list[np.ndarray]], labels: np.ndarray, weights: np.ndarray, steps: int, seed: int,
    rate: float = 0.01,
) -> Values:
    """`values` after learning labelled rows in batches, RARE rows of the rarer kind or more in each: every row at least
    once, and at least `steps` batches. `part` gives the windows of a row, with or without its context."""
    kinds = sorted((np.flatnonzero(labels == kind) for kind in (0, 1)), key=len)
    if len(kinds[0]) == 0:
        return values
    chance = np.random.default_rng([17, seed])
    rare = min(max(RARE, BATCH * len(kinds[0]) // len(labels)), BATCH // 2)
    sizes_of = (rare, BATCH - rare)
    balance = np.repeat([BATCH / 2 / size for size in sizes_of], sizes_of)  # both kinds weigh as much
    least = max(-(-len(kind) // size) for kind, size in zip(kinds, sizes_of))
    moment, square = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    kinds = [chance.permutation(kind) for kind in kinds]
    for step in range(1, max(steps, least) + 1):
        chosen = np.concatenate([
            kind[np.arange((step - 1) * size, step * size) % len(kind)] for kind, size in zip(kinds, sizes_of)])
        source = chance.random(len(chosen)) < 0.5
        held = [part(at, bool(keep)) for at, keep in zip(chosen, source)]
        owner = np.array([at for at, rows in enumerate(held) for _ in rows])
        rows, sizes = pad([row for rows in held for row in rows])
        share = (weights[chosen] * balance / np.array([len(one) for one in held]))[owner]
        gradients = _gradients(values, rows, sizes, labels[chosen][owner], share)
        for at, gradient in enumerate(gradients):
            moment[at] = 0.9 * moment[at] + 0.1 * gradient
            square[at] = 0.999 * square[at] + 0.001 * gradient ** 2
        values = [(value - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
                  for value, m, q in zip(values, moment, square)]
    return values


def _flat(values: Values) -> np.ndarray:
    return np.concatenate([value.ravel() for value in values])


def _shaped(flat: np.ndarray) -> Values:
    out, at = [], 0
    for value in untrained():
        out.append(np.asarray(flat[at:at + value.size], dtype=np.float32).reshape(value.shape))
        at += value.size
    return out


def train(held: list[list[np.ndarray]], bare: list[list[np.ndarray]], labels: np.ndarray, recall: float = RECALL) -> Network | None:
    """The network of a few labelled findings, with (`held`) and without (`bare`) their context, in this process. Every fourth is
    held back for calibration and threshold. None without both kinds among either part."""
    back = np.arange(len(labels)) % 4 == 3
    if len({*labels[back].tolist()}) < 2 or len({*labels[~back].tolist()}) < 2:
        return None
    taught, kept_back = np.flatnonzero(~back), np.flatnonzero(back)
    net = network(learn(untrained(), lambda at, keep: (held if keep else bare)[taught[at]], labels[taught], np.ones(len(taught)), STEPS, 0))
    raw = net.raw([held[at] for at in kept_back])
    slope, shift = logistic(raw, labels[kept_back])
    net = net._replace(slope=slope, shift=shift)
    true = np.sort(net.calibrated(raw[labels[kept_back] == 1]))
    return net._replace(threshold=float(true[int(np.floor((1 - recall) * len(true)))]))


def find(texts: list[str], network: Network | None) -> list[list[Span]]:
    """All spans of each text: the rules', and the network's among the candidates that no rule's finding touches."""
    found = [by_rules(text) for text in texts]
    if network is None:
        return found
    asked = []
    for at, text in enumerate(texts):
        runs = candidates(text)
        asked += [(at, span) for span, touches in zip(runs, _touching(runs, found[at])) if not touches]
    for low in range(0, len(asked), 512):
        part = asked[low:low + 512]
        codes = {at: _codes(texts[at]) for at in {at for at, _ in part}}
        chances = network.chance([_windows(codes[at], *span, True) for at, span in part])
        for (at, (start, end)), chance in zip(part, chances):
            if chance >= network.threshold:
                found[at].append((start, end, "learned"))
    return [sorted(spans, key=lambda span: (span[0], KINDS.index(span[2]))) for spans in found]


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """The candidates of all documents with their context and label, equal ones once, and a hash of them."""
    kinds = "label int, left_text string, run string, right_text string"

    def cut(batches):
        for frame in batches:
            out = []
            for body in frame["text"]:
                runs, whole = candidates(body), _findings(body)
                values = sorted(match.span(RULES[KINDS[number]][1]) for _, number, match in whole)
                rules = [(start, match.end()) for start, _, match in whole]
                for (start, end), held, near in zip(runs, _touching(runs, values), _touching(runs, rules)):
                    if near and not held:
                        continue  # a word that names a value
                    out.append((int(held), body[max(0, start - CONTEXT):start], body[start:end], body[end:end + CONTEXT]))
            yield pd.DataFrame(out, columns=[part.split()[0] for part in kinds.split(", ")])

    found = docs.select(whole_text(text).alias("text")).mapInPandas(cut, kinds).distinct()
    return found.withColumn("mixed", F.xxhash64("left_text", "run", "right_text", "label"))


def _windows_of(frame: pd.DataFrame) -> Callable[[int, bool], list[np.ndarray]]:
    """The windows of a row of labelled candidates by its place, with or without the context."""
    left, run, right = (frame[name].str.len().to_numpy(dtype=int) for name in ("left_text", "run", "right_text"))
    codes = _codes("".join(frame["left_text"] + frame["run"] + frame["right_text"]))
    ends = np.cumsum(left + run + right)
    starts = ends - (left + run + right)
    return lambda at, keep=True: _windows(codes[starts[at]:ends[at]], left[at], left[at] + run[at], keep)


def _averaged(learned: DataFrame) -> Values:
    """The mean of the networks in (shard, values); MERGED of them come together in a task, and at most so many to the driver."""
    kinds = "shard long, n long, total array<double>"

    def merged(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("shard")
        total = np.sum(np.array(frame["total"].tolist(), dtype=float), axis=0)
        return pd.DataFrame({"shard": [int(frame["shard"].iloc[0]) // MERGED], "n": [int(frame["n"].sum())], "total": [total]})

    while learned.count() > MERGED:
        learned = materialise(learned.groupBy(F.floor(F.col("shard") / MERGED)).applyInPandas(merged, kinds))
    rows = learned.orderBy("shard").collect()
    return _shaped(np.sum([row.total for row in rows], axis=0) / sum(row.n for row in rows))


def fit(docs: DataFrame, *, text: str = "text", recall: float = RECALL) -> Network | None:
    """The network of the candidates of all documents."""
    table = materialise(labelled(docs, text).withColumn("long", F.length("run") >= LONG).withColumn("back", F.pmod("mixed", F.lit(4)) == 3))
    counts = {(row.back, row.label, row.long): row["count"] for row in table.groupBy("back", "label", "long").count().collect()}
    of = lambda back, label: sum(n for (b, kind, _), n in counts.items() if b == back and kind == label)
    if min(of(back, kind) for back in (True, False) for kind in (0, 1)) == 0:
        return None
    common = int(of(False, 1) > of(False, 0))
    shards = max(1, of(False, common) // SHARD_ROWS)
    cells = shards * ROUNDS
    fill = -(-of(False, common) * RARE // (BATCH - RARE))  # rows of the rarer kind that the batches want
    copies = min(cells, max(1, -(-fill // of(False, 1 - common))))  # of each of them
    weights = {}
    for kind in (0, 1):
        strata = {long: n for (back, label, long), n in counts.items() if not back and label == kind}
        whole = sum(min(n, STRATUM) for n in strata.values())
        weights |= {(kind, long): min(n, STRATUM) / whole * sum(strata.values()) / n for long, n in strata.items()}
    cell = F.pmod(F.shiftright("mixed", 2) + F.col("copy"), F.lit(cells))
    times = F.when(F.col("label") == common, 1).otherwise(copies)
    dealt = table.where("NOT back").withColumn("copy", F.explode(F.sequence(F.lit(0), times - 1))).withColumn("cell", cell).drop("copy")

    def learner(values: Values, number: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def learned(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(["mixed", "label", "left_text", "run", "right_text"], kind="stable", ignore_index=True)
            labels, shard = frame["label"].to_numpy(dtype=int), int(frame["cell"].iloc[0]) // ROUNDS
            share = np.array([weights[key] for key in zip(labels.tolist(), frame["long"].tolist())])
            after = learn(values, _windows_of(frame), labels, share, STEPS // ROUNDS, number * shards + shard, 0.01 / (1 + number))
            return pd.DataFrame({"shard": [shard], "n": [1], "total": [_flat(after).astype(float)]})

        return learned

    values = untrained()
    for number in range(ROUNDS):
        rows = dealt.where(F.col("cell") % ROUNDS == number)
        values = _averaged(materialise(rows.groupBy("cell").applyInPandas(learner(values, number), "shard long, n long, total array<double>")))
    net = network(values)

    def judged(batches):
        for frame in batches:
            part = _windows_of(frame)
            yield pd.DataFrame({"raw": net.raw([part(at) for at in range(len(frame))]), "label": frame["label"]})

    raw = materialise(table.where("back").mapInPandas(judged, "raw double, label int"))
    slope, shift = logistic_over(raw, "raw", "label")
    net = net._replace(slope=slope, shift=shift)
    # The order of the chances is that of what they are made of; only the one at the threshold is computed.
    true = raw.where("label = 1").select((F.signum(F.lit(slope)) * F.col("raw")).alias("value"))
    ends = true.agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).first()
    rank = int(np.floor((1 - recall) * ends.n))
    lowest = ends.low if ends.low == ends.high else values_at(true, [rank], ends.low, ends.high)[rank]
    return net._replace(threshold=float(net.calibrated(np.array([np.sign(slope) * lowest]))[0]))


def scan(docs: DataFrame, network: Network | None, *, text: str = "text", name: str = "found") -> DataFrame:
    """`docs` with an array of (start, end, kind) for what each whole text holds."""
    @F.pandas_udf("array<struct<start:int,end:int,kind:string>>")
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "kind": kind} for a, b, kind in one] for one in find(texts.tolist(), network)])

    return docs.withColumn(name, spans(whole_text(text)))


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with each finding (overlapping ones together) replaced by a mark."""
    if not spans:
        return text
    out, at, reach = [], 0, -1
    for start, end, _ in sorted(spans):
        if start >= reach:
            out += [text[at:start], "[SECRET]"]
        reach = max(reach, end)
        at = reach
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """`docs` with all findings masked in `text`, and `n_chars` (if there) counted anew where that changed it."""
    network = network or fit(docs)

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        bodies = [body or "" for body in texts.tolist()]
        return pd.Series([masked(given, spans) for given, spans in zip(texts.tolist(), find(bodies, network))])

    name = free_name(docs, "masked_text")
    out = docs.withColumn(name, cleaned(F.col("text").cast("string")))
    changed = ~F.col(name).eqNullSafe(F.col("text"))
    columns = []
    for column in docs.columns:
        if column == "text":
            columns.append(F.col(name).alias("text"))
        elif column == "n_chars":
            kind = docs.schema[column].dataType
            columns.append(F.when(changed, F.length(name).cast(kind)).otherwise(F.col(column)).alias(column))
        else:
            columns.append(F.col(f"`{column}`"))
    return out.select(columns)
