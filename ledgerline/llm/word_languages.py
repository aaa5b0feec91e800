"""The language of every word of a text, and of the text, by a linear-chain conditional random field.

Words are maximal runs of letters. A word's features are its affixes (one to four letters at either end), its character pairs
and triples, hashed, and what the lexicon knows of it: in which languages it occurs, counted over all texts that may be
learned from. Transitions between languages are learned together with the weights, on sequences spliced from runs of texts
in different languages, so that code-switched text gets its switches. Forward-backward gives each word its chances.

Long texts are not walked word by word: a text is cut into blocks of BLOCK words, the transfer matrices of all blocks are
multiplied up abreast, the blocks' borders follow from them, and then all blocks are filled in abreast. The result is the
exact one for the whole text. It takes time in the cube of the number of languages.

The lexicon holds the LEXICON commonest words, the training data are at most SAMPLE texts with SAMPLE_WORDS words each from
any place in them; both are bounds of what is fitted, the texts labelled are whole and all.

NULL and empty texts and texts without a letter are `und` with score 0. Ties go to the language that comes first in
order. Repeated rows get equal results. An empty table gives an empty one; without any text to learn from every
text is `und`. Other columns are kept, a column of the input that has the name of an added one is replaced.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.frames import materialise, sampled, whole_text
from ledgerline.llm.words import mix, slices

UNKNOWN = "und"
BUCKETS = 1 << 16
AFFIXES = 4
LEXICON = 30_000
SAMPLE, SAMPLE_WORDS = 3_000, 120
LONGEST_LEARNED = 60  # letters; longer words are not learned from
SEQUENCE, SEQUENCES = 64, 2_000
ROUNDS = 60
RIDGE = 1e-6
BLOCK = 64
SLICE = 1 << 20  # characters labelled together
_WORD = re.compile(r"[^\W\d_]+")


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # buckets, languages
    lexicon: dict[str, int]
    known: np.ndarray  # lexicon word, languages: how much likelier the word is there than elsewhere
    mixing: np.ndarray  # languages, languages: weight of the lexicon's languages for each label
    start: np.ndarray
    chain: np.ndarray


def words_in(text: str) -> list[str]:
    return _WORD.findall(text)


def plain(word: str) -> str:
    """Lower case and composed; empty where a run of word characters has no letter."""
    if not word.isalpha() and not any(map(str.isalpha, word)):
        return ""
    word = word.lower()
    return word if word.isascii() else unicodedata.normalize("NFC", word)


class Features(NamedTuple):
    """Hashed features of many words: `ids` of word i at starts[i]:starts[i + 1], each counting `share`."""

    ids: np.ndarray
    starts: np.ndarray
    share: np.ndarray


def features_of(words: list[str]) -> Features:
    """Affixes, character pairs and triples of all words at once; a border mark stands at both ends."""
    text = "".join(f"\x02{word}\x03" for word in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter((len(word) + 2 for word in words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes)
    begins = ends - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    found, owners = [], []

    def add(hashes, who, tag):
        found.append((mix(hashes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(tag)) >> np.uint64(64 - 16)).astype(np.int32))
        owners.append(who)

    for size in (2, 3):
        rolled = np.zeros(max(len(codes) - size + 1, 0), dtype=np.uint64)
        for step in range(size):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + codes[step:len(codes) - size + 1 + step]
        inside = owner[:len(rolled)] == owner[size - 1:] if len(rolled) else np.zeros(0, dtype=bool)
        add(rolled[inside], owner[:len(rolled)][inside], size)
    for side in (0, 1):
        rolled = np.zeros(len(words), dtype=np.uint64)
        for step in range(1, AFFIXES + 1):
            long = sizes >= step + 2
            place = np.where(long, begins + step if side == 0 else ends - 1 - step, 0)
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + (codes[place] if len(codes) else np.uint64(0))
            add(rolled[long], np.flatnonzero(long), 8 + 8 * side + step)
    ids, who = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(who, kind="stable")
    counts = np.bincount(who, minlength=len(words))
    return Features(ids[order], np.concatenate([[0], np.cumsum(counts)]), 4.0 / np.maximum(counts, 1) ** 0.75)


def hashed_scores(weights: np.ndarray, features: Features) -> np.ndarray:
    if not len(features.share):
        return np.zeros((0, weights.shape[1]))
    total = np.add.reduceat(weights[features.ids], features.starts[:-1], axis=0) if len(features.ids) else 0
    return total * features.share[:, None]  # every word has at least the pairs with its borders


def scores(model: Model, words: list[str]) -> np.ndarray:
    """How well each word goes with each language, apart from its neighbours."""
    place = np.fromiter((model.lexicon.get(word, -1) for word in words), dtype=np.int64, count=len(words))
    held = np.where(place[:, None] >= 0, model.known[place], 0.0) if len(model.known) else np.zeros((len(words), len(model.languages)))
    return hashed_scores(model.weights, features_of(words)) + held @ model.mixing


def forward_backward(emission: np.ndarray, starts: np.ndarray, start: np.ndarray, chain: np.ndarray) -> np.ndarray:
    """The chances of each label at each place of many sequences: places starts[i]:starts[i + 1] are sequence i."""
    many = emission.shape[1]
    sizes = np.diff(starts)
    blocks_each = -(-sizes // BLOCK)
    blocks = int(blocks_each.sum())
    if not blocks:
        return np.zeros((0, many))
    first_block = np.cumsum(blocks_each) - blocks_each
    sequence = np.repeat(np.arange(len(sizes)), blocks_each)
    ordinal = np.arange(blocks) - first_block[sequence]
    begin = starts[sequence] + ordinal * BLOCK
    length = np.minimum(BLOCK, starts[sequence + 1] - begin)
    strength = np.exp(emission - emission.max(axis=1, keepdims=True))
    steps = np.arange(BLOCK)[:, None]
    psi = strength[np.minimum(begin + steps, len(emission) - 1)]  # step, block, label
    opens = np.flatnonzero(ordinal == 0)
    moves = np.exp(chain - chain.max())
    opening = np.exp(start - start.max())

    # What a block that others follow does to the chances before it: the product of its steps. Such blocks are full.
    inner = np.flatnonzero(ordinal < blocks_each[sequence] - 1)
    transfer = np.empty((blocks, many, many))
    if len(inner):
        now = np.broadcast_to(np.eye(many), (len(inner), many, many))
        for step in range(BLOCK):
            now = (now.reshape(-1, many) @ moves).reshape(now.shape) * psi[step, inner][:, None, :]
            now /= now.max(axis=(1, 2), keepdims=True)
        transfer[inner] = now
    # The chances at the end of each block before the next one, from a sequence's first block on.
    before = np.empty((blocks, many))
    left = opening * psi[0, opens]
    for step in range(1, BLOCK):
        left = (left @ moves) * psi[step, opens]  # beyond a short block's end this is not used
        left /= left.sum(axis=1, keepdims=True)
    held = np.zeros((len(sizes), many))
    held[sequence[opens]] = left
    for number in range(1, int(blocks_each.max())):
        which = np.flatnonzero(blocks_each > number)
        block = first_block[which] + number
        before[block] = held[which]
        on = blocks_each[which] > number + 1
        now = (held[which[on]][:, None, :] @ transfer[block[on]])[:, 0]
        held[which[on]] = now / now.sum(axis=1, keepdims=True)

    alpha = np.empty_like(psi)
    for step in range(BLOCK):
        came = (alpha[step - 1] if step else before) @ moves
        if step == 0:
            came[opens] = opening
        came *= psi[step]
        came /= came.sum(axis=1, keepdims=True)
        alpha[step] = came
    # From the right: a sequence's last block first, then the others abreast with what follows them.
    last = first_block[blocks_each > 0] + blocks_each[blocks_each > 0] - 1
    after = np.ones((blocks, many))
    right = _backward(np.ones((len(last), many)), psi[:, last], moves, length[last])
    held[sequence[last]] = right
    for number in range(int(blocks_each.max()) - 2, -1, -1):
        which = np.flatnonzero(blocks_each > number + 1)
        block = first_block[which] + number
        after[block] = held[which]
        now = (transfer[block] @ held[which][:, :, None])[:, :, 0]
        held[which] = now / now.sum(axis=1, keepdims=True)

    chances = np.empty((len(emission), many))
    beta = after
    for step in range(BLOCK - 1, -1, -1):
        live = length > step
        now = alpha[step] * beta
        now /= now.sum(axis=1, keepdims=True)
        chances[begin[live] + step] = now[live]
        back = (psi[step] * beta) @ moves.T
        back /= back.sum(axis=1, keepdims=True)
        beta = np.where(live[:, None], back, beta)
    return chances


def _backward(beta: np.ndarray, psi: np.ndarray, moves: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What follows the place in front of each block, from what follows the block's end."""
    for step in range(len(psi) - 1, -1, -1):
        back = (psi[step] * beta) @ moves.T
        beta = np.where((length > step)[:, None], back / back.sum(axis=1, keepdims=True), beta)
    return beta


def _expected(emission: np.ndarray, start: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of labels (place, sequence, label) and expected moves, for sequences of one length."""
    length = len(emission)
    psi = np.exp(emission - emission.max(axis=2, keepdims=True))
    moves, opening = np.exp(chain), np.exp(start)
    alpha = np.empty_like(psi)
    beta = np.ones_like(psi)
    for step in range(length):
        now = (alpha[step - 1] @ moves if step else opening) * psi[step]
        alpha[step] = now / now.sum(axis=1, keepdims=True)
    pairs = np.zeros_like(chain)
    for step in range(length - 1, 0, -1):
        held = psi[step] * beta[step]
        now = held @ moves.T
        beta[step - 1] = now / now.sum(axis=1, keepdims=True)
        pairs += moves * ((alpha[step - 1] / (alpha[step - 1] * now).sum(axis=1, keepdims=True)).T @ held)
    chances = alpha * beta
    chances /= chances.sum(axis=2, keepdims=True)
    return chances, pairs


def splice(texts: list[tuple[int, list[str]]], languages: int, chance: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """Training sequences: runs of words of one text after runs of another, most often in another language."""
    pools = [[words for label, words in texts if label == language and words] for language in range(languages)]
    full = [label for label, pool in enumerate(pools) if pool]
    words, labels = [], []
    for _ in range(SEQUENCES):
        held: list[str] = []
        marks: list[int] = []
        while len(held) < SEQUENCE:
            label = full[int(chance.integers(len(full)))]
            source = pools[label][int(chance.integers(len(pools[label])))]
            size = min(1 + int(chance.geometric(1 / 20)), len(source))
            at = int(chance.integers(len(source) - size + 1))
            held += source[at:at + size]
            marks += [label] * size
        words += held[:SEQUENCE]
        labels.append(marks[:SEQUENCE])
    return words, np.array(labels)


def learn(texts: list[tuple[int, list[str]]], languages: list[str], lexicon: dict[str, int], known: np.ndarray, seed: int = 5) -> Model:
    """The field's weights for texts in one language each: `texts` are (language number, plain words)."""
    many = len(languages)
    chance = np.random.default_rng(seed)
    words, labels = splice(texts, many, chance)
    number, distinct = pd.factorize(np.array(words, dtype=object))
    number, labels = number.reshape(labels.shape).T, labels.T  # place, sequence
    features = features_of(list(distinct))
    owner = np.repeat(np.arange(len(distinct)), np.diff(features.starts))
    place = np.fromiter((lexicon.get(word, -1) for word in distinct), dtype=np.int64, count=len(distinct))
    held = np.where(place[:, None] >= 0, known[place], 0.0) if len(known) else np.zeros((len(distinct), many))
    # Every word of the sample is in the lexicon's texts; half of them are looked at without it, as unknown words will be.
    seen = held[number] * (chance.random(labels.shape) < 0.5)[:, :, None]
    wanted = np.eye(many)[labels]
    moves = np.zeros((many, many))
    np.add.at(moves, (labels[:-1].ravel(), labels[1:].ravel()), 1)
    values = [np.zeros((BUCKETS, many)), np.zeros((many, many)), np.zeros(many), np.zeros((many, many))]
    first = [np.zeros_like(value) for value in values]
    second = [np.zeros_like(value) for value in values]
    size = labels.size
    for round_ in range(1, ROUNDS + 1):
        weights, mixing, start, chain = values
        emission = hashed_scores(weights, features)[number] + seen @ mixing
        chances, pairs = _expected(emission, start, chain)
        error = (chances - wanted) / size
        per_word = np.zeros((len(distinct), many))
        for label in range(many):
            per_word[:, label] = np.bincount(number.ravel(), weights=error[:, :, label].ravel(), minlength=len(distinct))
        per_word *= features.share[:, None]
        slope = np.empty_like(weights)
        for label in range(many):
            slope[:, label] = np.bincount(features.ids, weights=per_word[owner, label], minlength=BUCKETS)
        slopes = [slope + RIDGE * weights, seen.reshape(-1, many).T @ error.reshape(-1, many) + RIDGE * mixing,
                  error[0].sum(axis=0) + RIDGE * start, (pairs - moves) / size + RIDGE * chain]
        for at, slope in enumerate(slopes):  # Adam
            first[at] = 0.9 * first[at] + 0.1 * slope
            second[at] = 0.99 * second[at] + 0.01 * slope * slope
            step = first[at] / (1 - 0.9 ** round_) / (np.sqrt(second[at] / (1 - 0.99 ** round_)) + 1e-9)
            values[at] = values[at] - 0.1 * step
    weights, mixing, start, chain = values
    return Model(languages, weights.astype(np.float32), lexicon, known, mixing, start, chain)


def remainder(column: str = "doc_id") -> Column:
    """crc32 of an id as text, modulo 4."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4


def learnable(column: str = "doc_id") -> Column:
    return F.coalesce(remainder(column) != 2, F.lit(False))


def lexicon_of(taught: DataFrame, limit: int = LEXICON) -> tuple[list[str], dict[str, int], np.ndarray]:
    """(languages, place of each word, log odds of each word in each language) from the words of all texts in `taught`
    (_lang, _text); the `limit` commonest words."""
    def counted(frames):
        for frame in frames:
            tally: dict[str, Counter] = defaultdict(Counter)
            for language, text in zip(frame["_lang"], frame["_text"]):
                tally[language].update(words_in(text))
            out: Counter = Counter()
            for language, held in tally.items():
                for word, count in held.items():
                    if word := plain(word):
                        out[language, word] += count
            yield pd.DataFrame([(*key, count) for key, count in out.items()], columns=["lang", "word", "n"])

    counts = materialise(
        taught.mapInPandas(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = {row.lang: row.n for row in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    held = F.map_from_entries(F.collect_list(F.struct("lang", "n")))  # one entry a language
    common = counts.where(F.length("word") <= LONGEST_LEARNED).groupBy("word").agg(F.sum("n").alias("n"), held.alias("held"))
    rows = common.orderBy(F.desc("n"), "word").limit(limit).collect()
    table = np.array([[row.held.get(language, 0) for language in languages] for row in rows], dtype=float).reshape(len(rows), len(languages))
    share = (table + 0.3) / np.array([totals[language] + 1.0 for language in languages])
    odds = np.log(share / share.sum(axis=1, keepdims=True) * len(languages)) if len(rows) else share
    return languages, {row.word: at for at, row in enumerate(rows)}, np.clip(odds, -4, 4)


def fit(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang", lexicon: int = LEXICON,
    sample: int = SAMPLE, sample_words: int = SAMPLE_WORDS,
) -> Model | None:
    """The model of the texts with a language that may be learned from; None if there is none with a letter."""
    taught = docs.where(learnable(key) & F.col(lang).isNotNull()).select(
        F.col(key).alias("_key"), F.col(lang).cast("string").alias("_lang"), whole_text(text).alias("_text"))
    languages, places, known = lexicon_of(taught, lexicon)
    if not languages:
        return None

    def runs(frames):
        for frame in frames:
            out = []
            for key_, language, text_ in zip(frame["_key"], frame["_lang"], frame["_text"]):
                words = [word for word in map(plain, words_in(text_)) if 0 < len(word) <= LONGEST_LEARNED]
                if words:
                    at = hash_place(str(key_), len(words) - sample_words)
                    out.append((language, words[at:at + sample_words]))
            yield pd.DataFrame(out, columns=["lang", "words"])

    chosen = []
    for language in languages:  # as many texts of each, so that rare languages are learned too
        each = taught.where(F.col("_lang") == language)
        chosen += sampled(each, -(-sample // len(languages)), "_key").mapInPandas(runs, "lang string, words array<string>").collect()
    texts = sorted((languages.index(row.lang), list(row.words)) for row in chosen)
    return learn(texts, languages, places, known) if texts else None


def hash_place(key: str, room: int) -> int:
    """A place between 0 and `room` that depends on the key."""
    number = int(mix(np.array([sum((at + 1) * ord(sign) for at, sign in enumerate(key)) + 1], dtype=np.uint64))[0])
    return number % (room + 1) if room > 0 else 0


def _chances(texts: list[str], model: Model) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of texts: (from, to, starts of the texts among the slice's words, chances of these words)."""
    for begin, end in slices(texts, SLICE):
        held = [words_in(text) for text in texts[begin:end]]
        flat = [word for words in held for word in words]
        sizes = np.fromiter(map(len, held), dtype=np.int64, count=len(held))
        if not flat:
            yield begin, end, np.zeros(len(held) + 1, dtype=np.int64), np.zeros((0, len(model.languages)))
            continue
        number, distinct = pd.factorize(np.array(flat, dtype=object))
        shaped = [plain(word) for word in distinct]
        score = scores(model, shaped)
        score[[not word for word in shaped]] = 0.0  # numerals and the like say nothing, and carry no weight below
        chances = forward_backward(score[number], np.concatenate([[0], np.cumsum(sizes)]), model.start, model.chain)
        chances[np.array([not word for word in shaped])[number]] = 0.0
        yield begin, end, np.concatenate([[0], np.cumsum(sizes)]), chances


def shares(texts: list[str], model: Model) -> np.ndarray:
    """The share of each language in the words of each text; a row of zeros for a text without letters."""
    out = np.zeros((len(texts), len(model.languages)))
    for begin, end, starts, chances in _chances(texts, model):
        total = np.concatenate([np.zeros((1, chances.shape[1])), np.cumsum(chances, axis=0)])
        held = total[starts[1:]] - total[starts[:-1]]
        out[begin:end] = held / np.maximum(held.sum(axis=1, keepdims=True), 1e-12)
    return out


def label(texts: list[str], model: Model) -> list[list[tuple[int, int, str]]]:
    """Runs of words of one language in each text: (start, end, language), in code points."""
    out: list[list[tuple[int, int, str]]] = []
    for begin, end, starts, chances in _chances(texts, model):
        best, known = chances.argmax(axis=1), chances.sum(axis=1) > 0
        for at, text in enumerate(texts[begin:end]):
            runs: list[tuple[int, int, str]] = []
            for place, match in enumerate(_WORD.finditer(text), start=int(starts[at])):
                if not known[place]:
                    continue
                language = model.languages[best[place]]
                if runs and runs[-1][2] == language:
                    runs[-1] = (runs[-1][0], match.end(), language)
                else:
                    runs.append((match.start(), match.end(), language))
            out.append(runs)
    return out


def identify(docs: DataFrame, model: Model | None, *, text: str = "text") -> DataFrame:
    """`docs` with lang_pred, the language of most of a text's words, and score, its share of them."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def judged(texts: pd.Series) -> pd.DataFrame:
        model = held.value
        if model is None:
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)})
        table = shares(texts.tolist(), model)
        best = table.argmax(axis=1)
        found = table.sum(axis=1) > 0
        return pd.DataFrame({
            "lang_pred": [model.languages[at] if real else UNKNOWN for at, real in zip(best, found)],
            "score": np.clip(np.where(found, table[np.arange(len(table)), best], 0.0), 0.0, 1.0)})

    return _with(docs, judged(whole_text(text)), "lang_pred", "score")


def _with(docs: DataFrame, made: Column, *names: str) -> DataFrame:
    kept = [F.col(name) for name in docs.columns if name.lower() not in names]
    return docs.select(*kept, made.alias("_made")).select(*kept, *(F.col("_made")[name].alias(name) for name in names))


def label_runs(docs: DataFrame, model: Model, *, text: str = "text", name: str = "languages") -> DataFrame:
    """`docs` with the runs of words of one language in each text, for texts that switch languages."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<start:int,end:int,lang:string>>")
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "lang": language} for a, b, language in runs]
                          for runs in label(texts.tolist(), held.value)])

    return docs.withColumn(name, spans(whole_text(text)))
