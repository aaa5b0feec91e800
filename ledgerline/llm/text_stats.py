"""Statistics of whole texts, many texts at once: character classes, words, repetition, lines."""

from __future__ import annotations

import numpy as np

from ledgerline.llm.words import grams_of, slices, words_of

# Byte classes; what is named in none of them is class 0.
_CLASSES = {
    "lower": range(97, 123),
    "upper": range(65, 91),
    "digit": range(48, 58),
    "blank": (32, 9),
    "newline": (10, 13),
    "stop": b".,;:?",
    "shout": b"!",
    "bar": b"|",
    "symbol": b"#$%&*@^~",
    "quote": b"\"'()[]{}<>-_/\\",
    "lead": range(192, 256),
    "follow": range(128, 192),
}
_CLASS_OF = np.zeros(256, dtype=np.int64)
for _number, _bytes in enumerate(_CLASSES.values(), start=1):
    _CLASS_OF[list(_bytes)] = _number
_COUNT = len(_CLASSES) + 1

NAMES = (
    "size", "words", "word_size", "distinct_words", "top_word", "distinct_triples", "lines", "upper", "digit", "stop",
    "shout", "bar", "symbol", "quote", "accented", "other", "space",
)


def _per_text_sorted(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many distinct hashes each text has, and how often its commonest occurs."""
    counts = np.diff(starts)
    text = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(first)
    runs = np.diff(np.append(at, len(hashes)))
    top = np.zeros(len(counts), dtype=np.int64)
    np.maximum.at(top, text[at], runs)
    return np.bincount(text[at], minlength=len(counts)), top


def _slice(texts: list[str]) -> np.ndarray:
    raw = [text.encode("utf-8", "surrogatepass") for text in texts]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    number = np.repeat(np.arange(len(raw)) * _COUNT, sizes)
    table = np.bincount(number + _CLASS_OF[data], minlength=len(raw) * _COUNT).reshape(len(raw), _COUNT)
    classes = {name: table[:, at].astype(float) for at, name in enumerate(_CLASSES, start=1)}
    characters = sizes - classes["follow"]

    words = words_of(texts)
    count = np.diff(words.starts).astype(float)
    distinct, top = _per_text_sorted(words.hashes, words.starts)
    triples = grams_of(words, 3)
    triple_count = np.diff(triples.starts)
    distinct_triples, _ = _per_text_sorted(triples.hashes, triples.starts)
    held = sizes - classes["blank"] - classes["newline"]

    def share(part, whole):
        return (part + 0.5) / (whole + 1.0)

    def logged(part, whole):
        return np.log(share(part, whole))

    columns = (
        np.log1p(characters), np.log1p(count), np.log1p(held / np.maximum(count, 1)),
        share(distinct, count), share(top, count), share(distinct_triples, triple_count),
        logged(classes["newline"], characters), logged(classes["upper"], characters), logged(classes["digit"], characters),
        logged(classes["stop"], characters), logged(classes["shout"], characters), logged(classes["bar"], characters),
        logged(classes["symbol"], characters), logged(classes["quote"], characters), logged(classes["lead"], characters),
        logged(table[:, 0].astype(float), characters), share(classes["blank"], characters),
    )
    return np.stack(columns, axis=1)


def statistics(texts: list[str]) -> np.ndarray:
    """One row of `NAMES` for each text, from all of it."""
    parts = [_slice(texts[begin:end]) for begin, end in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(NAMES)))
