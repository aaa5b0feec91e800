"""Words and word shingles of many texts at once, as 64-bit hashes in numpy arrays.

A word is a maximal run of ASCII letters, ASCII digits and non-ASCII characters, lower-cased. Hashes are polynomials
of the UTF-8 bytes modulo 2**64, mixed afterwards; they depend on nothing but the word. Different words can share one, also
by design, so hashes only find candidates. Whatever decides compares the words: `numbers_of` and `shingle_numbers` give
numbers that are equal for equal words and shingles alone, within one call.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd

SHINGLE = 5
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP = 1 << 16


def _powers(base: int, count: int) -> np.ndarray:
    out = np.empty(count, dtype=np.uint64)
    out[0] = 1
    filled = 1
    while filled < count:  # doubling: each pass multiplies what is there by the next power
        take = min(filled, count - filled)
        out[filled:filled + take] = out[:take] * np.uint64(pow(base, filled, 1 << 64))
        filled += take
    return out


_UP = _powers(int(_BASE), _STEP)
_DOWN = _powers(pow(int(_BASE), -1, 1 << 64), _STEP)
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over the output."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def run_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for each run [begin, end) of `data` that depends on the run's values and length only.

    Powers start anew every _STEP values; a run across that border is hashed on its own.
    """
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    values = data.astype(np.uint64)
    values += np.uint64(1)
    for at in range(0, len(data), _STEP):
        values[at:at + _STEP] *= _UP[:len(data) - at]
    np.cumsum(values, out=total[1:])
    hashes = (total[end] - total[begin]) * _DOWN[begin & (_STEP - 1)]
    for at in np.flatnonzero((begin // _STEP) != ((end - 1) // _STEP)):
        run = data[begin[at]:end[at]].astype(np.uint64) + np.uint64(1)
        hashes[at] = (run * _powers(int(_BASE), len(run))).sum(dtype=np.uint64)
    return hashes * np.uint64(0x9E3779B97F4A7C15) + (end - begin).astype(np.uint64)


class Words(NamedTuple):
    hashes: np.ndarray  # one per word
    starts: np.ndarray  # of each text in `hashes`; one more than texts


def words_of(texts: list[str]) -> Words:
    """The word hashes of all texts, one after the other."""
    raw = [text.lower().encode("utf-8", "surrogatepass") for text in texts]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 1
    data = np.frombuffer(b"\0".join(raw) + b"\0", dtype=np.uint8)
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    begin, end = edge[0::2], edge[1::2]
    ends = np.cumsum(sizes)
    starts = np.concatenate([[0], np.searchsorted(begin, ends)])
    if not len(begin):
        return Words(np.zeros(0, dtype=np.uint64), starts)
    return Words(mix(run_hashes(data, begin, end)), starts)


def grams_of(words: Words, size: int) -> Words:
    """Hashes of `size` words in a row, per text and place; a text with fewer words has none."""
    hashes, starts = words
    counts = np.diff(starts)
    keep = np.maximum(counts - size + 1, 0)
    out_starts = np.concatenate([[0], np.cumsum(keep)])
    if not out_starts[-1]:
        return Words(np.zeros(0, dtype=np.uint64), out_starts)
    whole = len(hashes) - size + 1
    rolled = np.zeros(whole, dtype=np.uint64)
    for step in range(size):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + hashes[step:step + whole]
    at = np.arange(out_starts[-1]) + np.repeat(starts[:-1] - out_starts[:-1], keep)
    return Words(mix(rolled[at]), out_starts)


def shingles_of(words: Words, size: int = SHINGLE) -> Words:
    """As `grams_of`, but a text of one to `size` - 1 words has one shingle, of all its words; one without words none."""
    grams = grams_of(words, size)
    counts = np.diff(words.starts)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if not len(short):
        return grams
    add = np.empty(len(short), dtype=np.uint64)
    for place, text in enumerate(short):
        value = np.uint64(counts[text])
        with np.errstate(over="ignore"):
            for word in words.hashes[words.starts[text]:words.starts[text + 1]]:
                value = value * np.uint64(0xD6E8FEB86659FD93) + word
        add[place] = value
    hashes = np.insert(grams.hashes, grams.starts[short], mix(add))
    extra = np.zeros(len(counts), dtype=np.int64)
    extra[short] = 1
    return Words(hashes, grams.starts + np.concatenate([[0], np.cumsum(extra)]))


_APART = bytes(byte if inside else 32 for byte, inside in enumerate(_WORD.tolist()))


def numbers_of(texts: list[str]) -> Words:
    """As `words_of`, with numbers from 0 on instead of hashes: equal for equal words of these texts, and for no others."""
    held = [text.lower().encode("utf-8", "surrogatepass").translate(_APART).split() for text in texts]
    starts = np.concatenate([[0], np.cumsum([len(words) for words in held], dtype=np.int64)]).astype(np.int64)
    flat = np.array([word for words in held for word in words], dtype=object)
    return Words(pd.factorize(flat)[0].astype(np.uint64) if len(flat) else np.zeros(0, dtype=np.uint64), starts)


def shingle_numbers(words: Words, size: int = SHINGLE) -> Words:
    """As `shingles_of`, for the numbers of `numbers_of`: equal for equal shingles, and for no others."""
    numbers, starts = words.hashes.astype(np.int64), words.starts
    counts = np.diff(starts)
    base = int(numbers.max(initial=0)) + 2
    code = numbers + 1
    out = []
    for step in range(1, size + 1):
        if step > 1:  # one word more: the number of the pair (so far, next word); 0 stands for the end of a text
            ahead = np.zeros(len(numbers), dtype=np.int64)
            there = max(len(numbers) - step + 1, 0)
            ahead[:there] = numbers[len(numbers) - there:] + 1
            code = pd.factorize(code * base + ahead)[0].astype(np.int64) if len(code) else code
        if step < size:
            out.append((np.flatnonzero(counts == step), code))
    keep = np.maximum(counts - size + 1, 0)
    keep[(counts > 0) & (counts < size)] = 1
    out_starts = np.concatenate([[0], np.cumsum(keep)])
    at = np.arange(out_starts[-1]) + np.repeat(starts[:-1] - out_starts[:-1], keep)
    found = code[at] * size if len(at) else np.zeros(0, dtype=np.int64)
    for step, (short, so_far) in enumerate(out, start=1):  # a short text's shingle is told apart by its size
        found[out_starts[short]] = so_far[starts[short]] * size + step
    return Words(found.astype(np.uint64), out_starts)


def slices(texts: list[str], characters: int = 1 << 20):
    """(from, to) of runs of texts with about so many characters together, so that arrays stay small."""
    begin, held = 0, 0
    for at, text in enumerate(texts):
        held += len(text) + 1
        if held >= characters:
            yield begin, at + 1
            begin, held = at + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
