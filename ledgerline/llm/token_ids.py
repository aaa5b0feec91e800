"""Token ids of whole texts with the tokenizers library, many texts at once.

Pieces (the words that a tokenizer's pattern cuts a text into) are found for all texts of a slice together in numpy;
each distinct piece is encoded once by the library's model and remembered. Pieces are looked up by a hash, but a hash never
stands for a piece: its characters are compared with those that were encoded, and a text with a piece that shares its hash
with another one goes to the library whole, as do texts with characters beyond Latin (before or after lower-casing) and
texts holding one of the vocabulary's special strings. Both ways give the same ids, which tests check.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd

from ledgerline.llm.words import run_hashes, slices

LATIN = 0x250
REMEMBERED = 1_500_000  # pieces a worker remembers, at about 30 bytes each, before it starts anew
SLICE = 5 << 19  # characters looked at together
STEPS = 24  # characters of a piece that are compared for all pieces together
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
_CLASS = np.full(LATIN, OTHER, dtype=np.int8)
for _code in range(LATIN):
    _kind = unicodedata.category(chr(_code))
    if _kind[0] in "LN":
        _CLASS[_code] = LETTER if _kind[0] == "L" else NUMBER
_CLASS[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = SPACE
_CLASS[0] = 0  # the character between texts
_ODD = re.compile("[^\x01-ɏ]")  # needs the library itself
_ENDINGS = re.compile("'(?:[stmd]|re|ve|ll)")  # fixed values: the endings both vocabularies' patterns cut off


class Ids(NamedTuple):
    flat: np.ndarray  # uint32
    starts: np.ndarray


def _byte_characters() -> dict[int, str]:
    """Byte-level vocabularies write each byte as one printable character: itself, or one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {byte: chr(byte) if byte in plain else chr(next(spare)) for byte in range(256)}


class Runs(NamedTuple):
    """Characters of many pieces: piece i is `codes[begin[i]:end[i]]`."""

    codes: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def take(self, at: np.ndarray) -> Runs:
        return Runs(self.codes, self.begin[at], self.end[at])

    def packed(self) -> np.ndarray:
        """The characters of all pieces, one piece after the other."""
        size = self.end - self.begin
        run = np.cumsum(size)
        if not len(run):
            return self.codes[:0]
        return self.codes[np.arange(run[-1]) + np.repeat(self.begin - (run - size), size)]


def equal_runs(one: Runs, other: Runs) -> np.ndarray:
    """Whether piece i of one is piece i of the other: first characters of all, then second ones, the rest of long pieces
    together. Arrays stay as small as the number of pieces, which are short."""
    size = one.end - one.begin
    same = size == other.end - other.begin
    at = np.flatnonzero(same)
    left, right, left_size = one.begin[at], other.begin[at], size[at]
    for step in range(STEPS + 1):
        live = np.flatnonzero(left_size > step)
        if len(live) < len(at):
            at, left, right, left_size = at[live], left[live], right[live], left_size[live]
        if step == STEPS or not len(at):
            break
        differs = one.codes[left + step] != other.codes[right + step]
        if differs.any():
            same[at[differs]] = False
    for place, a, b, length in zip(at.tolist(), left.tolist(), right.tolist(), left_size.tolist()):
        same[place] &= np.array_equal(one.codes[a:a + length], other.codes[b:b + length])
    return same


class Memory:
    """Ids and characters of pieces by the pieces' 64-bit hashes: sorted arrays, so that a slice's pieces are looked up
    together."""

    def __init__(self):
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.places = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int32)
        self.begin = np.zeros(0, dtype=np.int64)  # of its characters in `codes`
        self.end = np.zeros(0, dtype=np.int64)
        self.pool = np.zeros(1 << 20, dtype="<u4")
        self.codes = np.zeros(1 << 20, dtype="<u2")
        self.filled = self.written = 0

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the table, whether it is there)."""
        at = np.searchsorted(self.hashes, hashes)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == hashes[known]
        return at, known

    def add(self, hashes: np.ndarray, ids: list[list[int]], pieces: Runs) -> None:
        if len(self.hashes) + len(hashes) > REMEMBERED:
            self.__init__()
        sizes = np.fromiter(map(len, ids), dtype=np.int32, count=len(ids))
        total = int(sizes.sum())
        while self.filled + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.filled:self.filled + total] = [one for piece in ids for one in piece]
        places = self.filled + np.cumsum(sizes) - sizes
        self.filled += total
        letters = pieces.packed()
        while self.written + len(letters) > len(self.codes):
            self.codes = np.concatenate([self.codes, np.zeros_like(self.codes)])
        self.codes[self.written:self.written + len(letters)] = letters
        end = self.written + np.cumsum(pieces.end - pieces.begin)
        begin = end - (pieces.end - pieces.begin)
        self.written += len(letters)
        order = np.argsort(hashes)
        at = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, at, hashes[order])
        self.places = np.insert(self.places, at, places[order])
        self.sizes = np.insert(self.sizes, at, sizes[order])
        self.begin = np.insert(self.begin, at, begin[order])
        self.end = np.insert(self.end, at, end[order])


class Encoder:
    """Encodes texts as `Tokenizer.from_file(path).encode(text, add_special_tokens=False)` does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.style = "word" if self.library.normalizer is not None else "byte"
        self.special = [token.content for token in self.library.get_added_tokens_decoder().values()]
        self.letters = _byte_characters()
        self.memory = Memory()
        self.known = True
        probe = "It's  a\n Test, 12 x'll "
        if self._quick([probe])[0].flat.tolist() != self.library.encode(probe, add_special_tokens=False).ids:
            self.known = False  # a vocabulary with another pattern: the library does it all

    def _piece(self, piece: str) -> list[int]:
        written = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return [token.id for token in self.model.tokenize(written)]

    def _starts(self, codes: np.ndarray, whole: str) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces begin and end, in `codes`, as the two vocabularies' patterns cut them."""
        kind = _CLASS[codes]
        before, after = np.empty_like(kind), np.empty_like(kind)
        before[0], before[1:] = 0, kind[:-1]
        after[-1], after[:-1] = 0, kind[1:]
        new = kind != before
        if self.style == "byte":  # a blank goes with what follows; the last of other white space stands alone
            blank = np.zeros(len(codes), dtype=bool)
            blank[1:] = codes[:-1] == 32
            space = kind == SPACE
            start = np.where(space, new | ((after != SPACE) & (after != 0)), new & (~blank | (kind == 0)))
            alone = (before != OTHER) & ~blank
        else:
            start = new | (kind == NUMBER)
            alone = before != OTHER
        if "'" in whole:
            for match in _ENDINGS.finditer(whole):
                if alone[match.start()]:
                    start[match.start() + 1:match.end()] = False
                    start[match.end()] = start[match.end()] or kind[match.end()] == LETTER
        begin = np.flatnonzero(start)
        end = np.append(begin[1:], len(codes))
        keep = kind[begin] != 0
        if self.style == "word":
            keep &= kind[begin] != SPACE
        return begin[keep], end[keep]

    def _quick(self, texts: list[str]) -> tuple[Ids, np.ndarray]:
        """(ids, texts that the library has to do because two different pieces share a hash)."""
        if self.style == "word":
            texts = [text.lower() for text in texts]
        whole = "\0".join(texts) + "\0"
        codes = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        begin, end = self._starts(codes, whole)
        bounds = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
        if not len(begin):
            return Ids(np.zeros(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)), np.zeros(0, dtype=np.int64)
        runs = Runs(codes, begin, end)
        hashes = run_hashes(codes, begin, end)
        which, distinct = pd.factorize(hashes)
        first = np.empty(len(distinct), dtype=np.int64)
        first[which[::-1]] = np.arange(len(which) - 1, -1, -1)
        order = np.argsort(distinct)  # look-ups in order stay in the processor's cache
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        which, distinct, first = rank[which], distinct[order], first[order]
        at, known = self.memory.find(distinct)
        if not known.all():
            new = first[~known]
            pieces = [self._piece(whole[b:e]) for b, e in zip(begin[new].tolist(), end[new].tolist())]
            self.memory.add(distinct[~known], pieces, runs.take(new))
            if not self.memory.find(distinct)[1].all():  # it was cleared just now
                gone = first[known]
                pieces = [self._piece(whole[b:e]) for b, e in zip(begin[gone].tolist(), end[gone].tolist())]
                self.memory.add(distinct[known], pieces, runs.take(gone))
            at, _ = self.memory.find(distinct)
        kept = Runs(self.memory.codes, self.memory.begin[at], self.memory.end[at])
        alike = equal_runs(runs, kept.take(which))
        mixed = np.unique(np.searchsorted(bounds, begin[~alike], side="right"))
        sizes, places, pool = self.memory.sizes[at], self.memory.places[at], self.memory.pool
        per_piece = sizes[which].astype(np.int64)
        run = np.cumsum(per_piece)
        flat = pool[np.arange(run[-1]) + np.repeat(places[which] - (run - per_piece), per_piece)]
        run = np.concatenate([[0], run])
        return Ids(flat, np.concatenate([[0], run[np.searchsorted(begin, bounds)]])), mixed

    def encode(self, texts: list[str]) -> Ids:
        """The ids of all texts, one text after the other."""
        parts, sizes = [], np.zeros(len(texts), dtype=np.int64)
        for begin, end in slices(texts, SLICE):
            part = texts[begin:end]
            odd = {at for at, text in enumerate(part) if not self._plain(text)}
            quick, mixed = self._quick(["" if at in odd else text for at, text in enumerate(part)] if odd else part)
            odd.update(mixed.tolist())
            if not odd:
                parts.append(quick.flat)
                sizes[begin:end] = np.diff(quick.starts)
                continue
            slow = {at: self.library.encode(part[at], add_special_tokens=False).ids for at in odd}
            for at in range(len(part)):
                own = np.array(slow[at], dtype=np.uint32) if at in slow else quick.flat[quick.starts[at]:quick.starts[at + 1]]
                parts.append(own)
                sizes[begin + at] = len(own)
        flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint32)
        return Ids(flat.astype(np.uint32, copy=False), np.concatenate([[0], np.cumsum(sizes)]))

    def _plain(self, text: str) -> bool:
        if not self.known or (not text.isascii() or "\0" in text) and _ODD.search(text):
            return False
        if self.style == "word":  # special strings are looked for before and after lower-casing
            if "İ" in text:
                return False
            text = text.lower()
            if not text.isascii() and _ODD.search(text):  # some Latin capitals have small letters beyond
                return False
        return not any(word in text for word in self.special)


@cache
def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and process."""
    return Encoder(path)


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
