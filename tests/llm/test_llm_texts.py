"""The helpers that work on many texts at once, against one text at a time."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from ledgerline.llm import id_coder
from ledgerline.llm.id_files import joined_crc32
from ledgerline.llm.token_ids import encoder, vocabulary
from ledgerline.llm.words import numbers_of, shingle_numbers, shingles_of, words_of

ODD = [
    "", "  ", " a  b\n\n c\n", "it's don't x's  's ''s 'll've\n's \t're", "<|endoftext|> hi", "日本 x", "İx", "A 12³ ½ x_y--z 's",
    "a\x85b\xa0c", "\x1c\x1d a\x1f", "x'S 'S'T", "I'm'd'df 12's 3'sx \n\n'ses", "a\0b", "q" * 70_000 + " z", "é x", "ǅ Ǆ ª º µ",
    "<|EndOfText|>", "a\u0301 e", "\ud800 lone".encode("utf-16", "surrogatepass").decode("utf-16", "replace"),
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_the_librarys(name):
    held = encoder(vocabulary(name))
    assert held.known
    found = held.encode(ODD * 2)
    for at, text in enumerate(ODD * 2):
        assert found.flat[found.starts[at]:found.starts[at + 1]].tolist() == held.library.encode(text, add_special_tokens=False).ids


SMALL_FORM_BEYOND = "ƁƆƉƊƏƐƓƔƖƗƜƝƟƦƩƮƱƲƷȺȾɄɅ"


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_all_latin_characters(name):
    """Every code point below U+0250, alone, in a word and in random company, mixed in one call."""
    held = encoder(vocabulary(name))
    chance = random.Random(6)
    texts = [text for code in range(0x250) for text in (chr(code), f"ab{chr(code)}cd {chr(code)}")]
    texts += [f"{sign}li {sign.lower()}" for sign in SMALL_FORM_BEYOND] + ["Əliyev gəldi", "Əli İ"]
    texts += ["".join(chr(chance.randrange(0x250)) if chance.random() < 0.5 else chance.choice(" ab'1.\n") for _ in range(chance.randrange(1, 30)))
              for _ in range(3_000)]
    found = held.encode(texts)
    for at, text in enumerate(texts):
        assert found.flat[found.starts[at]:found.starts[at + 1]].tolist() == held.library.encode(text, add_special_tokens=False).ids, text


def colliding(size, one="a", other="b"):
    """The word of Thue and Morse and its complement: polynomials modulo a power of two cannot tell them apart."""
    signs = [bin(at).count("1") % 2 for at in range(size)]
    return "".join((one, other)[sign] for sign in signs), "".join((other, one)[sign] for sign in signs)


@pytest.mark.parametrize("size", [1_024, 2_048, 4_096])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_colliding_pieces(name, size):
    one, other = colliding(size)
    assert len(set(words_of([one, other]).hashes.tolist())) == 1
    held = encoder(vocabulary(name))
    for texts in ([one, other], [f"x {other} y", one], [other, one, f"{one} {other}", "plain"]):
        found = held.encode(texts)
        for at, text in enumerate(texts):
            assert found.flat[found.starts[at]:found.starts[at + 1]].tolist() == held.library.encode(text, add_special_tokens=False).ids


def test_numbers_of_words_and_shingles():
    """Equal numbers for equal words and shingles and for no others, colliding words and short texts included."""
    chance = random.Random(9)
    pool = [*colliding(1_024), "a", "b", "é", "C3"]
    texts = [" ".join(chance.choice(pool) for _ in range(chance.randrange(0, 9))) + "." for _ in range(300)] + ["", " !", "a b", "a b"]
    held = numbers_of(texts)
    plain = [re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower()) for text in texts]
    flat = [word for words in plain for word in words]
    assert len({(word, number) for word, number in zip(flat, held.hashes.tolist())}) == len(set(flat)) == len(set(held.hashes.tolist()))
    grams = shingle_numbers(held)
    wanted = [tuple(words[at:at + 5]) for words in plain for at in range(max(1, len(words) - 4)) if words]
    assert len(wanted) == len(grams.hashes)
    assert len(set(zip(wanted, grams.hashes.tolist()))) == len(set(wanted)) == len(set(grams.hashes.tolist()))
    assert np.diff(grams.starts).tolist() == [max(1, len(words) - 4) if words else 0 for words in plain]


def test_words_and_shingles():
    texts = ["", "One two, three-four é4 FIVE six", "a b", "x" * 70_000 + " hi", " .. "]
    held = words_of(texts)
    grams = shingles_of(held)
    seen = {}
    for at, text in enumerate(texts):
        plain = re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())
        hashes = held.hashes[held.starts[at]:held.starts[at + 1]].tolist()
        assert len(hashes) == len(plain) and all(seen.setdefault(word, one) == one for word, one in zip(plain, hashes))
        assert grams.starts[at + 1] - grams.starts[at] == (max(1, len(plain) - 4) if plain else 0)
    assert len(set(seen.values())) == len(seen)


def test_coder_round_trip():
    chance = np.random.default_rng(5)
    blocks = [chance.integers(0, 65_536, 700), np.full(600, 65_535), np.arange(500) % 7, chance.zipf(1.3, 300) % 49_408, [3], []]
    blocks = [np.array(block, dtype=np.uint32) for block in blocks]
    coded = id_coder.encode(blocks)
    assert all((a == b).all() for a, b in zip(blocks, id_coder.decode(coded, [len(block) for block in blocks])))
    assert len(coded[1]) < 600 / 2 and id_coder.encode([]) == id_coder.decode([], []) == []
    with pytest.raises(ValueError):
        id_coder.encode(blocks[::-1])


def test_coder_adapts_through_whole_blocks():
    """Ids that change half-way through a block, and low bytes that depend on the high one, cost few bytes an id."""
    chance = np.random.default_rng(3)
    half = id_coder.BLOCK // 2
    late = [np.concatenate([chance.integers(0, 16, half), chance.integers(9_000, 9_016, half)]).astype(np.uint16) for _ in range(64)]
    known = [(256 * high + 16 * high + chance.integers(0, 16, 2 * half)).astype(np.uint16)
             for high in chance.integers(0, 4, (64, 2 * half))]
    sizes = []
    for blocks in (late, known):
        payloads = id_coder.encode(blocks)
        assert all((a == b).all() for a, b in zip(blocks, id_coder.decode(payloads, [len(block) for block in blocks])))
        sizes.append(sum(map(len, payloads)) / sum(map(len, blocks)))
    assert sizes[0] < 1.1 and sizes[1] < 0.9, sizes


def test_crc32_of_parts():
    parts = [b"", b"a", bytes(range(256)) * 33, b"\0\0\0"]
    assert joined_crc32([(zlib.crc32(part), len(part)) for part in parts]) == zlib.crc32(b"".join(parts))
