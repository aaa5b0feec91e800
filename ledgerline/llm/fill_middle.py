"""Fill-in-the-middle training texts: whole units of a text cut into prefix, middle and suffix, and put in another order.

A unit is a line with its line feed. Every batch goes through one pyarrow.compute pipeline: texts are split into lists of
units, the lists flattened with the index of their text, each unit gets its ordinal and from it its role (before the first
cut, between the cuts, after the second), units are filtered by role, put into lists again and joined, and the joined
parts are joined with the marks. Cuts and forms come from the SHA-256 of `seed:id`, so that a repeated task gives the
same rows. Outputs are taken apart again by their marks alone (`restore`), which works because a text holding a mark stays
as it is: no mark can then arise across a border, as each begins with `<` and ends with `>`.

NULL and empty texts have no units, stay plain and give the empty text. A NULL id counts as the empty string in the
digest. Equal ids give equal cut numbers, so repeated rows give repeated results; there are no ties. Very long texts are
worked on whole, in slices of their own. An empty table gives an empty one. Other columns are kept; the added ones take
the names the caller gives, and a column of the input by one of these names is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.frames import free_name, whole_text

PLAIN, PSM, SPM = "plain", "psm", "spm"
SLICE_BYTES = 1 << 26  # of text in one pass of the pipeline
ROLES = ("prefix", "middle", "suffix")


class Marks(NamedTuple):
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def _text(value: str | None) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _units(texts: pa.LargeStringArray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(units, index of each unit's text, number of units of each text)."""
    lists = pc.split_pattern(texts, "\n")
    pieces = pc.list_flatten(lists)
    parent = pc.list_parent_indices(lists)
    pieces_held = pc.list_value_length(lists).cast(pa.int64())
    last = pc.equal(_ordinals(parent, pieces_held), pc.subtract(pc.take(pieces_held, parent), 1))
    # The last piece of a text has no line feed, and is no unit where it is empty.
    units = pc.binary_join_element_wise(pieces, pc.if_else(last, _text(""), _text("\n")), _text(""))
    kept = pc.invert(pc.equal(units, ""))
    units, parent = pc.filter(units, kept), pc.filter(parent, kept)
    return units, parent, _held(parent, len(texts))


def _held(parent: pa.Array, texts: int) -> pa.Array:
    """How many units refer to each text; `parent` is in ascending order."""
    ends = pa.array(np.searchsorted(parent.to_numpy(), np.arange(texts + 1)), pa.int64())
    return pc.subtract(ends[1:], ends[:-1])


def _ordinals(parent: pa.Array, held: pa.Array) -> pa.Array:
    """The place of each unit within its text, from 0."""
    first = pc.subtract(pc.cumulative_sum(held), held)
    return pc.subtract(pa.array(np.arange(len(parent))), pc.take(first, parent))


def _joined(units: pa.Array, parent: pa.Array, texts: int) -> pa.Array:
    """The units of each text joined, the empty string where it has none."""
    ends = pc.cumulative_sum(_held(parent, texts)).cast(pa.int32())
    offsets = pa.concat_arrays([pa.array([0], pa.int32()), ends]) if texts else pa.array([0], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, units), _text(""))


def cut(texts: pa.LargeStringArray, hashes: list[pa.Array], marks: Marks, share: int, spm: int) -> dict[str, pa.Array]:
    """Units, form, parts' lengths and output of each text; `hashes` are four unsigned numbers a text."""
    units, parent, n = _units(texts)
    # Numbers below 2^32 are exact as int64; remainders by subtraction of the whole quotient.
    modulo = lambda x, by: pc.subtract(x, pc.multiply(pc.divide(x, by), by))
    ends = [modulo(hashed, pc.add(n, 1)) for hashed in hashes[:2]]
    low, high = pc.min_element_wise(*ends), pc.max_element_wise(*ends)
    ordinal = _ordinals(parent, n)
    before, after = pc.less(ordinal, pc.take(low, parent)), pc.greater_equal(ordinal, pc.take(high, parent))
    within = {"prefix": before, "suffix": after, "middle": pc.invert(pc.or_(before, after))}
    parts = {role: _joined(pc.filter(units, within[role]), pc.filter(parent, within[role]), len(texts)) for role in ROLES}

    plain = pc.equal(texts, "")
    for mark in marks:
        plain = pc.or_(plain, pc.match_substring(texts, mark))
    plain = pc.or_(plain, pc.greater_equal(modulo(hashes[2], 100), share))
    form = pc.if_else(plain, PLAIN, pc.if_else(pc.less(modulo(hashes[3], 100), spm), SPM, PSM))
    mark = [_text(text) for text in (marks.prefix, marks.suffix, marks.middle, "")]
    psm = pc.binary_join_element_wise(mark[0], parts["prefix"], mark[1], parts["suffix"], mark[2], parts["middle"], mark[3])
    spm_ = pc.binary_join_element_wise(mark[1], parts["suffix"], mark[0], parts["prefix"], mark[2], parts["middle"], mark[3])
    characters = {role: pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(parts[role]).cast(pa.int64()))
                  for role in ROLES}
    output = pc.if_else(plain, texts, pc.if_else(pc.equal(form, SPM), spm_, psm))
    return {"n": n, "form": form.cast(pa.string()), "prefix_chars": characters["prefix"],
            "middle_chars": characters["middle"], "output": output}


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(from, length) of runs of rows with about SLICE_BYTES of text."""
    begin, held = 0, 0
    for at, size in enumerate(pc.binary_length(texts).to_pylist()):
        if at > begin and held + size > SLICE_BYTES:
            yield begin, at - begin
            begin, held = at, 0
        held += size
    if begin < len(texts):
        yield begin, len(texts) - begin


def digits(key: str, seed: int) -> list[Column]:
    """The first four groups of eight hexadecimal digits of the digest of `seed:key`, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long") for group in range(4)]


def transform(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", output: str = "output", seed: int = 7, share: int = 100,
    spm: int = 50, marks: Marks = Marks(),
) -> DataFrame:
    """`docs` with n, form, prefix_chars, middle_chars and the output text.

    `share` percent of the texts that can be cut are; `spm` percent of these have the suffix in front.
    """
    added = {"n": T.LongType(), "form": T.StringType(), "prefix_chars": T.LongType(), "middle_chars": T.LongType(),
             output: T.StringType()}
    taken = {name.lower() for name in added}
    kept = [name for name in docs.columns if name.lower() not in taken or name in (key, text)]
    body = free_name(docs, "_body")
    groups = [free_name(docs, f"_group{group}") for group in range(4)]
    ready = docs.select(*kept, whole_text(text).alias(body), *(one.alias(name) for one, name in zip(digits(key, seed), groups)))
    clash = [name for name in kept if name.lower() in taken]  # the key or the text itself goes by an added name
    kept = [name for name in kept if name not in clash]
    schema = T.StructType([ready.schema[name] for name in kept] + [T.StructField(name, kind) for name, kind in added.items()])

    def worked(batches):
        for batch in batches:
            texts = batch.column(body).cast(pa.large_string())
            for begin, length in _slices(texts):
                part = batch.slice(begin, length)
                hashes = [part.column(name) for name in groups]
                made = cut(texts.slice(begin, length), hashes, marks, share, spm)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in kept), made["n"], made["form"], made["prefix_chars"],
                     made["middle_chars"], made["output"]], names=[*kept, *added])

    return ready.mapInArrow(worked, schema)


def restore(rows: DataFrame, *, output: str = "output", form: str = "form", name: str = "restored", marks: Marks = Marks()) -> DataFrame:
    """`rows` with the text that an output was made of, from the output and its form alone."""
    def after(mark: str, until: str | None) -> Column:
        begin = F.locate(mark, F.col(output)) + F.lit(len(mark))
        end = F.locate(until, F.col(output)) if until else F.length(output) + 1
        return F.col(output).substr(begin, end - begin)

    middle = after(marks.middle, None)
    psm = F.concat(after(marks.prefix, marks.suffix), middle, after(marks.suffix, marks.middle))
    spm = F.concat(after(marks.prefix, marks.middle), middle, after(marks.suffix, marks.prefix))
    return rows.withColumn(name, F.when(F.col(form) == PSM, psm).when(F.col(form) == SPM, spm).otherwise(F.col(output)))
