"""Fill-in-middle by piece tables.

A document is a table of descriptors (buffer, start, length) over two buffers that never change:
the bytes of the texts of a pass and the sentinels. Cutting splits a descriptor, an arrangement
permutes descriptors, its inverse restores them; text is copied once, when it is written out, and
hashes take the descriptors one after the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitmart.llm.common import arrow_map
from visitmart.llm.words import column_bytes

#: Marks before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of 100 documents so many stay plain, and of 100 others so many have the suffix first.
PLAIN_PERCENT = 10
SPM_PERCENT = 20

TEXT, MARKS = 0, 1
# Descriptors of a cut document: prefix, middle, suffix, and the three sentinels.
ARRANGEMENTS = {"psm": (3, 0, 4, 2, 5, 1), "spm": (4, 2, 3, 0, 5, 1)}

Piece = tuple[int, int, int]

LETTER = np.zeros(256, bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True


def cut(table: list[Piece], which: int, at: int) -> list[Piece]:
    """The table with one descriptor split after ``at`` bytes; either part may be empty."""
    buffer, start, length = table[which]
    return [*table[:which], (buffer, start, at), (buffer, start + at, length - at), *table[which + 1 :]]


def arrange(table: list[Piece], order: tuple[int, ...]) -> list[Piece]:
    return [table[at] for at in order]


def inverse(order: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(order.index(at) for at in range(len(order)))


def stream(table: list[Piece], buffers: tuple[memoryview, memoryview]) -> Iterator[memoryview]:
    for buffer, start, length in table:
        yield buffers[buffer][start : start + length]


def written(table: list[Piece], buffers: tuple[memoryview, memoryview]) -> tuple[bytes, str]:
    """The table's bytes and their SHA-256, which reads the descriptors and not the copy."""
    digest = hashlib.sha256()
    for view in stream(table, buffers):
        digest.update(view)
    return b"".join(stream(table, buffers)), digest.hexdigest()


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each unit (a run of ASCII letters, or one other code point), and the index of each row's first (one more at the end)."""
    letter = LETTER[data]
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    rows = offsets[offsets < len(data)]
    begins[rows] = True
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


def _checked(sentinels: tuple[str, str, str]) -> tuple[bytes, list[Piece]]:
    """The buffer of the sentinels and their descriptors; raises if a place of one could be taken for another."""
    marks = [mark.encode() for mark in sentinels]
    for at, one in enumerate(marks):
        for to, other in enumerate(marks):
            shared = any(one[-n:] == other[:n] for n in range(1, min(len(one), len(other)) + (at != to)))
            if not one or shared or (at != to and one in other):
                raise ValueError("sentinels must not be empty, hold one another or end as one begins")
    starts = np.cumsum([0, *map(len, marks)]).tolist()
    return b"".join(marks), [(MARKS, start, len(mark)) for start, mark in zip(starts, marks)]


def _strings(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentinels: tuple[str, str, str] = SENTINELS,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
    seed: int = 1,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, pieces, output, output_sha256), a row for each row given.

    ``n`` counts the text's units: runs of ASCII letters, and every other code point. Two hashes of
    seed and id choose two of the n + 1 places between units; prefix, middle and suffix are what
    lies before, between and after. ``form`` is ``plain`` (the text as it is), ``psm`` or ``spm``;
    ``pieces`` are the output's descriptors (0 is the text, 1 the sentinels one after the other;
    bytes); the chars are code points, NULL for plain.

    A null text is an empty one; empty texts and texts with a sentinel stay plain. Ids may be of any
    type that casts to text; a null id is hashed as empty text. Rows that share an id are cut by the
    same hashes; rows repeated in full give equal rows. Bytes that are no UTF-8 become U+FFFD.
    No rows in, no rows out.
    """
    buffer, marks = _checked(sentinels)
    needles = [mark.encode() for mark in sentinels]

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    numbers = [F.conv(F.substring(digest, 8 * at + 1, 8), 16, 10).cast("long").alias(f"h{at + 1}") for at in range(4)]
    text = F.make_valid_utf8(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), *numbers)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = column_bytes(batch.column("text"))
        starts, first = units(data, offsets)
        n = np.diff(first)
        h1, h2, h3, h4 = (batch.column(f"h{at}").to_numpy(zero_copy_only=False) for at in (1, 2, 3, 4))
        places = np.append(starts, len(data))
        low, high = np.minimum(h1 % (n + 1), h2 % (n + 1)), np.maximum(h1 % (n + 1), h2 % (n + 1))
        # The place after all of a row's units is the row's end, also where the next row starts later.
        after = [np.where(k == n, offsets[1:], places[first[:-1] + k]) - offsets[:-1] for k in (low, high)]
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        whole = data.tobytes()
        buffers = memoryview(whole), memoryview(buffer)
        forms, prefixes, middles, tables, texts, digests = [], [], [], [], [], []
        for row, (start, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            table: list[Piece] = [(TEXT, start, end - start)]
            marked = any(whole.find(needle, start, end) >= 0 for needle in needles)
            if start == end or marked or h3[row] % 100 >= 100 - plain_percent:
                form, prefix, middle = "plain", None, None
            else:
                form = "spm" if h4[row] % 100 < spm_percent else "psm"
                one, two = int(after[0][row]), int(after[1][row])
                prefix = int(chars[start + one] - chars[start])
                middle = int(chars[start + two] - chars[start + one])
                table = cut(cut(table, 0, one), 1, two - one)
                table = arrange([*table, *marks], ARRANGEMENTS[form])
            text, digest = written(table, buffers)
            forms.append(form)
            prefixes.append(prefix)
            middles.append(middle)
            tables.append([{"buffer": b, "start": s - start * (b == TEXT), "length": m} for b, s, m in table])
            texts.append(text)
            digests.append(digest)
        kind = pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n, pa.int64()),
                pa.array(forms, pa.string()),
                pa.array(prefixes, pa.int64()),
                pa.array(middles, pa.int64()),
                pa.array(tables, pa.list_(kind)),
                _strings(texts),
                pa.array(digests, pa.string()),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "pieces", "output", "output_sha256"],
        )

    pieces = "pieces array<struct<buffer: int, start: bigint, length: bigint>>"
    schema = f"n long, form string, prefix_chars long, middle_chars long, {pieces}, output string, output_sha256 string"
    return arrow_map(rows, work, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {schema}")


def restore(
    made: DataFrame, output_col: str = "output", form_col: str = "form", sentinels: tuple[str, str, str] = SENTINELS
) -> DataFrame:
    """The frame's columns with ``restored`` and ``restored_sha256``, rebuilt from output and form alone.

    The sentinels' places cut the output into descriptors, and the inverse of the form's permutation
    puts them back. A null output, a form that is not known and an output that lacks one of its
    sentinels give NULL in both columns. Columns that are called so already are replaced.
    """
    _checked(sentinels)
    needles = [mark.encode() for mark in sentinels]
    others = [c for c in made.columns if c not in ("restored", "restored_sha256")]

    def restored(whole: bytes, start: int, end: int, form: str) -> list[Piece] | None:
        table: list[Piece] = [(TEXT, start, end - start)]
        if form == "plain":
            return table
        if form not in ARRANGEMENTS:
            return None
        order = ARRANGEMENTS[form]
        for mark in (at - 3 for at in order if at >= 3):
            _, begin, length = table[-1]
            found = whole.find(needles[mark], begin, begin + length)
            if found < 0:
                return None
            table = cut(table, len(table) - 1, found - begin)
            table = cut(table, len(table) - 1, len(needles[mark]))
        if table[0][2]:
            return None  # something stands before the first sentinel
        return arrange(table[1:], inverse(order))[:3]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = column_bytes(batch.column(output_col))
        whole = data.tobytes()
        buffers = memoryview(whole), memoryview(b"")
        known = batch.column(output_col).is_valid().to_pylist()
        texts, digests = [], []
        spans = zip(offsets[:-1].tolist(), offsets[1:].tolist(), batch.column(form_col).to_pylist(), known)
        for start, end, form, valid in spans:
            table = restored(whole, start, end, form) if valid else None
            text, digest = (None, None) if table is None else written(table, buffers)
            texts.append(text)
            digests.append(digest)
        columns = [batch.column(c) for c in others]
        return pa.RecordBatch.from_arrays(
            [*columns, _strings(texts), pa.array(digests, pa.string())], names=[*others, "restored", "restored_sha256"]
        )

    valid = F.make_valid_utf8(F.col(f"`{output_col}`"))
    rows = made.select(*[valid.alias(c) if c == output_col else F.col(f"`{c}`") for c in others])
    schema = StructType([*rows.schema.fields]).add("restored", "string").add("restored_sha256", "string")
    return arrow_map(rows, work, schema, output_col)
