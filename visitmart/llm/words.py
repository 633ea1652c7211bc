"""Words of many texts at once: spans and 64-bit hashes over the bytes of an Arrow column.

A word is a run of bytes of one class, so whole batches are cut with a few passes of numpy.
UTF-8 bytes of other than ASCII letters never equal ASCII ones, so classes over bytes are
classes over code points as long as all bytes from 128 up fall into one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes that are part of a word: all but space and 09 to 0D.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes that are part of a word: ASCII digits, lower-case ASCII letters, all from 80 up.
PLAIN = np.zeros(256, bool)
PLAIN[0x30:0x3A] = PLAIN[0x61:0x7B] = PLAIN[0x80:] = True

#: Each byte with A-Z made lower-case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_ODD = 0x9E3779B97F4A7C15  # an odd multiplier has an inverse modulo 2**64
_INVERSE = pow(_ODD, -1, 1 << 64)


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit values scrambled one to one (multiply, shift, multiply, shift)."""
    out = values.astype(np.uint64)
    with np.errstate(over="ignore"):
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            out ^= out >> np.uint64(shift)
            out *= np.uint64(factor)
    return out ^ (out >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    """base ** 0, 1, 2, ... modulo 2**64."""
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each span; equal runs have equal hashes.

    Polynomial in an odd base: differences of one running sum, shifted back to power 0.
    """
    with np.errstate(over="ignore"):
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * _powers(_ODD, len(values)), out=sums[1:])
        back = _powers(_INVERSE, len(values) + 1)
        return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offset of each row; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes, and the index of each row's first word (one more at the end)."""
    of_word = inside[data]
    cut = np.zeros(len(data) + 1, bool)  # a row's end ends a word
    cut[offsets] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = of_word
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = of_word
    starts = np.flatnonzero(after & (~before | cut))
    ends = np.flatnonzero(before & (~after | cut))
    return starts, ends, np.searchsorted(starts, offsets)
