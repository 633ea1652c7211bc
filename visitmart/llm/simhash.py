"""SimHash near-dedup by segment popcounts.

Each text gets a 64-bit fingerprint: the bit majority over the XXH64 values (seed 42, as Spark's
``xxhash64`` has it) of its word shingles. Fingerprints that differ in at most ``max_bits`` bits are linked.

Candidates come from the segment-popcount embedding. A fingerprint is cut into segments of
``SEGMENT_BITS`` bits; its bit counts per segment are a point on an integer grid, and the
Manhattan distance of two points is at most the number of differing bits. The points of the two
halves of the fingerprint are used apart: of at most ``max_bits`` differing bits, one half has at
most ``reach = max_bits // 2``, so linked fingerprints have points within ``reach`` in one half.
Two grid points that close have a grid point between them, at most ceil(reach / 2) steps from the
one and floor(reach / 2) from the other. So each half point is entered into all grid cells within
those steps, and fingerprints that meet in a cell are checked exactly, bit by bit.

Equal fingerprints are one class from the start. A cell with many fingerprints is cut into
chunks; each pair of chunks is a unit of work of its own. A unit returns a spanning forest of the
links in it, never all pairs. Nothing is left out: the links' components come out whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import small_side, staged, text_rows
from visitmart.llm.components import Forest, components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEGMENT_BITS = 2
#: Fingerprints of one cell that a unit of work takes from each of two chunks.
CHUNK = 1024
#: What lies between words.
SPACES = r"[\x20\x09-\x0D]+"


def _lowered(text: Column) -> Column:
    """The text with A-Z made lower-case; where all characters are single bytes, ``lower`` does just that."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, bits) for every row of (doc_id, text); ``bits`` is the fingerprint as a signed long, 0 for a text without words.

    Shingles are hashed and their bits counted row by row in generated code; a document leaves its task as 32 longs.
    Each long counts two bits, 32 places apart, so a text may have 2**31 shingles.
    """
    words = F.array_remove(F.split(_lowered(F.coalesce("text", F.lit(""))), SPACES, -1), "")
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words.alias("words"))
    last = F.greatest(F.size("words") - shingle_words, F.lit(0))
    placed = rows.select("doc_id", "row", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    # Places after the last word are NULL, which concat_ws leaves out.
    shingle = F.concat_ws(" ", *[F.get("words", F.col("at") + n) for n in range(shingle_words)])
    hashed = placed.select("doc_id", "row", F.when(F.size("words") > 0, F.xxhash64(shingle)).alias("hash"))
    pair = F.lit((1 << 32) | 1)
    sums = [F.sum(F.shiftrightunsigned("hash", bit).bitwiseAND(pair)).alias(f"bits{bit}") for bit in range(32)]
    counted = hashed.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.count("hash").alias("n"), *sums)
    found = F.lit(0).cast("long")
    for bit in range(32):
        both = F.col(f"bits{bit}")
        for place, count in ((bit, both.bitwiseAND(F.lit((1 << 32) - 1))), (bit + 32, F.shiftrightunsigned(both, 32))):
            value = F.shiftleft(F.lit(1).cast("long"), place)
            found = found.bitwiseOR(F.when(count * 2 > F.col("n"), value).otherwise(F.lit(0).cast("long")))
    return counted.select("doc_id", found.alias("bits"))


def _ball(center: np.ndarray, steps: int, most: int) -> np.ndarray:
    """Per row of grid points, the keys (base most+1) of all grid points within so many Manhattan steps, as a matrix; -1 fills."""
    dims = center.shape[1]
    weight = (most + 1) ** np.arange(dims, dtype=np.int64)
    keys = [(center @ weight)[:, None]]
    points = [(center, keys[0], 0)]
    for _ in range(steps):
        grown = []
        for point, key, least in points:
            for d in range(least, dims):
                for step in (-1, 1):
                    moved = point[:, d] + step
                    # Along one dimension steps go one way, so that each grid point is reached once.
                    away = (moved - center[:, d]) * step > 0
                    fits = (moved >= 0) & (moved <= most) & away & (key[:, 0] >= 0)
                    to = point.copy()
                    to[:, d] = moved
                    grown.append((to, np.where(fits, key[:, 0] + step * weight[d], -1)[:, None], d))
        points = grown
        keys += [key for _, key, _ in grown]
    return np.concatenate(keys, axis=1)


def cells(bits: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(cell, index of the fingerprint) for both halves and all grid points in reach."""
    reach = max_bits // 2
    per_half = 32 // SEGMENT_BITS
    for half in (0, 1):
        word = (bits.view(np.uint64) >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        shifts = (np.arange(per_half) * SEGMENT_BITS).astype(np.uint64)
        segment = (word[:, None] >> shifts) & np.uint64((1 << SEGMENT_BITS) - 1)
        point = np.bitwise_count(segment).astype(np.int64)
        found = _ball(point, (reach + 1) // 2, SEGMENT_BITS)
        index = np.broadcast_to(np.arange(len(bits))[:, None], found.shape)
        real = found >= 0
        yield found[real] * 2 + half, index[real]


def _entered(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                bits = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
                for cell, index in cells(bits, max_bits):
                    yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bits[index])], names=["cell", "bits"])

    return run


def _near(left: np.ndarray, right: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Pairs from two arrays of fingerprints that differ in at most ``max_bits`` bits."""
    for at in range(0, len(left), 256):
        few = left[at : at + 256]
        i, j = np.nonzero(np.bitwise_count((few[:, None] ^ right[None, :]).view(np.uint64)) <= max_bits)
        yield from zip(few[i].tolist(), right[j].tolist())


def _verified(max_bits: int):
    """Rows sorted by (cell, low chunk, high chunk, chunk): each unit is checked exactly and gives its forest."""

    def unit(bits: np.ndarray, chunk: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
        forest, out = Forest(), []
        sides = (bits[chunk == low], bits[chunk == high]) if low != high else (bits, bits)
        for a, b in _near(*sides, max_bits):
            if a != b and forest.union(a, b):
                out.append((a, b))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5)])
            rows = rows if held is None else np.concatenate([held, rows])
            if not len(rows):
                continue
            change = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            held = rows[change[-1] if len(change) else 0 :]
            yield from done(rows[: len(rows) - len(held)])
        if held is not None:
            yield from done(held)

    def done(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Units of a few rows are checked all at once, by the distance of their rows; large ones one by one."""
        if not len(rows):
            return
        change = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        starts = np.concatenate([[0], change])
        sizes = np.diff(np.concatenate([starts, [len(rows)]]))
        unit_of = np.repeat(np.arange(len(starts)), sizes)
        pairs: list[tuple[int, int]] = []
        small = (sizes <= 32)[unit_of]
        for lag in range(1, 32):
            if lag >= len(rows) or not (sizes[sizes <= 32] > lag).any():
                break
            both = np.flatnonzero((unit_of[lag:] == unit_of[:-lag]) & small[lag:])
            a, b = rows[both, 4], rows[both + lag, 4]
            near = np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits
            pairs += [(x, y) for x, y in zip(a[near].tolist(), b[near].tolist()) if x != y]
        for at, size in zip(starts[sizes > 32].tolist(), sizes[sizes > 32].tolist()):
            own = rows[at : at + size]
            pairs += unit(own[:, 4], own[:, 3], int(own[0, 1]), int(own[0, 2]))
        if pairs:
            a, b = zip(*pairs)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def linked_fingerprints(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (``bits``): a spanning forest of all pairs within ``max_bits``, or more."""
    # Few bytes become many: dealt over all tasks before they are entered, a number that adaptive execution leaves alone.
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = distinct.select("bits").repartition(parts, "bits").mapInArrow(_entered(max_bits), "cell long, bits long")
    crowded = entries.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > CHUNK)
    crowded = small_side(staged(crowded, "simhash_crowded"), 16)
    entries = entries.join(crowded, "cell", "left")
    chunks = F.coalesce(F.ceil(F.col("n") / CHUNK), F.lit(1)).cast("long")
    own = F.when(chunks > 1, F.pmod(F.xxhash64("bits"), chunks)).otherwise(F.lit(0).cast("long"))
    # A chunk meets every chunk of its cell, itself included, once.
    units = entries.select(
        "cell", "bits", own.alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("other")
    ).select("cell", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "bits")
    sorted_units = units.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high", "chunk", "bits")
    return sorted_units.mapInArrow(_verified(max_bits), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_class) for every row.

    ``fingerprint``: 16 lower-case hex digits. ``component_id``: the smallest id that is reached
    by links from the row, its own included; ids of null reach others but are never the smallest,
    and a component of null ids only has null. ``n_class``: rows with the same fingerprint.
    Null texts, empty texts and texts without words have fingerprint zero and are linked like
    others. Shorter texts than a shingle are one shingle. Rows repeated in full are returned as
    often. No rows in, no rows out.
    """
    found = staged(fingerprints(text_rows(docs, id_col, text_col), shingle_words), "simhash_prints")
    classes = found.groupBy("bits").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_class"))
    classes = staged(classes, "simhash_classes")
    reached = components(linked_fingerprints(classes, max_bits))
    joined = classes.join(reached.withColumnRenamed("node", "bits"), "bits", "left")
    joined = joined.withColumn("component", F.coalesce("component", "bits"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = staged(joined.join(least, "component").select("bits", "component_id", "n_class"), "simhash_labels")
    return found.join(labelled, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id", "n_class"
    )
