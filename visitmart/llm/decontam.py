"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of ``WINDOW`` words (a shorter item is one window), a window
is the set of its word shingles. A document holds a window only if it holds all its shingles, so
one shingle is enough to find candidates: the prefix of each window, its rarest shingle by the
number of documents that hold it. Windows with a shingle that no document holds are out at once.
A prefix found in a document fixes where the window would start; the length bound asks for as
many words from there on. What passes is checked word by word.

Documents are read twice at any size of the benchmark: once for the counts of shingles, which are
over all documents, and once for the windows. A benchmark of up to ``BLOCK_PAIRS`` (window, item)
pairs is sent to the executors, and documents are streamed past it. A larger one stays a table, the
prefix index. Of it only two bit filters of bounded size are sent, one of the prefixes and one of
the whole windows; runs of words that pass both are written out as text and joined with the index,
which is the exact check.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitmart.llm.common import SMALL_SIDE_BYTES, arrow_map, passes, small_side, staged, text_rows, unused, valid_text
from visitmart.llm.words import LOWER, PLAIN, column_bytes, run_hashes, word_spans

WINDOW = 10
SHINGLE = 5
#: (window, item) pairs up to which the benchmark is sent to the executors, if its windows take ``SMALL_SIDE_BYTES`` at most.
BLOCK_PAIRS = 100_000
#: Bits of a filter per entry, and the power of two of bits that no filter exceeds (16 MB).
FILTER_BITS = 16
FILTER_POWER = 27
#: Documents that hold a prefix per copy of its windows in the index; windows of frequent prefixes are repeated.
SPREAD = 10_000
#: Runs of words that leave a pass in one batch.
OUT_ROWS = 20_000


@dataclass
class Batch:
    """The words of a batch of texts: bytes (lower-cased), spans, hashes, and each row's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Batch:
        data, offsets = column_bytes(column)
        data = LOWER[data]
        starts, ends, first = word_spans(data, offsets, PLAIN)
        return cls(data, starts, ends, first, run_hashes(data, starts, ends))

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, low: int, high: int) -> bytes:
        """Words low..high-1 joined by a space."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.starts[low:high], self.ends[low:high]))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of all runs of ``size`` words that lie in one row."""
        at = np.arange(len(self.starts))
        at = at[at + size <= np.repeat(self.first[1:], np.diff(self.first))]
        return at, run_hashes(self.hashes, at, at + size)


def valid(column: pa.Array) -> pa.Array:
    """The column with U+FFFD for bytes that are no UTF-8."""
    texts = column.cast(pa.binary())
    try:
        return texts.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([None if text is None else text.decode("utf-8", "replace") for text in texts.to_pylist()], pa.string())


def item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item_id, window): the distinct windows of each item as words joined by a space."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Batch.of(batch.column("text"))
        ids, found = [], []
        for row, item in enumerate(batch.column("doc_id").to_pylist()):
            low, high = int(words.first[row]), int(words.first[row + 1])
            size = min(window, high - low)
            some = {words.text(at, at + size).decode("utf-8", "replace") for at in range(low, high - size + 1)} if size else ()
            ids += [item] * len(some)
            found += some
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.string())], names=["item_id", "window"])

    return arrow_map(text_rows(benchmark, id_col, text_col), work, "item_id long, window string").distinct()


class Block:
    """Windows of a benchmark that fits the executors, with their items, shingles and, once counts are known, prefixes."""

    def __init__(self, pairs: list[tuple[int | None, str]]) -> None:
        texts = sorted({window for _, window in pairs})
        number = {window: n for n, window in enumerate(texts)}
        words = Batch.of(pa.array(texts, pa.string()))
        self.texts = [t.encode() for t in texts]
        self.length = np.diff(words.first)
        self.hash = run_hashes(words.hashes, words.first[:-1], words.first[1:])
        listed = sorted({(number[window], item) for item, window in pairs if item is not None})
        self.item_of = np.array([item for _, item in listed], np.int64)
        self.item_from = np.searchsorted([n for n, _ in listed], np.arange(len(texts) + 1))
        # Shingles as rows (window, offset, size, hash)
        size = np.minimum(SHINGLE, self.length)
        count = self.length - size + 1
        self.window = np.repeat(np.arange(len(texts)), count)
        self.offset = np.concatenate([np.arange(c) for c in count]) if len(count) else np.zeros(0, int)
        self.size = size[self.window] if len(texts) else np.zeros(0, int)
        at = words.first[:-1][self.window] + self.offset if len(texts) else np.zeros(0, int)
        self.shingle = run_hashes(words.hashes, at, at + self.size)
        self.known = {int(s): np.unique(self.shingle[self.size == s]) for s in np.unique(self.size)}
        self.prefix: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def found(self, words: Batch, sets: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, positions, index into the sorted set) of the shingles of ``words`` that are in the sets."""
        for size, known in sets.items():
            at, hashes = words.shingles(size)
            index = np.searchsorted(known, hashes)
            index[index == len(known)] = 0
            hit = known[index] == hashes if len(known) else np.zeros(len(at), bool)
            yield size, at[hit], index[hit]

    def order(self, counts: dict[tuple[int, int], int]) -> None:
        """Sets the prefix of each window from document counts by (size, signed shingle hash)."""
        rarity = np.array(
            [counts.get((s, h), 0) for s, h in zip(self.size.tolist(), self.shingle.view(np.int64).tolist())], np.int64
        )
        best = np.lexsort((self.offset, self.shingle, rarity, self.window))
        first = np.searchsorted(self.window[best], np.arange(len(self.texts)))
        chosen = best[first] if len(best) else best
        chosen = chosen[rarity[chosen] > 0]
        for size in np.unique(self.size[chosen]).tolist():
            own = chosen[self.size[chosen] == size]
            own = own[np.argsort(self.shingle[own], kind="stable")]
            known, start = np.unique(self.shingle[own], return_index=True)
            self.prefix[size] = (known, np.append(start, len(own)), own)

    def hits(self, words: Batch) -> tuple[np.ndarray, np.ndarray]:
        """(window, position of its first word) of every occurrence in the batch."""
        row_of, found = words.rows(), [(np.zeros(0, int), np.zeros(0, int))]
        for size, at, index in self.found(words, {s: p[0] for s, p in self.prefix.items()}):
            _, start, own = self.prefix[size]
            each = start[index + 1] - start[index]
            place = np.repeat(np.cumsum(each) - each, each)
            chosen = own[np.repeat(start[index], each) + np.arange(each.sum()) - place]
            position = np.repeat(at, each)
            low = position - self.offset[chosen]
            window = self.window[chosen]
            high = low + self.length[window]
            row = row_of[position] if len(position) else position
            fits = (low >= words.first[row]) & (high <= words.first[row + 1])
            low, high, window = low[fits], high[fits], window[fits]
            same = run_hashes(words.hashes, low, high) == self.hash[window]
            low, high, window = low[same], high[same], window[same]
            exact = [words.text(a, b) == self.texts[w] for a, b, w in zip(low.tolist(), high.tolist(), window.tolist())]
            exact = np.array(exact, bool)
            found.append((window[exact], low[exact]))
        return np.concatenate([w for w, _ in found]), np.concatenate([a for _, a in found])


def _counted(rows: DataFrame, block: Block) -> dict[tuple[int, int], int]:
    """Rows that hold each shingle of the benchmark, by (size, hash); one number per shingle comes back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {size: np.zeros(len(known), np.int64) for size, known in block.known.items()}
        for batch in passes(batches):
            words = Batch.of(batch.column("text"))
            row_of = words.rows()
            for size, at, index in block.found(words, block.known):
                pairs = np.unique(row_of[at] * len(block.known[size]) + index) if len(at) else at
                totals[size] += np.bincount(pairs % max(1, len(block.known[size])), minlength=len(totals[size]))
        for size, total in totals.items():
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "size": pa.array(np.full(len(some), size), pa.int64()),
                    "hash": pa.array(block.known[size][some].view(np.int64), pa.int64()),
                    "n": pa.array(total[some], pa.int64()),
                }
            )

    summed = rows.select("text").mapInArrow(run, "size long, hash long, n long").groupBy("size", "hash")
    return {(size, value): n for size, value, n in summed.agg(F.sum("n").alias("n")).collect()}


def _windows(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_pairs: int) -> tuple[DataFrame, bool]:
    """The written (item_id, window) pairs, and whether they are few enough to be sent to the executors."""
    pairs = staged(item_windows(benchmark, id_col, text_col, window), "benchmark_windows")
    number, size = pairs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    return pairs, number <= block_pairs and size <= SMALL_SIDE_BYTES


def _block(docs: DataFrame, pairs: DataFrame) -> Block:
    """The benchmark with prefixes ordered by the documents' counts."""
    block = Block([(row.item_id, row.window) for row in pairs.collect()])
    block.order(_counted(docs, block))
    return block


class Filter:
    """A bit per leading part of a 64-bit hash: no entry is missed, others pass now and then. At most 16 MB."""

    def __init__(self, hashes: DataFrame, column: str) -> None:
        """Bits are gathered by Spark; one number per 64 bits comes to the driver."""
        number = hashes.count()
        self.power = min(FILTER_POWER, max(10, (number * FILTER_BITS).bit_length()))
        slot = F.shiftrightunsigned(F.col(column), 64 - self.power)
        words = hashes.select(F.shiftright(slot, 6).alias("word"), F.pmod(slot, F.lit(64)).cast("int").alias("bit"))
        words = words.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))
        self.words = np.zeros(1 << (self.power - 6), np.int64)
        for word, bits in words.toLocalIterator():
            self.words[word] = bits

    def passed(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes may be entries."""
        slot = hashes >> np.uint64(64 - self.power)
        words = self.words.view(np.uint64)[(slot >> np.uint64(6)).astype(np.int64)]
        return (words >> (slot & np.uint64(63))) & np.uint64(1) != 0


def _window_shingles(pairs: DataFrame) -> DataFrame:
    """(window, whole, length, offset, size, hash): the shingles of each distinct window; ``whole`` is the window's own hash."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Batch.of(batch.column("window"))
        length = np.diff(words.first)
        count = length - np.minimum(SHINGLE, length) + 1
        window = np.repeat(np.arange(len(length)), count)
        offset = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        size = np.minimum(SHINGLE, length)[window]
        at = words.first[:-1][window] + offset
        whole = run_hashes(words.hashes, words.first[:-1], words.first[1:])[window]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("window").take(pa.array(window)),
                pa.array(whole.view(np.int64)),
                pa.array(length[window]),
                pa.array(offset),
                pa.array(size),
                pa.array(run_hashes(words.hashes, at, at + size).view(np.int64)),
            ],
            names=["window", "whole", "length", "offset", "size", "hash"],
        )

    schema = "window string, whole long, length long, offset long, size long, hash long"
    return arrow_map(pairs.select("window").distinct(), work, schema, "window")


def prefix_index(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(window, whole, length, offset, size, hash, n): the prefix of each window that documents may hold.

    The prefix is the window's shingle in the fewest documents; ``n`` is their number.
    """
    shingles = staged(_window_shingles(pairs), "benchmark_shingles")
    known = Filter(shingles.select("size", "hash").distinct(), "hash")
    sizes = [row.size for row in shingles.select("size").distinct().collect()]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Batch.of(batch.column("text"))
        row_of, out = words.rows(), [(np.zeros(0, np.uint64), np.zeros(0, int), 0)]
        for size in sizes:
            at, hashes = words.shingles(size)
            some = known.passed(hashes)
            at, hashes = at[some], hashes[some]
            best = np.lexsort((row_of[at], hashes))
            hashes, row = hashes[best], row_of[at][best]
            new = np.ones(len(hashes), bool)  # a row counts once
            new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
            each, n = np.unique(hashes[new], return_counts=True)
            out.append((each, n, size))
        return pa.RecordBatch.from_pydict(
            {
                "size": pa.array(np.concatenate([np.full(len(h), s) for h, _, s in out]), pa.int64()),
                "hash": pa.array(np.concatenate([h for h, _, _ in out]).view(np.int64)),
                "n": pa.array(np.concatenate([n for _, n, _ in out]), pa.int64()),
            }
        )

    counts = arrow_map(docs.select("text"), work, "size long, hash long, n long").groupBy("size", "hash").agg(F.sum("n").alias("n"))
    counts = staged(counts.join(shingles.select("size", "hash").distinct(), ["size", "hash"], "left_semi"), "benchmark_counts")
    # A window with a shingle that no document holds has that one as its rarest.
    rated = shingles.join(small_side(counts, 32), ["size", "hash"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = rated.groupBy("window").agg(F.min(F.struct("n", "hash", "offset", "size", "length", "whole")).alias("least"))
    return staged(rarest.where("least.n > 0").select("window", "least.*"), "benchmark_prefixes")


RUNS = "doc_id long, text_key long, n_words long, low long, length long, window string"


def _runs(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Runs of words that may be windows of the index, by text, and for each row one row without a run that has its number of words."""
    prefixes = Filter(index.select("hash").distinct(), "hash")
    wholes = Filter(index.select("whole").distinct(), "whole")
    shapes: dict[int, list[tuple[int, int]]] = {}
    for size, offset, length in sorted(index.select("size", "offset", "length").distinct().collect()):
        shapes.setdefault(size, []).append((offset, length))

    def found(words: Batch) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(rows, first words, length) of the runs that pass both filters."""
        row_of = words.rows()
        for size, places in shapes.items():
            at, hashes = words.shingles(size)
            at = at[prefixes.passed(hashes)]
            row = row_of[at]
            for offset, length in places:
                low = at - offset
                fits = (low >= words.first[row]) & (low + length <= words.first[row + 1])
                own, low = row[fits], low[fits]
                some = wholes.passed(run_hashes(words.hashes, low, low + length))
                yield own[some], low[some], length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches):
            words = Batch.of(batch.column("text"))
            doc_id, key = batch.column("doc_id"), batch.column("text_key")
            none = pa.nulls(batch.num_rows, pa.int64())
            n_words = pa.array(np.diff(words.first), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [doc_id, key, n_words, none, none, none.cast(pa.string())], names=["doc_id", "text_key", "n_words", "low", "length", "window"]
            )
            for row, low, length in found(words):
                for at in range(0, len(row), OUT_ROWS):
                    own, start = row[at : at + OUT_ROWS], low[at : at + OUT_ROWS]
                    texts = [words.text(a, a + length).decode("utf-8", "replace") for a in start.tolist()]
                    taken = pa.array(own)
                    yield pa.RecordBatch.from_arrays(
                        [
                            doc_id.take(taken),
                            key.take(taken),
                            pa.nulls(len(own), pa.int64()),
                            pa.array(start - words.first[own], pa.int64()),
                            pa.array(np.full(len(own), length), pa.int64()),
                            pa.array(texts, pa.string()),
                        ],
                        names=["doc_id", "text_key", "n_words", "low", "length", "window"],
                    )

    return rows.select("doc_id", "text_key", "text").mapInArrow(run, RUNS)


def _occurrences(runs: DataFrame, index: DataFrame) -> DataFrame:
    """The runs that are windows of the index. Windows of frequent prefixes are repeated and their runs dealt over the copies."""
    copies = index.select("window", F.ceil(F.col("n") / SPREAD).alias("copies"))
    frequent = small_side(staged(copies.where("copies > 1"), "benchmark_frequent"), 200)
    copy = F.pmod(F.xxhash64("doc_id", "text_key", "low"), F.coalesce("copies", F.lit(1)))
    dealt = runs.where("low IS NOT NULL").join(frequent, "window", "left").withColumn("copy", copy).drop("copies", "n_words")
    sent = copies.select("window", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    return dealt.join(sent, ["window", "copy"]).drop("copy")


def _hits(rows: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs, occurrences) of a benchmark that stays a table; ``rows`` are (doc_id, text_key, text)."""
    index = prefix_index(rows, pairs)
    runs = staged(_runs(rows, index), "benchmark_runs")
    return runs, staged(_occurrences(runs, index), "benchmark_hits")


def _joined_spans(hits: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans): overlapping and touching occurrences of a row as one span, by a sort per row."""
    own = Window.partitionBy("doc_id", "text_key").orderBy("low")
    ends = hits.groupBy("doc_id", "text_key", "low").agg(F.max(F.col("low") + F.col("length")).alias("high"))
    reached = F.max("high").over(own.rowsBetween(Window.unboundedPreceding, -1))
    marked = ends.withColumn("new", F.when(F.col("low") <= reached, 0).otherwise(1)).withColumn("span", F.sum("new").over(own))
    spans = marked.groupBy("doc_id", "text_key", "span").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    listed = spans.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(F.array("low", "high"))).alias("spans"))
    return listed.withColumn("spans", F.flatten("spans"))


def _indexed(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The columns of ``FOUND`` for every row, by the prefix index."""
    runs, hits = _hits(rows, pairs)
    held = hits.select("doc_id", "text_key", "window").distinct().join(pairs.where("item_id IS NOT NULL"), "window")
    items = held.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))

    def meets(left: str, right: str) -> Column:
        return F.expr(f"{left}.doc_id <=> {right}.doc_id AND {left}.text_key = {right}.text_key")

    none = F.array().cast("array<long>")
    # Rows repeated in full have one key, which all of them find.
    found = _joined_spans(hits).alias("s").join(items.alias("i"), meets("s", "i"), "left").select("s.*", "i.items")
    every = runs.where("low IS NULL").select("doc_id", "text_key", "n_words")
    return every.alias("e").join(found.alias("f"), meets("e", "f"), "left").select(
        "e.*", F.coalesce("f.spans", none).alias("spans"), F.coalesce("f.items", none).alias("items")
    )


def _spans(marks: np.ndarray, low: int, high: int) -> list[int]:
    """Covered runs of words low..high-1 as a flat list start, end, start, end, ... counted from low."""
    covered = np.concatenate([[False], marks[low:high], [False]])
    return np.flatnonzero(covered[1:] != covered[:-1]).tolist()


FOUND = "doc_id long, text_key long, n_words long, spans array<long>, items array<long>"


def _matches(rows: DataFrame, block: Block) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = Batch.of(batch.column("text"))
        window, low = block.hits(words)
        delta = np.zeros(len(words.starts) + 1, np.int64)
        np.add.at(delta, low, 1)
        np.add.at(delta, low + block.length[window], -1)
        marks = np.cumsum(delta)[:-1] > 0
        row_of = words.rows()
        items: dict[int, set[int]] = {}
        spans: dict[int, list[int]] = {}
        for row, w in {(r, w) for r, w in zip(row_of[low].tolist() if len(low) else [], window.tolist())}:
            own = block.item_of[block.item_from[w] : block.item_from[w + 1]]
            items.setdefault(row, set()).update(own.tolist())
            if row not in spans:
                spans[row] = _spans(marks, int(words.first[row]), int(words.first[row + 1]))
        every = range(batch.num_rows)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_key"),
                pa.array(np.diff(words.first), pa.int64()),
                pa.array([spans.get(r, []) for r in every], pa.list_(pa.int64())),
                pa.array([sorted(items.get(r, ())) for r in every], pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_key", "n_words", "spans", "items"],
        )

    return arrow_map(rows, work, FOUND)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, spans, items) for every row of the documents.

    ``spans``: runs of words that lie in an occurrence of a window, flat (start, end, ...).
    ``items``: ids of the items with a window in the text, ascending. Null texts have no words;
    items without words have no windows; an item without id hits but is not listed. Repeated
    items count once, repeated rows are returned as often. Empty tables give no hits, or no rows.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("text_key", F.xxhash64("doc_id", "text"))
    pairs, few = _windows(benchmark, item_id_col, item_text_col, window, block_pairs)
    result = _matches(rows, _block(rows, pairs)) if few else _indexed(rows, pairs)
    hit = F.aggregate(
        F.sequence(F.lit(0), F.size("spans") - 2, F.lit(2)),
        F.lit(0).cast("long"),
        lambda total, at: total + F.get(F.col("spans"), at + 1) - F.get(F.col("spans"), at),
    )
    n_hit = F.when(F.size("spans") > 0, hit).otherwise(F.lit(0).cast("long"))
    return result.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "items")


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_pairs: int = BLOCK_PAIRS,
) -> DataFrame:
    """The rows of the documents, with all their columns, that hold no window of the benchmark."""
    rows = docs.select(valid_text(f"`{text_col}`").alias("text"))
    pairs, few = _windows(benchmark, item_id_col, item_text_col, window, block_pairs)
    if not few:
        # Equal texts hold equal windows, so two hashes of the text say which rows go.
        text = valid_text(f"`{text_col}`")
        names = {unused(docs, "_doc_id"): F.xxhash64(F.lit(1), text), unused(docs, "_text_key"): F.xxhash64(text)}
        keyed = docs.withColumns(names)
        one, other = names
        _, hits = _hits(keyed.select(F.col(one).alias("doc_id"), F.col(other).alias("text_key"), text.alias("text")), pairs)
        gone = hits.select(F.col("doc_id").alias(one), F.col("text_key").alias(other)).distinct()
        return keyed.join(small_side(staged(gone, "benchmark_texts"), 32), [one, other], "left_anti").select(
            *[F.col(f"`{c}`") for c in docs.columns]
        )
    block = _block(rows, pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, text_col):
            words = Batch.of(valid(batch.column(text_col)))
            _, low = block.hits(words)
            stays = np.ones(batch.num_rows, bool)
            stays[words.rows()[low]] = False
            yield batch.filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)
