"""Substring dedup with repeated-phrase automata.

A window of ``WINDOW`` words is repeated if its words also start earlier. Each window is known by
one phrase of ``PHRASE`` words in it, the one with the smallest hash (the leftmost of equals);
equal windows choose equal phrases at the same place. Windows that choose the same occurrence
of a phrase follow each other and make up a segment.

1. Phrases whose hash is chosen only once in the corpus are dropped, and with them their windows.
2. Documents are streamed again and the segments of the other phrases cut out. Segments of equal
   words are one, with its first occurrence; the copies of a hot passage shrink to a row per task.
   A segment does not say where its phrase is.
3. Segments and phrases are dealt to shards by phrase. A shard finds which of its phrases do recur, word
   by word, compiles them into an Aho-Corasick automaton, and streams its segments through it.
   Every occurrence that the automaton finds locates the windows around it; windows that no
   occurrence locates are not looked at again, and without the automaton's hits nothing is removed.
   Each located window's first place is found in the shard. Shards take a bounded number of segments
   at a time. A phrase with very many different segments is split over shards; what these
   locate is put together window by window, by MD5.
4. Documents are joined with the windows that are repeated and lose the words these cover.

Whole texts are shuffled once: they are written as sorted buckets by document, and both joins read
these as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from visitmart.llm.common import arrow_map, freed_shuffles, passes, session_with, small_side, staged, text_rows
from visitmart.llm.words import SPACED, column_bytes, mixed, run_hashes, word_spans
from visitmart.session import scratch_table

WINDOW = 20
PHRASE = 5
#: Segments that one automaton serves, about; a phrase's segments stay together.
SHARD_SEGMENTS = 20_000
#: A phrase with more different segments than this is split over shards of so many.
PHRASE_SEGMENTS = 5_000
#: Text of a bucket of documents, and the most buckets there are.
BUCKET_BYTES = 16 << 20
MOST_BUCKETS = 50_000
#: Stands for a null id in the order of documents: after all others.
LAST = (1 << 63) - 1


class Cut:
    """Words of a batch of texts and the segments of their windows."""

    def __init__(self, column: pa.Array, window: int, phrase: int) -> None:
        self.data, offsets = column_bytes(column)
        self.starts, self.ends, self.first = word_spans(self.data, offsets, SPACED)
        count = np.diff(self.first)
        n, row_end = len(self.starts), np.repeat(self.first[1:], count)
        words = run_hashes(self.data, self.starts, self.ends)
        at = np.arange(max(0, n - phrase + 1))
        hashes = run_hashes(words, at, at + phrase)
        # The leftmost smallest hash among the phrases of each window, by doubling steps.
        best, span, width = at, 1, window - phrase + 1
        while span < width:
            step = min(span, width - span)
            left, right = best[: len(best) - step], best[step:]
            best = np.where(hashes[right] < hashes[left], right, left)
            span += step
        begin = np.arange(len(best)) if n >= window else np.zeros(0, np.int64)
        inside = begin + window <= row_end[: len(begin)]
        begin, best = begin[inside], best[: len(inside)][inside]
        row = np.repeat(np.arange(len(count)), count)[begin]
        new = np.ones(len(begin), bool)
        new[1:] = (best[1:] != best[:-1]) | (row[1:] != row[:-1])
        edge = np.flatnonzero(new)
        self.row, self.begin, self.anchor = row[edge], begin[edge], best[edge]
        self.windows = np.diff(np.append(edge, len(begin)))
        self.hash = hashes[self.anchor].view(np.int64) if len(edge) else np.zeros(0, np.int64)

    def texts(self, low: np.ndarray, high: np.ndarray) -> list[bytes]:
        """Per span of words these words joined by a space: a slice of the text itself where only single spaces part them."""
        if not len(low):
            return []
        single = (self.starts[1:] - self.ends[:-1] == 1) & (self.data[self.ends[:-1]] == 0x20)
        other = np.concatenate([[0], np.cumsum(~single)])
        plain = other[high - 1] == other[low]
        whole, starts, ends = self.data.tobytes(), self.starts, self.ends
        return [
            whole[a:b] if ok else b" ".join([whole[c:d] for c, d in zip(starts[i:j].tolist(), ends[i:j].tolist())])
            for a, b, ok, i, j in zip(starts[low].tolist(), ends[high - 1].tolist(), plain.tolist(), low.tolist(), high.tolist())
        ]


def _chosen(window: int, phrase: int):
    """(order_id, text_key, phrase, n) of the phrases that the windows of each row choose."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        cut = Cut(batch.column("text"), window, phrase)
        order = np.lexsort((cut.hash, cut.row))
        row, chosen = cut.row[order], cut.hash[order]
        edge = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (chosen[1:] != chosen[:-1]))[: len(row)])
        n = np.diff(np.append(edge, len(row)))
        rows = pa.array(row[edge])
        return pa.RecordBatch.from_arrays(
            [batch.column("order_id").take(rows), batch.column("text_key").take(rows), pa.array(chosen[edge]), pa.array(n, pa.int64())],
            names=["order_id", "text_key", "phrase", "n"],
        )

    return work


SEGMENT = "order_id long, text_key long, begin long, windows int, phrase long, name string, words string, k1 long, k2 long"


def _key(words: bytes) -> tuple[int, int]:
    digest = hashlib.md5(words).digest()
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _segments(window: int, phrase: int):
    """Segments of the phrases that are in the row's list ``phrases``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        cut = Cut(batch.column("text"), window, phrase)
        lists = batch.column("phrases")
        wanted = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        known = lists.flatten().to_numpy(zero_copy_only=False)
        # Row and phrase as one number; a segment that is taken in error has a phrase that its shard does not confirm.
        taken = np.flatnonzero(np.isin(mixed(cut.hash) + cut.row.astype(np.uint64), mixed(known) + wanted.astype(np.uint64)))
        low = cut.begin[taken]
        high = low + cut.windows[taken] + window - 1
        texts = cut.texts(low, high)
        names = cut.texts(cut.anchor[taken], cut.anchor[taken] + phrase)
        keys = np.frombuffer(b"".join([hashlib.md5(t).digest() for t in texts]), ">i8").astype(np.int64).reshape(-1, 2)
        rows = pa.array(cut.row[taken])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("order_id").take(rows),
                batch.column("text_key").take(rows),
                pa.array(low - cut.first[cut.row[taken]]),
                pa.array(cut.windows[taken], pa.int32()),
                pa.array(cut.hash[taken]),
                pa.array(names, pa.binary()).cast(pa.string()),
                pa.array(texts, pa.binary()).cast(pa.string()),
                pa.array(keys[:, 0].copy()),
                pa.array(keys[:, 1].copy()),
            ],
            names=[c.split()[0] for c in SEGMENT.split(", ")],
        )

    return work


LOCATED = (
    "k1 long, k2 long, order_id long, text_key long, begin long, n long, found int, mask int, split boolean, w1 long, w2 long, j int"
)


def hits(automaton: ahocorasick.Automaton, words: str) -> Iterator[tuple[int, int]]:
    """(first word, number of words) of every occurrence of the automaton's phrases in words joined by a space."""
    padded = f" {words} "
    for end, length in automaton.iter(padded):
        start = end - length + 1
        yield padded.count(" ", 0, start), padded.count(" ", start, end)


def _located(window: int):
    """Rows sorted by phrase: of each segment the windows around hits, and those of them that start earlier, as bits.

    Of split phrases each window located is a row as well, with its MD5; what starts earlier is found across shards.
    """

    def shard(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        for row in rows:
            total[row[1]] = total.get(row[1], 0) + (2 if row[10] else row[7])
        automaton = ahocorasick.Automaton()
        for name, count in total.items():
            if count > 1:
                automaton.add_word(f" {name} ", len(name) + 2)
        if not len(automaton):
            return
        automaton.make_automaton()
        first: dict[str, tuple] = {}
        located: list[tuple[tuple, int, list[str]]] = []
        for row in rows:
            _, _, text, windows, *place, _, _, _, _ = row
            found = 0
            for at, length in hits(automaton, text):
                low, high = max(0, at + length - window), min(windows - 1, at)
                found |= (1 << high + 1) - (1 << low) if low <= high else 0
            if not found:
                continue
            words = text.split(" ")
            keys = [" ".join(words[j : j + window]) if found >> j & 1 else "" for j in range(windows)]
            located.append((row, found, keys))
            for j, key in enumerate(keys):
                begin = (place[0], place[1], place[2] + j)
                if key and (key not in first or begin < first[key]):
                    first[key] = begin
        out: list[tuple] = []
        for row, found, keys in located:
            _, _, _, _, order_id, text_key, begin, n, k1, k2, split = row
            own = (k1, k2, order_id, text_key, begin, n)
            earlier = [j for j, key in enumerate(keys) if key and first[key] < (order_id, text_key, begin + j)]
            out.append((*own, found, sum(1 << j for j in earlier), split, None, None, None))
            if split:
                out += [(*own, None, None, True, *_key(key.encode()), j) for j, key in enumerate(keys) if key]
        kinds = [pa.int64()] * 6 + [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32()]
        names = [column.split()[0] for column in LOCATED.split(", ")]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= SHARD_SEGMENTS and row[0] != held[-1][0]:
                    yield from shard(held)
                    held = []
                held.append(row)
        if held:
            yield from shard(held)

    return run


KEPT = "doc_id long, n_words long, n_removed long, text string"


def _removed(window: int):
    """Rows without the words that their repeated windows cover; ``begins`` and ``masks`` tell which these are."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: tuple[list, list, list] = ([], [], [])
        for text, begins, masks in zip(*(batch.column(c).to_pylist() for c in ("text", "begins", "masks"))):
            words = (text or "").encode("utf-8", "surrogatepass").split()  # bytes: ASCII space only
            gone = 0
            n = len(words)
            if begins:
                turn = np.zeros(n + 1, np.int64)
                for begin, mask in zip(begins, masks):
                    for j in range(mask.bit_length()):
                        if mask >> j & 1:
                            turn[begin + j] += 1
                            turn[begin + j + window] -= 1
                covered = np.cumsum(turn)[:n] > 0
                gone = int(covered.sum())
                words = [w for w, c in zip(words, covered.tolist()) if not c]
            out[0].append(n)
            out[1].append(gone)
            out[2].append(b" ".join(words))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "text"],
        )

    return work


def _bucketed(rows: DataFrame, keys: list[str], size: int) -> DataFrame:
    """The rows as a table of sorted buckets by ``keys``, as many as ``size`` bytes of text ask for and at least one a core."""
    # A session of its own: there scans of sorted buckets say that they are sorted, and joins don't sort them again.
    own = session_with(rows.sparkSession, **{"spark.sql.legacy.bucketedTableScan.outputOrdering": "true"})
    buckets = min(MOST_BUCKETS, max(own.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES)))
    table = scratch_table(own, "phrase_documents")
    with freed_shuffles(rows.sparkSession):
        dealt = rows.repartition(buckets, *keys)
        dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("compression", "zstd").saveAsTable(table)
    return own.table(table)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, phrase: int = PHRASE
) -> DataFrame:
    """(doc_id, n_words, n_removed, text) for every row, without the words of repeated windows.

    A window is repeated if its words also start in a document of smaller id, or earlier in its
    own. ``text``: the words that stay, joined by one space. Null, empty and short texts have no
    windows. Null ids come after all others. Of texts that share an id, the one with the smaller
    XXH64 comes first; rows repeated in full are one document and are returned as often. No rows
    in, no rows out.
    """
    if not 0 < phrase <= window or window - phrase > 30:
        raise ValueError("a phrase must fit in a window, with at most 30 words to spare")
    rows = text_rows(docs, id_col, text_col).select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("order_id"), F.xxhash64("text").alias("text_key"), "text"
    )
    keys = ["order_id", "text_key"]
    seen = Observation()
    watched = rows.drop("doc_id").observe(seen, F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"))
    chosen = arrow_map(watched, _chosen(window, phrase), "order_id long, text_key long, phrase long, n long")
    chosen = staged(chosen, "phrases_chosen")
    rows = _bucketed(rows, keys, seen.get["bytes"])
    repeated = chosen.groupBy("phrase").agg(F.sum("n").alias("total")).where("total > 1").select("phrase")
    per_doc = chosen.select(*keys, "phrase").join(repeated, "phrase").groupBy(*keys).agg(F.collect_set("phrase").alias("phrases"))
    per_doc = staged(per_doc, "phrases_repeated")
    segments = staged(arrow_map(rows.drop("doc_id").join(per_doc.hint("merge"), keys), _segments(window, phrase), SEGMENT), "phrase_segments")

    same = ["k1", "k2", "phrase", "name", "windows", "words"]
    occurrence = F.struct("order_id", "text_key", "begin")
    distinct = segments.groupBy(*same).agg(F.min(occurrence).alias("first"), F.count("*").alias("n"))
    distinct = staged(distinct.select(*same, "first.*", "n"), "phrase_distinct")
    large = distinct.groupBy("phrase").agg(F.count("*").alias("different")).where(F.col("different") > PHRASE_SEGMENTS)
    dealt = distinct.join(small_side(staged(large, "phrase_large"), 32), "phrase", "left")
    part = F.pmod("k1", F.ceil(F.col("different") / PHRASE_SEGMENTS))
    shards = dealt.select(
        "phrase", "name", "words", "windows", "order_id", "text_key", "begin", "n", "k1", "k2",
        F.col("different").isNotNull().alias("split"), F.coalesce(part, F.lit(0)).alias("part"),
    )
    shards = shards.repartition("phrase", "part").sortWithinPartitions("phrase").drop("part")
    located = staged(shards.mapInArrow(_located(window), LOCATED), "phrase_located")

    # Windows of split phrases that start earlier in another segment, of whichever shard.
    place = F.struct("order_id", "text_key", (F.col("begin") + F.col("j")).alias("at"))
    windows = located.where("w1 IS NOT NULL").select("w1", "w2", "j", "k1", "k2", place.alias("place"))
    firsts = windows.groupBy("w1", "w2").agg(F.min("place").alias("first"))
    later = windows.join(firsts.hint("merge"), ["w1", "w2"]).where("first < place")
    bits = later.groupBy("k1", "k2").agg(F.bit_or(F.expr("shiftleft(1, j)")).alias("more"))

    # A segment's first occurrence loses what its mask says, its other occurrences lose all that was located.
    own = located.where("found IS NOT NULL").select("k1", "k2", "n", occurrence.alias("first"), "found", "mask", "split")
    whole = own.where("NOT split").withColumn("more", F.lit(0))
    cut_up = own.where("split").join(bits.hint("merge"), ["k1", "k2"], "left")
    masks = whole.unionByName(cut_up).withColumn("mask", F.col("mask").bitwiseOR(F.coalesce("more", F.lit(0))))
    masks = staged(masks.where("n > 1 OR mask <> 0").select("k1", "k2", "first", "found", "mask"), "phrase_masks")
    marked = segments.select("k1", "k2", *keys, "begin").join(masks, ["k1", "k2"]).select(
        *keys, "begin", F.when(F.col("first") == occurrence, F.col("mask")).otherwise(F.col("found")).alias("mask")
    )
    lists = marked.where("mask > 0").groupBy(*keys).agg(F.collect_set(F.struct("begin", "mask")).alias("marks"))
    lists = lists.select(*keys, F.col("marks.begin").alias("begins"), F.col("marks.mask").alias("masks"))
    lists = staged(lists, "phrase_marks")
    joined = rows.join(lists.hint("merge"), keys, "left").select("doc_id", "text", "begins", "masks")
    return arrow_map(joined, _removed(window), KEPT)
