"""Line dedup with levelled sorted runs.

Documents come in batches. A batch is reduced to one row per line key: how many documents hold
it, and the largest of their ids. Runs are tables bucketed and sorted by the key's hash. Each
batch is merge-anti-joined with the runs: keys that no run has are new and become a run of
level 0; keys that some run has are recorded as hits. When a level has ``FANOUT`` runs they are
merged into one run of the next level, so there are never more than a few runs to join with.
In the end runs and hits add up to the count of every key.

Keys are told apart by their MD5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.llm.common import arrow_map, by_doc, freed_shuffles, session_with, staged, text_rows, written
from visitmart.session import scratch_path, scratch_table

SPACE = " \t\n\x0b\x0c\r"
MIN_LENGTH = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2
KEY = ["h1", "h2"]


def line_key(line: str) -> str:
    """The line without space at its ends, A-Z lower-cased."""
    key = line.strip(SPACE)
    if key.isascii():
        return key.lower()
    return key.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def key_hash(key: str) -> bytes:
    return hashlib.md5(key.encode("utf-8", "surrogatepass")).digest()


def _halves(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def line_entries(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(h1, h2, doc_id): the keys of at least ``min_length`` code points of each row, once each."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, second, ids = [], [], []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            keys = {line_key(line) for line in (text or "").split("\n") if len(line) >= min_length}
            for key in keys:
                if len(key) >= min_length:
                    a, b = _halves(key_hash(key))
                    first.append(a)
                    second.append(b)
                    ids.append(doc_id)
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (first, second, ids)], names=["h1", "h2", "doc_id"]
        )

    return arrow_map(docs, work, "h1 long, h2 long, doc_id long")


class Runs:
    """The levelled runs of one corpus; tables live in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, fanout: int = FANOUT) -> None:
        # A session of its own: there scans of sorted buckets say that they are sorted, and joins don't sort them again.
        self.spark, self.fanout = session_with(spark, **{"spark.sql.legacy.bucketedTableScan.outputOrdering": "true"}), fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.hits: list[DataFrame] = []

    def _write(self, rows: DataFrame) -> str:
        """A run: one file per bucket, sorted by hash; the rows must be dealt by bucket."""
        table = scratch_table(self.spark, "line_run")
        with freed_shuffles(self.spark):
            rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("compression", "zstd").saveAsTable(table)
        return table

    def tables(self) -> list[str]:
        return [table for level in self.levels for table in level]

    def add(self, entries: DataFrame) -> DataFrame:
        """Joins a batch of (h1, h2, doc_id) with the runs, adds it; returns the keys that were new.

        Documents must not be spread over batches. Null ids count as one document.
        """
        batch = entries.distinct().groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top"))
        batch = batch.repartition(self.buckets, *KEY)
        known = []
        for number, table in enumerate(self.tables()):
            run = self.spark.table(table).select(*KEY, F.lit(True).alias(f"in_{number}"))
            batch = batch.join(run.hint("merge"), KEY, "left")
            known.append(F.col(f"in_{number}").isNotNull())
        seen = reduce(lambda a, b: a | b, known, F.lit(False))
        marked = staged(batch.select(*KEY, "n_docs", "top", seen.alias("seen")), "line_batch")
        if known:
            self.hits.append(marked.where("seen").drop("seen"))
        new = marked.where("NOT seen").drop("seen")
        self._push(self._write(new.repartition(self.buckets, *KEY)), 0)
        return new

    def _push(self, table: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(table)
        if len(self.levels[level]) < self.fanout:
            return
        runs, self.levels[level] = self.levels[level], []
        merged = runs[0]
        for table in runs[1:]:
            both = self._write(self.merged(merged, table))
            for old in (merged, table):
                self.spark.sql(f"DROP TABLE {old}")
            merged = both
        self._push(merged, level + 1)

    def merged(self, one: str, other: str) -> DataFrame:
        """Two runs, which share no key, as one: their sorted buckets are read side by side, without a shuffle or a sort of either."""
        left, right = self.spark.table(one), self.spark.table(other)
        both = left.hint("merge").join(right, KEY, "full")
        return both.select(*KEY, *[F.coalesce(left[c], right[c]).alias(c) for c in ("n_docs", "top")])

    def state(self) -> DataFrame:
        """(h1, h2, n_docs, top) of every key of all batches."""
        rows = reduce(DataFrame.union, [self.spark.table(t) for t in self.tables()] + self.hits)
        return rows.groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("top").alias("top"))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"doc_id": [], "n_lines": [], "n_dropped": [], "text": []}
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "dropped"))
        for doc_id, text, dropped in zip(*columns):
            lines = (text or "").split("\n")
            gone = set(dropped or ())
            stay = [x for x in lines if key_hash(line_key(x)) not in gone] if gone else lines
            out["doc_id"].append(doc_id)
            out["n_lines"].append(len(lines))
            out["n_dropped"].append(len(lines) - len(stay))
            out["text"].append("\n".join(stay))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) for every row, without its repeated lines.

    A line goes if its key has ``min_length`` code points or more and is in ``min_docs``
    documents or more, unless the row's id is the largest that holds it. Null and empty texts
    are one empty line. Rows of equal id are one document when documents are counted; each is
    returned. Null ids are one document, smaller than all others. No rows in, no rows out.
    """
    spark = docs.sparkSession
    rows = text_rows(docs, id_col, text_col)
    path = scratch_path(spark, "line_entries")
    number = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch")
    entries = line_entries(rows, min_length).select("*", number)
    entries.write.partitionBy("batch").option("compression", "zstd").parquet(path)
    runs = Runs(spark, fanout=fanout)
    entries = runs.spark.read.schema("h1 long, h2 long, doc_id long, batch int").parquet(path)
    for at in range(batches):
        runs.add(entries.where(F.col("batch") == at).drop("batch"))
    # Keys written anew: both sides are dealt for the join, and adaptive execution can split the entries of one line.
    anew = [F.col(key).bitwiseXOR(F.lit(0).cast("long")).alias(key) for key in KEY]
    repeated = runs.state().where(F.col("n_docs") >= min_docs).select(*anew, "top").hint("merge")
    mine = entries.join(repeated, KEY).where("NOT (doc_id <=> top)")
    packed = F.unhex(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in KEY]))
    path = scratch_path(spark, "line_drops")
    drops = written(mine.groupBy("doc_id").agg(F.collect_set(packed).alias("dropped")), path)
    joined = by_doc(rows, spark.read.schema(drops.schema).parquet(path))
    return joined.mapInArrow(_kept, "doc_id long, n_lines long, n_dropped long, text string")
