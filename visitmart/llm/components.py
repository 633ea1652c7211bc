"""Connected components of links that are spread over the cluster.

Links turn into stars that point at smaller ids: each round, every node first sends its larger
neighbours to the smallest node it knows, then its smaller ones. The number of rounds grows with
the logarithm of the longest path, and no round makes more links than there were. Each round is
written to the shared folder and the one before it removed, so lost executors cost one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import drop_path, written
from visitmart.session import scratch_path


class Forest:
    """Union by smaller root over the few nodes that one task sees at once."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        top = node
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(node, node)) != top:
            parent[node] = top
            node = up
        return top

    def union(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


#: Links that a task contracts at once; bounds its memory.
CHUNK_LINKS = 200_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links as stars of what one task has at once; the components stay the same."""

    def stars(forest: Forest) -> pa.RecordBatch:
        nodes = [n for n in forest.parent if forest.root(n) != n]
        return pa.RecordBatch.from_pydict(
            {"a": pa.array(nodes, pa.int64()), "b": pa.array([forest.root(n) for n in nodes], pa.int64())}
        )

    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.union(a, b)
        if len(forest.parent) >= CHUNK_LINKS:
            yield stars(forest)
            forest = Forest()
    if forest.parent:
        yield stars(forest)


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """Links (a, b) with the ``m`` that ``least`` has for a.

    The key of ``least`` is written anew, so that both sides are dealt for this join: then adaptive execution can
    split the links of a hub, which it can't where one side keeps the partitions of its aggregate.
    """
    return links.join(least.select(F.col("a").bitwiseXOR(F.lit(0).cast("long")).alias("a"), "m"), "a")


def _largest_first(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours linked to the smallest node it knows."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return _with_least(both.where("b > a"), least).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _smallest_first(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours linked to the smallest of them; links come as (larger, smaller)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = _with_least(links, least).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return least.select("a", F.col("m").alias("b")).union(moved).distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the links (two long columns); component: the smallest node reached.

    Nodes without links don't appear. Loops, repeated links and empty tables are fine.
    """
    a, b = links.columns
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")
    spark = links.sparkSession

    def round_of(frame: DataFrame, before: str | None) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "components")
        done = written(frame, path)
        if before:
            drop_path(spark, before)
        return done, path

    now, path = round_of(pairs.mapInArrow(_contracted, "a long, b long").distinct(), None)

    def sign(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = sign(now)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        now, path = round_of(_smallest_first(_largest_first(now)), path)
        found = sign(now)
        if found == seen:
            break
        seen = found
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
