"""Embedding near-dedup by an epsilon grid order join.

Vectors of one label with a cosine of ``min_cosine`` or more are linked. Scaled to length 1, that
is a distance of at most epsilon = sqrt(2 - 2 min_cosine). Vectors are turned onto the leading
principal directions, put on a grid with cells of side epsilon, and sorted by label and grid cell.
The sorted sequence is cut into blocks; blocks form a tree of intervals of the sequence, each with
the box that holds its vectors. The join starts with the whole sequence against itself and goes
down the tree: a pair of intervals whose boxes are farther apart than epsilon is dropped, any other
is replaced by the pairs of its parts. A box has one side more than there are directions, the length
of what the directions leave of a vector: lengths of what is left differ by no more than the vectors.

The tree's leaves are tiles of ``TILE_BLOCKS`` blocks. A near pair of tiles is one unit of work: a
block is sent to it once, if its box is near the other tile's, and not once per near block. There,
pairs of blocks whose boxes are near are compared exactly. A unit yields link counts per vector and a
spanning forest, never all its links. Equal vectors of one label are one from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import small_side, staged
from visitmart.llm.components import Forest, components

MIN_COSINE = 0.98
#: Leading principal directions that the grid and the boxes use.
DIRECTIONS = 6
#: Vectors of a block, blocks of a tile, and children of a node of the tree above the tiles.
BLOCK_ROWS = 256
TILE_BLOCKS = 16
FANOUT = 8
#: What rounding may move a projection or a bound; boxes are wider by it.
SLACK = 1e-9


def _usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles, scaled to length 1."""
    rows = np.stack([np.asarray(v, np.float64) for v in column.to_numpy(zero_copy_only=False)])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def principal_directions(vectors: DataFrame, size: int, count: int) -> np.ndarray:
    """Leading eigenvectors of the second moments of all unit vectors (column ``vector``) of one length.

    One number per pair of dimensions comes to the driver. The directions only steer the pruning.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column("vector"))
                total += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"place": np.arange(size * size), "part": total.ravel()})

    sums = vectors.select("vector").mapInArrow(run, "place long, part double").groupBy("place").agg(F.sum("part").alias("part"))
    moments = np.zeros(size * size)
    for place, part in sums.toLocalIterator():
        moments[place] = part
    _, vectors_ = np.linalg.eigh(moments.reshape(size, size))
    return vectors_[:, ::-1][:, :count]


def _projected(directions: np.ndarray, epsilon: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _matrix(batch.column("vector"))
            turned = unit @ directions
            cells = np.floor(turned / epsilon).astype(np.int64)
            left = np.linalg.norm(unit - turned @ directions.T, axis=1)
            turned = np.column_stack([turned, left])
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("least"), batch.column("n"), batch.column("vector"),
                 pa.array(list(cells), pa.list_(pa.int64())), pa.array(list(turned), pa.list_(pa.float64()))],
                names=["label", "least", "n", "vector", "cell", "turned"],
            )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition, sorted by label and cell, as blocks of up to ``BLOCK_ROWS`` rows of one label."""

    def out(rows: pa.RecordBatch) -> pa.RecordBatch:
        turned = np.stack(rows.column("turned").to_numpy(zero_copy_only=False))
        unit = _matrix(rows.column("vector"))
        return pa.RecordBatch.from_pydict(
            {
                "part": rows.column("part").slice(0, 1),
                "seq": pa.array([number[0]], pa.int64()),
                "label": rows.column("label").slice(0, 1),
                "low": pa.array([turned.min(axis=0) - SLACK], pa.list_(pa.float64())),
                "high": pa.array([turned.max(axis=0) + SLACK], pa.list_(pa.float64())),
                "ids": pa.array([rows.column("least").to_pylist()], pa.list_(pa.int64())),
                "sizes": pa.array([rows.column("n").to_pylist()], pa.list_(pa.int64())),
                "units": pa.array([unit.tobytes()], pa.binary()),
            }
        )

    number, held = [0], None
    for batch in batches:
        held = batch if held is None else pa.concat_batches([held, batch])
        while held.num_rows:
            labels = held.column("label").to_numpy(zero_copy_only=False)
            same = int(np.argmax(labels != labels[0])) or len(labels)
            if same == len(labels) and same < BLOCK_ROWS:
                break  # more rows of the label may follow
            yield out(held.slice(0, min(same, BLOCK_ROWS)))
            number[0] += 1
            held = held.slice(min(same, BLOCK_ROWS))
    if held is not None and held.num_rows:
        yield out(held)


def _gap(sides: int, one: str = "a_", other: str = "b_") -> Column:
    """Squared distance of two boxes (columns <one>low, <one>high, <other>low, <other>high)."""
    total = F.lit(0.0)
    for d in range(sides):
        low = F.greatest(F.get(f"{one}low", F.lit(d)), F.get(f"{other}low", F.lit(d)))
        high = F.least(F.get(f"{one}high", F.lit(d)), F.get(f"{other}high", F.lit(d)))
        total = total + F.pow(F.greatest(low - high, F.lit(0.0)), 2)
    return total


def _boxes(nodes: DataFrame, sides: int) -> DataFrame:
    """(label, number, low, high, parent): the parents of nodes (label, parent, low, high) with the boxes around them."""
    grouped = nodes.groupBy("label", F.col("parent").alias("number")).agg(
        *[F.min(F.get("low", F.lit(d))).alias(f"l{d}") for d in range(sides)],
        *[F.max(F.get("high", F.lit(d))).alias(f"h{d}") for d in range(sides)],
    )
    low, high = (F.array(*[F.col(f"{side}{d}") for d in range(sides)]) for side in "lh")
    return grouped.select("label", "number", low.alias("low"), high.alias("high"), F.floor(F.col("number") / FANOUT).alias("parent"))


def near_tiles(tiles: DataFrame, epsilon: float, sides: int) -> DataFrame:
    """(label, a, b, a_low, a_high, b_low, b_high), a <= b: the pairs of tiles (label, number, low, high, parent) that may hold a link.

    Levels of the tree are tables. Each step joins the pairs of a level with the parts of both
    sides, by the key of the node, so no step compares all nodes with all.
    """
    levels = [tiles]
    top = tiles.agg(F.max("number")).first()[0] or 0
    while top > 0:
        top //= FANOUT
        levels.append(staged(_boxes(levels[-1], sides), "embedding_level"))
    # A node of a level is known by (label, number): an interval can hold the end of one label and the start of the next.
    ends = [F.col(side).alias(f"{s}_{side}") for s in "ab" for side in ("low", "high")]
    pairs = levels[-1].select("label", F.col("number").alias("a"), F.col("number").alias("b"), *ends)
    limit = (epsilon + SLACK) ** 2
    for level in levels[-2::-1] if len(levels) > 1 else []:
        parts = [
            level.select("label", F.col("parent").alias(s), F.col("number").alias(f"{s}_number"), F.col("low").alias(f"{s}_low"), F.col("high").alias(f"{s}_high"))
            for s in "ab"
        ]
        down = pairs.select("label", "a", "b").join(parts[0], ["label", "a"]).join(parts[1], ["label", "b"])
        pairs = down.where((F.col("a_number") <= F.col("b_number")) & (_gap(sides) <= limit)).select(
            "label", F.col("a_number").alias("a"), F.col("b_number").alias("b"), "a_low", "a_high", "b_low", "b_high"
        )
    return pairs


SENT = ("number", "low", "high", "ids", "sizes", "units")


def _units(blocks: DataFrame, pairs: DataFrame, epsilon: float, sides: int) -> DataFrame:
    """Rows (label, a, b, side, and those of ``SENT``), those of a pair of tiles together: first the blocks of a, then those of b.

    A block goes to a pair only if its box is near the other tile's.
    """
    pairs = small_side(staged(pairs, "embedding_pairs"), 64 + 32 * sides)
    limit = (epsilon + SLACK) ** 2
    ways = []
    for number, (own, other) in enumerate(("ab", "ba")):
        wanted = pairs if own == "a" else pairs.where("a != b")
        named = blocks.withColumnRenamed("tile", own)
        near = named.join(wanted, ["label", own]).where(_gap(sides, "", f"{other}_") <= limit)
        ways.append(near.select("label", "a", "b", F.lit(number).alias("side"), *SENT))
    # A number of tasks that adaptive execution leaves alone: small blocks make long comparisons.
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ways[0].union(ways[1]).repartition(parts, "label", "a", "b")
    return dealt.sortWithinPartitions("label", "a", "b", "side", "number")


def _compared(a: dict, b: dict, min_cosine: float, forest: Forest) -> Iterator[tuple[int, int, int | None]]:
    """Rows (id, links, other) of two blocks compared exactly; ``other`` holds new links of the forest, ``links`` the counts."""
    same = a["number"] == b["number"]
    left, right = (np.frombuffer(block["units"]).reshape(len(block["ids"]), -1) for block in (a, b))
    near = left @ right.T >= min_cosine
    if same:
        np.fill_diagonal(near, False)
    for ids, sizes, hits in ((a["ids"], b["sizes"], near), (b["ids"], a["sizes"], near.T))[: 1 if same else 2]:
        counts = hits @ np.array(sizes, np.int64)
        for i in np.flatnonzero(counts).tolist():
            yield ids[i], int(counts[i]), None
    for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
        if forest.union(a["ids"][i], b["ids"][j]):
            yield a["ids"][i], 0, b["ids"][j]


def _joined(min_cosine: float, epsilon: float):
    """Units of sorted rows as rows (id, links, other). A task holds the blocks of one tile and streams those of the other."""
    limit = (epsilon + SLACK) ** 2

    def near(a: dict, b: dict) -> bool:
        gap = np.maximum(np.array(a["low"]), np.array(b["low"])) - np.minimum(np.array(a["high"]), np.array(b["high"]))
        return float((np.maximum(gap, 0) ** 2).sum()) <= limit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, forest = None, [], Forest()
        for batch in batches:
            for at in range(batch.num_rows):
                (block,) = batch.slice(at, 1).to_pylist()
                key = block["label"], block["a"], block["b"]
                if key != unit:
                    unit, held, forest = key, [], Forest()
                if block["side"] == 0:
                    held.append(block)
                # A tile meets itself: each block meets those before it and itself.
                others = held if block["side"] == 1 or block["a"] == block["b"] else []
                found = [row for other in others if near(other, block) for row in _compared(other, block, min_cosine, forest)]
                if found:
                    ids, links, other = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(links, pa.int64()), pa.array(other, pa.int64())], names=["id", "links", "other"]
                    )

    return run


def near_duplicates(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    min_cosine: float = MIN_COSINE,
    directions: int = DIRECTIONS,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    ``n_links``: other rows linked directly; ``component_id``: the smallest id reached by links,
    its own included; ``kept``: that id is its own. Rows without a usable vector (null, empty,
    zero, with null or non-finite components) or without a label link with nothing. Vectors of
    different length don't link. Rows with equal vectors and labels link with each other, repeated
    rows and rows with a null id too; a null id is never the smallest, and is not kept unless
    nothing else is in its component. No rows in, no rows out.
    """
    spark = rows.sparkSession
    named = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"),  # one zero
    )
    numbered = staged(named.withColumn("row", F.monotonically_increasing_id()), "embedding_rows")
    usable = numbered.where(_usable(F.col("vector")) & F.col("label").isNotNull())
    classes = usable.groupBy("label", "vector").agg(
        F.min("row").alias("least"), F.count("*").alias("n"), F.min("vec_id").alias("least_id")
    )
    classes = staged(classes, "embedding_classes")
    found = None
    epsilon = float(np.sqrt(max(0.0, 2 - 2 * min_cosine))) or SLACK
    for size in sorted(r[0] for r in classes.select(F.size("vector")).distinct().collect()):
        mine = classes.where(F.size("vector") == size)
        count = min(directions, size)
        basis = principal_directions(mine, size, count)
        schema = "label string, least long, n long, vector array<double>, cell array<long>, turned array<double>"
        placed = mine.select("label", "least", "n", "vector").mapInArrow(_projected(basis, epsilon), schema)
        # Parts of several tiles, so that few tiles are cut short by the end of a part.
        parts = max(1, mine.count() // (BLOCK_ROWS * TILE_BLOCKS * 4))
        ordered = placed.repartitionByRange(parts, "label", "cell", "least").sortWithinPartitions("label", "cell", "least")
        packed = ordered.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(
            _packed,
            "part long, seq long, label string, low array<double>, high array<double>, ids array<long>, sizes array<long>, units binary",
        )
        packed = staged(packed, "embedding_blocks")
        # Numbers that ascend with the sequence: room for the largest part's blocks is left for each part.
        room = TILE_BLOCKS
        while room <= (packed.agg(F.max("seq")).first()[0] or 0):
            room *= FANOUT
        blocks = packed.withColumn("number", F.col("part") * room + F.col("seq"))
        blocks = blocks.withColumn("tile", F.floor(F.col("number") / TILE_BLOCKS))
        tiles = staged(_boxes(blocks.withColumn("parent", F.col("tile")), count + 1), "embedding_tiles")
        units = _units(blocks, near_tiles(tiles, epsilon, count + 1), epsilon, count + 1)
        links = units.mapInArrow(_joined(min_cosine, epsilon), "id long, links long, other long")
        found = links if found is None else found.union(links)
    if found is None:
        found = spark.createDataFrame([], "id long, links long, other long")
    found = staged(found, "embedding_links")
    linked = found.groupBy(F.col("id").alias("least")).agg(F.sum("links").alias("links"))
    reached = components(found.where("other IS NOT NULL").select("id", "other")).withColumnRenamed("node", "least")
    labelled = classes.join(linked, "least", "left").join(reached, "least", "left").withColumn(
        "component", F.coalesce("component", "least")
    )
    smallest = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    labelled = labelled.join(smallest, "component").select(
        "label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    placed = numbered.where(_usable(F.col("vector")) & F.col("label").isNotNull()).join(labelled, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = numbered.where(~(_usable(F.col("vector")) & F.col("label").isNotNull())).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return placed.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
