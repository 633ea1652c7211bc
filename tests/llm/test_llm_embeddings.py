import math
import random

import numpy as np
import pytest

from llm_rows import with_clashing
from visitmart.llm import embeddings

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.98):
    """(links, smallest id reached) per row."""

    def usable(row):
        vector = row[1]
        return row[2] is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector)

    units = [np.array(row[1], np.float32).astype(float) if usable(row) else None for row in rows]
    units = [None if u is None else u / np.linalg.norm(u) for u in units]
    near = [[] for _ in rows]
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] and a @ b >= least:
                near[i].append(j)
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        reached = min(ids) if ids else None
        out.append((row[0], len(near[i]), reached, row[0] == reached))
    return sorted(out, key=str)


def check(spark, rows):
    frame = with_clashing(spark.createDataFrame(rows, SCHEMA).repartition(4))
    found = embeddings.near_duplicates(frame).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
    return sum(row.n_links for row in found)


def clusters(rng, count, size, dims, labels, spread):
    rows = []
    for _ in range(count):
        center = [rng.gauss(0, 1) for _ in range(dims)]
        rows += [[x + rng.gauss(0, spread) for x in center] for _ in range(rng.randrange(1, size))]
    rng.shuffle(rows)
    return [(at, vector, rng.randrange(labels)) for at, vector in enumerate(rows)]


@pytest.mark.parametrize("dims, spread, block, tile", [(64, 0.08, 16, 2), (3, 0.1, 16, 1), (8, 0.12, 256, 16), (1, 0.5, 16, 4), (32, 0.1, 4, 3)])
def test_clusters(spark, monkeypatch, dims, spread, block, tile):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", block)
    monkeypatch.setattr(embeddings, "TILE_BLOCKS", tile)
    monkeypatch.setattr(embeddings, "FANOUT", 2)
    assert check(spark, clusters(random.Random(dims), 40, 12, dims, 3, spread)) > 0


def test_copies_chains_and_unusable_vectors(spark):
    turn = [[math.cos(a / 10), math.sin(a / 10)] for a in range(40)]  # each links with its neighbour only
    rows = [(100 + at, vector, 1) for at, vector in enumerate(turn)]
    rows += [(at, [1.0, 0.0], 2) for at in range(30)] + [(40, [5.0, 0.0], 2), (41, [-1.0, 0.0], 2), (42, [1.0, 0.0], None)]
    rows += [(50, None, 2), (51, [], 2), (52, [0.0, 0.0], 2), (53, [float("nan"), 1.0], 2), (54, [float("inf"), 1.0], 2)]
    rows += [(55, [None, 1.0], 2), (56, [1.0, 0.0, 0.0], 2), (57, [-0.0, 3.0], 2), (58, [0.0, 3.0], 2), (59, [1e-38, 0.0], 2)]
    rows += [(None, [1.0, 0.0], 2), (None, [1.0, 1.0], 3), (60, [1.0, 0.0], 2), (60, [1.0, 0.0], 2), (61, [3e38, 1e38], 4), (62, [3e38, 1e38], 4)]
    assert check(spark, rows) > 0


def test_no_rows(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    check(spark, [(1, None, 1), (2, [0.0], None)])


def test_a_block_is_sent_once_per_near_tile(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 8)
    monkeypatch.setattr(embeddings, "TILE_BLOCKS", 4)
    sent, units = [], embeddings._units

    def seen(blocks, pairs, *options):
        rows = units(blocks, pairs, *options)
        sent.append([(row.number, row.a, row.b, row.side) for row in rows.select("number", "a", "b", "side").collect()])
        return rows

    monkeypatch.setattr(embeddings, "_units", seen)
    rng = random.Random(5)
    rows = [(at, [rng.gauss(0, 1) for _ in range(16)], 1) for at in range(300)]
    rows += [(1000 + at, [x + rng.gauss(0, 0.02) for x in vector], 1) for at, vector, _ in rows[::10]]
    assert check(spark, rows) > 0
    (found,) = sent
    assert len(found) == len(set(found))
    blocks, tiles = {n for n, *_ in found}, {t for _, a, b, _ in found for t in (a, b)}
    assert len(blocks) > 30
    assert len(found) <= len(blocks) * len(tiles)


def test_what_the_directions_leave_prunes(spark):
    """Boxes that meet in all directions are apart by the length of the rest."""
    box = "label string, number long, low array<double>, high array<double>, parent long"
    tiles = [("x", 0, [0.0, 0.1], [0.2, 0.2], 0), ("x", 1, [0.0, 0.8], [0.2, 0.9], 0), ("x", 2, [0.1, 0.3], [0.3, 0.5], 0), ("y", 2, [0.0, 0.1], [0.2, 0.2], 0)]
    found = embeddings.near_tiles(spark.createDataFrame(tiles, box), 0.2, 2)
    assert sorted((r.label, r.a, r.b) for r in found.collect()) == [("x", 0, 0), ("x", 0, 2), ("x", 1, 1), ("x", 2, 2), ("y", 2, 2)]
