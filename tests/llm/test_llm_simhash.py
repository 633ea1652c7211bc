import glob
import random

import numpy as np
import pytest
import xxhash

from llm_rows import DOCS, no_docs, odd_docs, odd_rows, sentence
from visitmart.llm import queries, simhash
from visitmart.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text, size=4):
    """The fingerprint bit by bit."""
    words = [w for w in __import__("re").split("[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[at : at + size]).encode(), 42) for at in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def grouped(ids, prints, max_bits=4):
    """Smallest id reached from each row."""
    out, left = {}, set(range(len(ids)))
    while left:
        todo = [left.pop()]
        group = set(todo)
        while todo:
            at = todo.pop()
            near = {other for other in left if (prints[at] ^ prints[other]).bit_count() <= max_bits}
            left -= near
            group |= near
            todo += near
        known = [ids[at] for at in group if ids[at] is not None]
        out |= dict.fromkeys(group, min(known) if known else None)
    return [out[at] for at in range(len(ids))]


@pytest.mark.parametrize("size", [1, 3, 4])
def test_fingerprints(spark, size):
    rng = random.Random(2)
    texts = [None, "", " \n", "a", "A b", "a b c d", " a b c d", "a b c d \r\n", "É a b c d e", "ÀB İ ẞ Ａ Q", "\x1c\x85\xa0 a b c d"]
    texts += [sentence(rng, rng.randrange(80)) for _ in range(30)] + ["x y z " * 20000, sentence(rng, 100_000), "Y" * 1_000_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = dict(map(tuple, simhash.fingerprints(docs, size).collect()))
    assert {at: bits % (1 << 64) for at, bits in found.items()} == {at: plain(text, size) for at, text in enumerate(texts)}


def test_fingerprints_keep_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (None, "c"), (None, None)], "doc_id long, text string")
    found = [(row.doc_id, row.bits % (1 << 64)) for row in simhash.fingerprints(docs).collect()]
    wanted = [(1, plain("a b")), (1, plain("a b")), (1, plain("c")), (None, plain("c")), (None, 0)]
    assert sorted(found, key=str) == sorted(wanted, key=str)


def test_fingerprints_stay_in_generated_code(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = simhash.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Python" not in plan


@pytest.mark.parametrize("max_bits", [0, 1, 3, 4, 5, 6])
def test_linked_fingerprints_meet_in_a_cell(max_bits):
    rng = random.Random(max_bits)
    a, b = [], []
    for _ in range(300):
        value = rng.getrandbits(64)
        other = value
        for bit in rng.sample(range(64), rng.randrange(max_bits + 1)):
            other ^= 1 << bit
        a.append(value)
        b.append(other)
    entered = []
    for side in (a, b):
        bits = np.array(side, np.uint64).view(np.int64)
        found = [set() for _ in side]
        for cell, index in simhash.cells(bits, max_bits):
            pairs = list(zip(index.tolist(), cell.tolist()))
            assert len(pairs) == len(set(pairs))  # no cell twice
            for at, key in pairs:
                found[at].add(key)
        entered.append(found)
    assert all(x & y for x, y in zip(*entered))


@pytest.mark.parametrize("chunk", [5, 1024])
def test_crowded_cells_lose_no_link(spark, monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(chunk)
    prints = []
    for _ in range(4):
        center = rng.getrandbits(64)
        for _ in range(60):
            value = center
            for bit in rng.sample(range(64), rng.randrange(4)):
                value ^= 1 << bit
            prints.append(value)
    prints = sorted(set(prints) | {rng.getrandbits(64) for _ in range(100)})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.linked_fingerprints(spark.createDataFrame([(p,) for p in signed], "bits long"))
    found = dict(map(tuple, components(links).collect()))
    wanted = grouped(signed, prints)
    assert [found.get(p, p) for p in signed] == wanted


def test_odd_rows(spark):
    rows = odd_rows()
    prints = [plain(row[1]) for row in rows]
    wanted = grouped([row[0] for row in rows], prints)
    found = simhash.near_duplicates(odd_docs(spark)).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        ((row[0], f"{p:016x}", component) for row, p, component in zip(rows, prints, wanted)), key=str
    )
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(row.doc_id, row.text) for row in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    prints = [plain(text) for _, text in rows]
    wanted = grouped([doc_id for doc_id, _ in rows], prints)
    found = queries.QUERIES["op6_simhash"](spark, folder).collect()
    assert sorted(map(tuple, found)) == sorted((row[0], f"{p:016x}", c) for row, p, c in zip(rows, prints, wanted))


def test_components_of_chains_stars_and_loops(spark):
    links = [(at, at + 1) for at in range(100, 160)] + [(7, at) for at in range(200, 260)] + [(5, 5), (300, 301), (301, 300), (300, 301)]
    random.Random(1).shuffle(links)
    found = dict(map(tuple, components(spark.createDataFrame(links, "x long, y long").repartition(7)).collect()))
    assert found == {**dict.fromkeys(range(100, 161), 100), **dict.fromkeys([7, *range(200, 260)], 7), 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0
    assert DOCS


def test_rounds_leave_nothing_behind_and_a_hub_is_joined_by_dealt_sides(spark):
    """One round's files at most stay until the scratch folder goes; the least of each node is dealt for its join."""
    from visitmart.llm import components as module
    from visitmart.llm.common import session_with
    from visitmart.session import scratch_folder

    folder = scratch_folder(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/components_*"))
    links = spark.createDataFrame([(at, at + 1) for at in range(300)] + [(1000, at) for at in range(2000, 2400)], "x long, y long")
    found = components(links.repartition(5))
    assert found.where("component = 0").count() == 301 and found.where("component = 1000").count() == 401
    assert len(set(glob.glob(f"{folder}/components_*")) - before) == 1
    wide = session_with(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    links = wide.createDataFrame([(2, 1), (3, 1)], "x long, y long")
    for step in (module._largest_first, module._smallest_first):
        plan = step(links.toDF("a", "b"))._jdf.queryExecution().executedPlan().toString()
        joined = plan[plan.index("SortMergeJoin") :]
        assert joined.count("Exchange hashpartitioning(a") >= 2


def test_settings_are_put_back_by_the_last_of_several_threads(spark):
    import threading

    from visitmart.llm.common import FREE_SHUFFLES, freed_shuffles

    before = spark.conf.get(FREE_SHUFFLES, "false")
    first, second = freed_shuffles(spark), freed_shuffles(spark)
    first.__enter__()
    other = threading.Thread(target=second.__enter__)
    other.start()
    other.join()
    first.__exit__(None, None, None)
    assert spark.conf.get(FREE_SHUFFLES) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(FREE_SHUFFLES) == before
