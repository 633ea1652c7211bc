import random

import pytest

from llm_rows import DOCS, no_docs, odd_docs, odd_rows
from visitmart.llm import lines
from visitmart.session import scratch_table  # noqa: F401

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_length=40, min_docs=5):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders: dict = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_length:
                holders.setdefault(key(line), set()).add(doc_id)
    top = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= min_docs}
    out = []
    for doc_id, text in rows:
        whole = (text or "").split("\n")
        stay = [line for line in whole if key(line) not in top or top[key(line)] == doc_id]
        out.append((doc_id, len(whole), len(whole) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def check(spark, rows, **options):
    docs = spark.createDataFrame([(a, b, None, None, None) for a, b in rows], DOCS).repartition(3)
    found = lines.dedup_lines(docs, **options).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, options.get("min_length", 40), options.get("min_docs", 5))
    return sum(row.n_dropped for row in found)


@pytest.mark.parametrize("batches, fanout", [(1, 2), (5, 2), (4, 3)])
def test_batches_and_levels_give_the_same(spark, batches, fanout):
    rng = random.Random(4)
    pool = [f"Line {n} É of the pool" + "!" * rng.randrange(12) for n in range(30)]
    spaces = ["", " ", "\t", "\r", "\x0b "]
    rows = []
    for doc in range(80):
        picked = [rng.choice(spaces) + rng.choice([str, str.upper, str.swapcase])(rng.choice(pool)) + rng.choice(spaces) for _ in range(rng.randrange(8))]
        rows.append((doc, "\n".join(picked)))
    rows += [(3, "\n".join(pool)), (None, "\n".join(pool)), (None, pool[0]), rows[5]]
    assert check(spark, rows, min_length=24, min_docs=5, batches=batches, fanout=fanout) > 0


def test_runs_share_no_key_and_stay_few(spark):
    runs = lines.Runs(spark, buckets=4, fanout=2)
    for batch in range(7):
        rows = [(key, key * 3, 1000 * batch + key) for key in range(batch * 2, batch * 2 + 10)]
        new = runs.add(spark.createDataFrame(rows, "h1 long, h2 long, doc_id long"))
        assert {row.h1 for row in new.collect()} == set(range(batch * 2 + 8 if batch else 0, batch * 2 + 10))
    assert len(runs.tables()) == 3  # 7 = 4 + 2 + 1
    keys = [row.h1 for table in runs.tables() for row in spark.table(table).collect()]
    assert sorted(keys) == list(range(22))
    state = {row.h1: (row.n_docs, row.top) for row in runs.state().collect()}
    for key in range(22):
        held = [batch for batch in range(7) if batch * 2 <= key < batch * 2 + 10]
        assert state[key] == (len(held), 1000 * max(held) + key)


def test_odd_rows(spark):
    rows = [(row[0], row[1]) for row in odd_rows()]
    found = lines.dedup_lines(odd_docs(spark)).collect()
    assert sorted(map(tuple, found), key=str) == brute(rows)
    assert any(row.n_dropped for row in found)
    assert lines.dedup_lines(no_docs(spark)).count() == 0


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_runs_are_read_in_their_order(spark):
    """A batch is sorted once for all runs, no run is sorted or moved, and two runs are merged side by side."""
    runs = lines.Runs(spark, buckets=4, fanout=3)
    for batch in range(2):
        runs.add(runs.spark.createDataFrame([(key * 7 % 41, key, batch) for key in range(batch * 30, batch * 30 + 40)], "h1 long, h2 long, doc_id long"))
    one, other = runs.tables()
    plan = executed(runs.merged(one, other))
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
    batch = runs.spark.createDataFrame([(1, 1), (2, 2)], "h1 long, h2 long").repartition(4, *lines.KEY)
    for table in (one, other):
        batch = batch.join(runs.spark.table(table).select(*lines.KEY, lines.F.lit(True).alias(table[-5:])).hint("merge"), lines.KEY, "left")
    plan = executed(batch)
    assert plan.count("SortMergeJoin") == 2 and plan.count("Sort [") == 1 and plan.count("Exchange") == 1
    assert spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering") == "false"
