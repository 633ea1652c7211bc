import io
from collections import Counter
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from llm_rows import no_docs, odd_docs
from visitmart.llm import queries, sharding


def by_turns(shards, slots):
    """The table filled from whole preference lists."""
    order = []
    for name in shards:
        start, step = sharding._digest(f"start:{name}") % slots, sharding._digest(f"step:{name}") % (slots - 1) + 1
        order.append([(start + turn * step) % slots for turn in range(slots)])
    owner, turn = {}, 0
    while len(owner) < slots:
        mine = order[turn % len(shards)]
        slot = next(slot for slot in mine if slot not in owner)
        owner[slot] = turn % len(shards)
        turn += 1
    return [owner[slot] for slot in range(slots)]


@pytest.mark.parametrize("shards, slots", [(1, 2), (3, 3), (3, 31), (7, 101), (5, 307)])
def test_table_is_filled_by_turns(shards, slots):
    names = [f"s{n}" for n in range(shards)]
    assert sharding.lookup_table(names, slots) == by_turns(names, slots)


def test_shares_are_even_and_changes_move_little():
    names = [f"shard-{n}" for n in range(sharding.SHARDS)]
    full = sharding.lookup_table(names)
    counts = Counter(full).values()
    assert max(counts) - min(counts) <= 1
    fewer = sharding.lookup_table(names[:-1])
    moved = sum(a != b for a, b in zip(full, fewer) if a != len(names) - 1)
    assert moved < 0.05 * len(full)


@pytest.mark.parametrize("shards, slots", [([], 7), (["a", "a"], 7), (["a"], 9), (["a"], 1), (["a", "b", "c"], 2)])
def test_wrong_tables_are_refused(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots)


def test_rows_keep_their_columns_and_equal_keys_meet(spark):
    docs = odd_docs(spark)
    placed = sharding.place(docs, "doc_id", [f"s{n}" for n in range(5)], 31)
    assert sorted(placed.columns) == sorted(docs.columns)  # slot and shard are replaced
    assert dict(placed.dtypes)["slot"] == "bigint" and dict(placed.dtypes)["shard"] == "int"
    assert placed.count() == docs.count()
    assert placed.where("shard IS NULL OR slot NOT BETWEEN 0 AND 30").count() == 0
    assert placed.groupBy("doc_id").agg({"shard": "count"}).count() == placed.select("doc_id", "shard").distinct().count()
    assert sharding.place(no_docs(spark), "doc_id").count() == 0
    assert sharding.place(docs, "text").count() == docs.count()


def test_placement_is_one_lookup_without_a_shuffle(spark):
    shown = io.StringIO()
    with redirect_stdout(shown):
        sharding.place(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id").explain()
    plan = shown.getvalue()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hash" not in plan and "Python" not in plan and "Arrow" not in plan


def test_written_shards(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id % 30 AS k", "id")
    placed = sharding.place(rows, "k", ["a", "b"], 31)
    sharding.write_shards(placed, f"{tmp_path}/out", 16_000)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(tuple, back.select("id", "shard").collect())) == sorted(map(tuple, placed.select("id", "shard").collect()))
    assert {path.name for path in (tmp_path / "out").glob("shard=*")} == {"shard=0", "shard=1"}


def test_writers_grow_with_the_bytes_of_a_shard(spark, tmp_path):
    """Twice the rows, twice the writers; a shard with most of the rows gets most of them."""

    def files(rows, name):
        hot = F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id"))
        placed = sharding.place(spark.range(rows).select(hot.alias("k"), F.repeat(F.lit("x"), 976).alias("t")), "k", ["a", "b"], 31)
        with_parts = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            sharding.write_shards(placed, f"{tmp_path}/{name}", 100_000)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", with_parts[0])
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_parts[1])
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == rows
        return {shard: len(list((tmp_path / name).glob(f"shard={shard}/*.parquet"))) for shard in (0, 1)}

    small, large = files(1000, "small"), files(4000, "large")
    hot = max(small, key=small.get)
    assert small[hot] >= 6 and small[1 - hot] <= 3
    assert large[hot] >= 3 * small[hot] and large[1 - hot] >= 2 * small[1 - hot]


def test_query_places_whole_documents(spark, tmp_path, monkeypatch):
    """The shards that the query writes hold all rows with all their columns, each in its own shard's folder."""
    odd_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    written, write = [], sharding.write_shards
    monkeypatch.setattr(sharding, "write_shards", lambda placed, path: written.append(path) or write(placed, path))
    found = queries.QUERIES["op3_sharding"](spark, str(tmp_path))
    assert found.columns == ["doc_id", "slot", "shard"] and dict(found.dtypes)["shard"] == "int"
    rows = lambda frame: sorted(map(str, frame.collect()))
    shards = spark.read.parquet(written[0])
    placed = sharding.place(docs, "doc_id")
    assert rows(shards.select(*placed.columns)) == rows(placed)
    assert rows(found) == rows(placed.select(*found.columns))


def test_query_places_no_documents(spark, tmp_path):
    no_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES["op3_sharding"](spark, str(tmp_path)).count() == 0
