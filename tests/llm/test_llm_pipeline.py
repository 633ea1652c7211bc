import math
import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
import __spark_entry__ as registered
from llm_rows import odd_docs, odd_rows, no_docs
from test_llm_decontam import brute as leaks
from test_llm_mixing import check as mix_is_right
from test_llm_simhash import grouped, plain
from visitmart.llm import langid, mixing, queries, sharding


def docs_of(frame):
    return sorted((tuple(row) for row in frame.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=str)


def bench(spark, tmp_path):
    items = [(1, next(row[1] for row in odd_rows() if row[1] and row[1].endswith("tail"))), (2, "x1 y1 z1")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return items


def test_stages_are_those_of_the_contract():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_dedup", "decontamination", "weighted_mix", "sharding"
    ]
    assert corpus_pipeline.ORACLE_SQL is None and registered.queries()["pipeline"] is corpus_pipeline.run


def in_language(spark, rows, text, known={}):
    """By loops: whether the text's cosine to a prototype is at least half of what all but 1 in 200 training texts of its size have."""
    if "bounds" not in known:
        letters = known["letters"] = langid.Letters()
        held = lambda doc_id: doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1
        training = [row for row in rows if row[2] is not None and not held(row[0])]
        known["prototypes"] = {
            lang: sum(letters.bundles([row[1]])[0] for row in training if row[2] == lang) for lang in {row[2] for row in training}
        }
        by_size = {}
        for row in training:
            if any(c.isalpha() for c in row[1] or ""):
                size, cosine = size_and_cosine(known, row[1])
                by_size.setdefault(size, []).append(math.floor(cosine * 1000))
        known["bounds"] = {size: sorted(steps)[math.floor(len(steps) * 0.005)] / 2000 for size, steps in by_size.items()}
    size, cosine = size_and_cosine(known, text)
    bounds = known["bounds"]
    return cosine >= bounds[max([s for s in bounds if s <= size], default=min(bounds))]


def size_and_cosine(known, text):
    vector = known["letters"].bundles([text])[0]
    count = known["letters"].trigrams([text])[2].sum()
    cosines = [p @ vector / np.linalg.norm(p) / max(np.linalg.norm(vector), 1) for p in known["prototypes"].values()]
    return int(math.log2(max(count, 1))), min(max(*cosines, 0), 1)


def test_language_stage_rejects_junk_and_keeps_clean_documents(spark, tmp_path):
    """Letter noise, another script and signs go; of the provided documents, held out or not, all but 1 in 50 stay."""
    rng = random.Random(5)
    noise = lambda letters, words: " ".join("".join(rng.choices(letters, k=rng.randrange(2, 10))) for _ in range(words))
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    junk = [noise("abcdefghijklmnopqrstuvwxyz", words) for words in (40, 100, 300, 1000) for _ in range(20)]
    junk += [noise("αβγδεζηθικλμνξοπρστυφχψω", words) for words in (10, 40, 300) for _ in range(20)]
    junk += [noise("абвгдежзийклмнопрстуфхцчшщ", words) for words in (10, 40, 300) for _ in range(20)]
    rows = [(10_000_000 + at, text, None, "junk", len(text)) for at, text in enumerate(junk)]
    planted = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    planted.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {row.doc_id for row in corpus_pipeline.known_language(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), "").collect()}
    lettered = [row for row in planted.collect() if any(c.isalpha() for c in row.text or "")]
    clean = [row.doc_id for row in lettered if row.source != "junk"]
    held = [doc_id for doc_id in clean if zlib.crc32(str(doc_id).encode()) % 3 == 1]
    assert sum(doc_id in kept for doc_id in held) >= 0.98 * len(held)
    assert sum(doc_id in kept for doc_id in clean) >= 0.98 * len(clean)
    assert sum(10_000_000 + at in kept for at in range(len(junk))) <= 0.02 * len(junk)
    assert kept != {row.doc_id for row in lettered}


def test_each_stage_against_brute_force(spark, tmp_path):
    items, folder = bench(spark, tmp_path), str(tmp_path)
    odd_docs(spark).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = docs_of(docs)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if name != "sharding":
            assert out.schema == docs.schema
        out.write.parquet(f"{folder}/stage{number}")
        docs = spark.read.parquet(f"{folder}/stage{number}")
        after = docs_of(docs)
        if name == "language_id":
            assert after == [row for row in before if any(c.isalpha() for c in row[1] or "") and in_language(spark, before, row[1])]
            assert len(after) < sum(any(c.isalpha() for c in row[1] or "") for row in before)
        elif name == "simhash_dedup":
            groups: dict = {}
            prints = [plain(row[1]) for row in before]
            keyed = [(row[0] is None, row[0] or 0, at) for at, row in enumerate(before)]
            for at, least in enumerate(grouped(keyed, prints)):
                groups[least] = min(groups.get(least, keyed[at]), keyed[at])
            assert sorted(row[0] if row[0] is not None else -1 for row in after) == sorted(
                -1 if none else doc_id for none, doc_id, _ in groups.values()
            )
            assert set(after) <= set(before)
        elif name == "decontamination":
            hit = {row[0] for row in leaks([row[:2] for row in before], items) if row[2]}
            assert after == [row for row in before if row[0] not in hit] and hit
        elif name == "weighted_mix":
            mix_is_right(before, mixing.mix(spark.read.parquet(f"{folder}/stage{number - 1}")).collect())
            times = [after.count(row) for row in before]
            assert set(times) <= {0, 1, 2} and sum(times) == len(after) > 0
        else:
            assert after == before
            owner = sharding.lookup_table([f"shard-{n}" for n in range(sharding.SHARDS)])
            assert all(owner[row.slot] == row.shard for row in docs.select("slot", "shard").collect())
        before = after


def test_empty_documents(spark, tmp_path):
    bench(spark, tmp_path)
    no_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "slot", "shard"] and out.count() == 0


@pytest.mark.parametrize("name", ["simhash_dedup", "weighted_mix"])
def test_row_numbers_hold_when_files_are_packed_anew(spark, tmp_path, monkeypatch, name):
    """As when executors come or go between the jobs of a stage: later scans get other partitions."""
    odd_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    packing, write = "spark.sql.files.minPartitionNum", corpus_pipeline.staged
    rows = lambda: docs_of(stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path)))

    def packed_anew(frame, prefix):
        out = write(frame, prefix)
        spark.conf.set(packing, "100" if spark.conf.get(packing) == "1" else "1")
        return out

    spark.conf.set(packing, "1")
    try:
        expected = rows()
        monkeypatch.setattr(corpus_pipeline, "staged", packed_anew)
        assert rows() == expected and expected
    finally:
        spark.conf.unset(packing)
