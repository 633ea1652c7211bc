"""Bytes that are no UTF-8 count as U+FFFD in every operator that reads texts."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import rows_of
from visitmart.llm import decontam, infill, langid, lines, mixing, phrases, quality, secrets, simhash, tokens

#: The bytes stand in for one another in pairs of rows: broken ones and the same with U+FFFD.
SHARED = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty more words here"


def docs(spark, broken: bool):
    mark = F.unhex(F.lit("FF")).cast("string") if broken else F.lit("�")
    texts = [f"{SHARED} @ tail", f"{SHARED} @ tail", f"@{SHARED}", "@", f"a line that is long enough to be repeated among documents @\nx{SHARED}"]
    texts += [f"own {at}\na line that is long enough to be repeated among documents @" for at in range(6)]
    rows = spark.createDataFrame([(at, text, "en" if at % 2 else "fr") for at, text in enumerate(texts)], "doc_id long, text string, lang string")
    parts = F.split("text", "@", -1)
    joined = F.aggregate(F.slice(parts, 2, 100), F.get(parts, F.lit(0)), lambda text, part: F.concat(text, mark, part))
    return rows.withColumn("text", joined).withColumn("source", F.lit("s"))


def language(frame):
    prototypes = langid.train(frame, 256)
    return langid.identify(frame, prototypes, dimensions=256)


def labelled(frame):
    labels = frame.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    return quality.score(frame, quality.train(frame, labels))


WORK = {
    "tokens": tokens.document_tokens,
    "phrases": phrases.remove_repeats,
    "mixing": mixing.mix,
    "simhash": simhash.near_duplicates,
    "lines": lines.dedup_lines,
    "decontam": lambda frame: decontam.find_contamination(frame, frame.select(F.col("doc_id").alias("item_id"), "text").limit(2)),
    "langid": language,
    "quality": labelled,
    "secrets": secrets.find_secrets,
    "infill": lambda frame: infill.restore(infill.fill_in_middle(frame)),
}


@pytest.mark.parametrize("name", sorted(WORK))
def test_broken_bytes_count_as_replaced(spark, name):
    broken, replaced = (rows_of(WORK[name](docs(spark, which))) for which in (True, False))
    assert broken == replaced and len(broken) == 11


def test_benchmark_and_document_with_the_same_broken_bytes_meet(spark):
    frame = docs(spark, True)
    items = frame.where("doc_id = 0").select(F.col("doc_id").alias("item_id"), "text")
    hit = {row.doc_id for row in decontam.find_contamination(frame, items).where("n_hit > 0").collect()}
    assert {0, 1} <= hit
    left = {row.doc_id for row in decontam.drop_contaminated(frame, items).collect()}
    assert left == {row.doc_id for row in frame.collect()} - hit


def test_language_stage_takes_broken_bytes(spark):
    assert corpus_pipeline.known_language(spark, docs(spark, True), "").count() <= 11
