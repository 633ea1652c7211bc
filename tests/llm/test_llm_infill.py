"""Fill-in-middle against plain string cuts, and exact round trips."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF
from llm_rows import no_docs, odd_docs
from visitmart.llm import infill, queries

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text: str | None) -> tuple:
    text = text or ""
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * at : 8 * at + 8], 16) for at in range(4))
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(mark in text for mark in infill.SENTINELS) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(part) for part in (units[:low], units[low:high], units[high:]))
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made(docs, **options):
    return infill.restore(infill.fill_in_middle(docs, **options))


TEXTS = ["a", "é", "😀", "ab cd", "a<P>b", "<M>", "<P", "x<S", "P>S>M>", "<<P >", "\x00\x01", "éa😀b" * 40, "word " * 500, "\n\n\n", "a" * 9999]


def test_equals_string_cuts(spark):
    rows = [(at, TEXTS[at % len(TEXTS)]) for at in range(600)] + [(None, "abc def"), (None, None), (7, None), (8, "")]
    got = made(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), *map(str, expected(i, t)), t or "") for i, t in rows)
    seen = sorted((str(r.doc_id), *map(str, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output)), r.restored) for r in got)
    assert seen == want
    for row in got:
        assert row.output_sha256 == sha(row.output) and row.restored_sha256 == sha(row.restored)
    assert {row.form for row in got} == {"plain", "psm", "spm"}


def test_descriptors_spell_the_output(spark):
    docs = odd_docs(spark)
    texts = {}
    for row in docs.collect():
        texts.setdefault(row.doc_id, set()).add(row.text or "")
    marks = "".join(infill.SENTINELS).encode()
    for row in infill.fill_in_middle(docs).collect():
        spelled = {
            b"".join((text.encode(), marks)[p.buffer][p.start : p.start + p.length] for p in row.pieces).decode(errors="replace")
            for text in texts[row.doc_id]
        }
        assert row.output in spelled
        assert len(row.pieces) == (1 if row.form == "plain" else 6)


def test_odd_rows_are_restored(spark):
    docs = odd_docs(spark)
    want = sorted((str(r.doc_id), sha(r.text or "")) for r in docs.collect())
    assert sorted((str(r.doc_id), r.restored_sha256) for r in made(docs).collect()) == want
    assert made(no_docs(spark)).count() == 0


def test_query_equals_string_cuts_on_all_documents(spark):
    docs = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    got = queries.fill_in_middle(spark, SF).collect()
    assert len(got) == len(docs)
    for row in got:
        n, form, prefix, middle, output = expected(row.doc_id, docs[row.doc_id])
        assert (row.n, row.form, row.prefix_chars, row.middle_chars) == (n, form, prefix, middle)
        assert row.output_sha256 == sha(output) and row.restored_sha256 == sha(docs[row.doc_id] or "")


def test_outputs_that_cannot_be_restored(spark):
    rows = [("<P>a<S>b", "psm"), ("x<P>a<S>b<M>c", "psm"), ("abc", "other"), (None, "plain"), ("abc", None), ("<P>a<S>b<M>c", "spm"), ("", "plain")]
    frame = spark.createDataFrame(rows, "output string, form string")
    got = {(r.form, r.restored) for r in infill.restore(frame.withColumn("output", F.col("output"))).collect()}
    assert got == {("psm", None), ("other", None), ("plain", None), (None, None), ("spm", None), ("plain", "")}


def test_other_sentinels_and_shares(spark):
    docs = spark.createDataFrame([(at, "some words are here") for at in range(50)], "doc_id long, text string")
    marks = ("[prefix]", "[suffix]", "[middle]")
    got = infill.restore(infill.fill_in_middle(docs, sentinels=marks, plain_percent=0, spm_percent=100), sentinels=marks).collect()
    assert {(r.form, r.restored) for r in got} == {("spm", "some words are here")}
    assert all(r.output.startswith("[suffix]") for r in got)
    for bad in (("", "a", "b"), ("a", "a", "b"), ("ab", "bc", "d"), ("aba", "x", "y"), ("abc", "b", "z")):  # empty, equal, chained, chained to itself, held
        with pytest.raises(ValueError):
            infill.fill_in_middle(docs, sentinels=bad)


def test_invalid_bytes_long_texts_and_text_ids(spark):
    docs = spark.sql("SELECT 'id' AS doc_id, CAST(X'41FF42' AS STRING) AS text UNION ALL SELECT 'x', repeat(' ', 3000000) UNION ALL SELECT 'y', repeat('q', 3000000)")
    got = {r.doc_id: r for r in made(docs).drop("pieces").collect()}
    assert got["id"].restored == "A�B" and got["id"].n == 3
    assert got["x"].n == 3_000_000 and got["y"].n == 1
    assert got["x"].restored_sha256 == sha(" " * 3_000_000)


def test_batches_of_sliced_rows(spark):
    """Passes cut batches, so offsets of a slice must count from its own start."""
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("né "), 120000), F.col("id").cast("string")).alias("text"))
    for row in made(docs.coalesce(1)).select("doc_id", "form", "restored_sha256", "n").collect():
        assert row.restored_sha256 == sha("né " * 120000 + str(row.doc_id))
