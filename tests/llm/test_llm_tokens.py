import random

import numpy as np
import pytest
import regex
import tiktoken

from conftest import rows_of
from llm_rows import no_docs, odd_docs, odd_rows
from visitmart.llm import queries, tokens
from visitmart.session import scratch_path

SMALL = "/root/testdata/sf0.001"


def coder():
    table = tokens.ranks(f"/opt/tokenizers/{tokens.TOKENIZER}")
    return tiktoken.Encoding("test", pat_str=tokens.SPLIT, mergeable_ranks=table, special_tokens={})


def test_query_counts_the_tokens_of_whole_texts(spark):
    encode = coder().encode_ordinary
    texts = {row.doc_id: row.text for row in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = {row.doc_id: row.n_tokens for row in queries.QUERIES["op1_token_counts"](spark, SMALL).collect()}
    assert found == {doc_id: len(encode(text or "")) for doc_id, text in texts.items()}


def test_odd_rows(spark):
    encode = coder().encode_ordinary
    found = tokens.document_tokens(odd_docs(spark), block_bytes=512)
    assert rows_of(found) == rows_of_list([(row[0], len(encode(row[1] or ""))) for row in odd_rows()])
    assert tokens.document_tokens(no_docs(spark)).count() == 0


def rows_of_list(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def expected(path, ids, end_id):
    """One row per document of a file, counted id by id."""
    rows, start = [], 0
    for place, token in enumerate(ids):
        if token == end_id:
            rows.append((path, len(rows), start, place - start))
            start = place + 1
    if start < len(ids):
        rows.append((path, len(rows), start, len(ids) - start))
    return rows


@pytest.mark.parametrize("width, block_bytes, span_blocks", [(2, 2, 3), (2, 6, 2), (4, 8, 1), (2, 1 << 20, 1024)])
def test_scan_of_flat_files(spark, tmp_path, width, block_bytes, span_blocks):
    rng = random.Random(block_bytes)
    files = [[], [9], [1], [9, 9, 9], [1, 2, 9], [9, 1, 2], [1, 9, 9, 2, 3, 4, 5, 6, 7, 8, 1, 1, 1, 1, 1, 9]]
    files += [[rng.choice([1, 2, 3, 9]) for _ in range(rng.randrange(1, 60))] for _ in range(6)]
    rows, wanted = [], []
    for at, ids in enumerate(files):
        path = tmp_path / f"{at}.tokens"
        path.write_bytes(np.array(ids, f"<u{width}").tobytes() + b"\x09" * (at % width))
        rows.append((f"file:{path}",))
        wanted += expected(f"file:{path}", ids, 9)
    lengths = tokens.file_lengths(spark.createDataFrame(rows, "path string"))
    found = tokens.token_counts(lengths, 9, width, block_bytes, span_blocks)
    assert rows_of(found) == rows_of_list(wanted)


def test_files_roll_over_and_unnamed_files_are_not_read(spark):
    folder = scratch_path(spark, "rolled")
    docs = spark.range(300).selectExpr("id AS doc_id", "repeat('word ', 50) AS text")
    manifest = tokens.write_token_files(docs, folder, file_bytes=1000)
    assert manifest.select("path").distinct().count() > 20
    file_system, at = tokens.opened(folder)
    with file_system.open_output_stream(f"{at}/left-behind.tokens") as out:
        out.write(b"\x01\x00" * 50)
    found = tokens.token_counts(tokens.file_lengths(manifest.select("path").distinct()), tokens.END_ID)
    assert found.count() == 300


def test_ids_must_fit(spark, tmp_path):
    (tmp_path / "ranks").write_bytes(b"YQ== 70000\n")
    with pytest.raises(ValueError, match="16 bits"):
        tokens.write_token_files(no_docs(spark), scratch_path(spark, "none"), f"file:{tmp_path}/ranks")


def pieces(text):
    """The pattern's pieces, by an engine that does not give up on long white space."""
    return regex.findall(tokens.SPLIT, text)


@pytest.mark.parametrize("limit", [2, 3, 7])
def test_cut_white_space_encodes_as_uncut(monkeypatch, limit):
    """Runs cut from a few characters on, on texts that the pattern can also take as a whole."""
    monkeypatch.setattr(tokens, "_LONG_SPACE", tokens.re.compile(tokens._LONG_SPACE.pattern.replace("5000", str(limit))))
    rng, own = random.Random(limit), coder()
    for _ in range(400):
        text = "".join(rng.choice([" ", "  ", "\n", "\t", "\xa0", "\u3000", "\x1c", "\x85", "a", "é", "1", "!", "'s"]) for _ in range(rng.randrange(40)))
        assert tokens.encoded(own, text) == own.encode_ordinary(text), repr(text)


def test_five_million_characters_of_white_space(spark):
    rng = random.Random(1)
    n = 5_000_000
    mixed = "".join(rng.choices(" \t\n\r\xa0\u2003", k=n))
    texts = [" " * n, "\t" * n, "\n" * n, mixed, f"a{' ' * n}b", f"{mixed}1 x {' ' * 100_000}\n! y", "ab" * (n // 2), "=" * n]
    own = coder()
    wanted = [(at, sum(len(own._encode_single_piece(piece)) for piece in pieces(text))) for at, text in enumerate(texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows_of(tokens.document_tokens(docs)) == wanted


def test_one_batch_per_pass_and_settings(spark):
    docs = spark.createDataFrame([(at, f"text {at}") for at in range(50)], "doc_id long, text string").coalesce(1)
    folder = scratch_path(spark, "files")
    manifest = tokens.write_token_files(docs, folder, file_bytes=16)
    assert manifest.count() == 50 and manifest.select("path").distinct().count() > 1
    spark.conf.set("spark.visitmart.tokenizers", "/nowhere")
    try:
        with pytest.raises(FileNotFoundError, match="spark.visitmart.tokenizers"):
            tokens.document_tokens(docs)
    finally:
        spark.conf.unset("spark.visitmart.tokenizers")
