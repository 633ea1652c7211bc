"""Token counts by separator scan.

Token files are flat: ids of a fixed width (little-endian), documents one after the other, each
closed by an end-of-document id, no index and no header. A file is read in blocks of
``BLOCK_BYTES``, each by whichever task gets it, and each block's separators are found by one
vectorised comparison. A document may begin some blocks before the one that closes it: a prefix
scan over the blocks of a file carries the place of the last separator, and the number of
documents, from block to block. The scan has two levels, blocks in spans and spans in files, so
that a file of any size is not one task's work.

Texts become such files with a public tokenizer; a Parquet manifest tells which document is
where. Files of tasks that failed half-way are not in the manifest and are not read.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitmart.llm.common import driver_file, passes, staged, text_rows, tokenizer_path
from visitmart.session import scratch_path

BLOCK_BYTES = 4 << 20
#: Blocks of one span of the prefix scan.
SPAN_BLOCKS = 1024
#: A writer starts a new file beyond so many bytes.
FILE_BYTES = 128 << 20
#: Rank file of a byte-level BPE vocabulary, and the free id that ends documents.
TOKENIZER = "byte_bpe_multi_50k.tiktoken"
END_ID = 50256
#: Words with the space before them, numbers, runs of signs, white space.
SPLIT = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Runs of white space from this length on are cut by hand: the pattern's look-ahead keeps a state for each character of a run.
LONG_SPACE = 5_000
_LONG_SPACE = re.compile(
    f"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{{{LONG_SPACE},}}"
)


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI as Spark writes it (``file:/x``, ``hdfs://host/x``, ``/x``)."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def ranks(path: str) -> dict[bytes, int]:
    """Tokens and ids of a rank file: a token in base 64 and its id per line."""
    pairs = (line.split() for line in driver_file(path).splitlines() if line)
    return {base64.b64decode(token): int(number) for token, number in pairs}


def encoded(coder, text: str) -> list[int]:
    """The text's ids, as of one uncut encoding by the pattern, whatever the length of its white space.

    The pattern takes a run of white space as one piece, but for its last character where more text
    follows. Long runs are encoded as such pieces, and what lies between them by the pattern.
    """
    ids: list[int] = []
    at = 0
    for run in _LONG_SPACE.finditer(text):
        start, end = run.span()
        if end < len(text):
            end -= 1  # the last one goes with what follows
        ids += coder.encode_ordinary(text[at:start])
        ids += coder._encode_single_piece(text[start:end])
        at = end
    return ids + coder.encode_ordinary(text[at:] if at else text)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Writes the texts' tokens (16 bits each) under ``folder``; returns the manifest (path, doc_no, doc_id).

    ``doc_no`` counts a file's documents from 0. A null text is a document without tokens.
    """
    table = ranks(tokenizer or tokenizer_path(docs.sparkSession, TOKENIZER))
    if max(table.values(), default=0) >= 1 << 16 or end_id >= 1 << 16 or end_id in set(table.values()):
        raise ValueError("ids must fit in 16 bits, the end id must be free")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        coder = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=table, special_tokens={})
        file_system, at = opened(folder)
        file_system.create_dir(at, recursive=True)
        out, name, written, number = None, "", 0, 0
        try:
            for batch in passes(batches):
                names, numbers = [], []
                for text in batch.column("text").to_pylist():
                    if out is None or written >= file_bytes:
                        if out is not None:
                            out.close()
                        name, written, number = f"{uuid.uuid4().hex}.tokens", 0, 0
                        out = file_system.open_output_stream(f"{at}/{name}")
                    body = np.array([*encoded(coder, text or ""), end_id], "<u2").tobytes()
                    out.write(body)
                    written += len(body)
                    names.append(f"{folder}/{name}")
                    numbers.append(number)
                    number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array(numbers, pa.int64()), batch.column("doc_id")], names=["path", "doc_no", "doc_id"]
                )
        finally:
            if out is not None:
                out.close()

    return staged(docs.mapInArrow(run, "path string, doc_no long, doc_id long"), "token_manifest")


def file_lengths(paths: DataFrame) -> DataFrame:
    """(path, length) of the files named in (path)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("path").to_pylist()
            sizes = []
            for name in names:
                file_system, at = opened(name)
                sizes.append(file_system.get_file_info(at).size)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sizes, pa.int64())], names=["path", "length"])

    return paths.select("path").mapInArrow(run, "path string, length long")


def _scan(width: int, end_id: int):
    """Per block the places of its separators, counted in tokens from the start of the file."""
    kind = {2: "<u2", 4: "<u4"}[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block, start, size, tokens in zip(*(batch.column(c).to_pylist() for c in range(5))):
                file_system, at = opened(path)
                with file_system.open_input_file(at) as source:
                    ids = np.frombuffer(source.read_at(size, start), kind)
                ends = np.flatnonzero(ids == end_id) + start // width
                if start // width + len(ids) == tokens and ids[-1] != end_id:
                    ends = np.append(ends, tokens)  # the end of the file closes a document too
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    names=["path", "block", "ends"],
                )

    return run


def token_counts(
    files: DataFrame, end_id: int, width: int = 2, block_bytes: int = BLOCK_BYTES, span_blocks: int = SPAN_BLOCKS
) -> DataFrame:
    """(path, doc_no, start, n_tokens) of every document in the files (path, length).

    ``doc_no`` counts from 0 in each file, ``start`` is the document's first token. Tokens after
    the last separator are a last document. Adjacent separators close empty documents. Empty
    files have no documents; bytes that don't fill a token at a file's end are not read.
    """
    if block_bytes % width:
        raise ValueError("blocks must hold whole tokens")
    tokens = F.floor(F.col("length") / width)
    whole = files.dropDuplicates(["path"]).select("path", tokens.alias("tokens")).where("tokens > 0")
    last = F.floor((F.col("tokens") * width - 1) / block_bytes)
    pieces = whole.select("path", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")).select(
        "path",
        "block",
        (F.col("block") * block_bytes).alias("start"),
        F.least(F.lit(block_bytes), F.col("tokens") * width - F.col("block") * block_bytes).alias("size"),
        "tokens",
    )
    found = staged(
        pieces.repartition("path", "block").mapInArrow(_scan(width, end_id), "path string, block long, ends array<long>"),
        "token_blocks",
    ).withColumn("span", F.floor(F.col("block") / span_blocks))

    each = found.select(
        "path", "span", "block", "ends", F.size("ends").cast("long").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("last")
    )
    spans = each.groupBy("path", "span").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    over_spans = Window.partitionBy("path").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    ahead = spans.select(
        "path", "span", F.sum("n").over(over_spans).alias("span_n"), F.max("last").over(over_spans).alias("span_last")
    )
    over_blocks = Window.partitionBy("path", "span").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = each.join(ahead, ["path", "span"]).select(
        "path",
        "ends",
        (F.coalesce("span_n", zero) + F.coalesce(F.sum("n").over(over_blocks), zero)).alias("before"),
        # Separators ascend, so the last one so far is the largest.
        F.coalesce(F.max("last").over(over_blocks), "span_last", F.lit(-1).cast("long")).alias("carry"),
    )
    opened_at = F.when(F.col("at") > 0, F.get(F.col("ends"), F.col("at") - 1)).otherwise(F.col("carry")) + 1
    return carried.select("path", "ends", "before", "carry", F.posexplode("ends").alias("at", "end")).select(
        "path", (F.col("before") + F.col("at")).alias("doc_no"), opened_at.alias("start"), (F.col("end") - opened_at).alias("n_tokens")
    )


def document_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_tokens) for every row: texts are written as token files, which are then scanned.

    Null and empty texts have 0 tokens; repeated rows are returned as often. No rows in, no rows out.
    """
    spark: SparkSession = docs.sparkSession
    manifest = write_token_files(text_rows(docs, id_col, text_col), scratch_path(spark, "token_files"), tokenizer, end_id)
    counts = token_counts(file_lengths(manifest.select("path").distinct()), end_id, 2, block_bytes)
    return manifest.join(counts.hint("merge"), ["path", "doc_no"]).select("doc_id", "n_tokens")
