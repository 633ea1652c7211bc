"""What the operators of this subpackage share: input columns, staged tables, small sides, batches."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitmart.session import scratch_path

#: Bytes of text that one numpy pass takes; a longer text is a pass of its own.
PASS_BYTES = 2 << 20

#: Bytes up to which a side is sent to all executors; beyond it rows are shuffled.
SMALL_SIDE_BYTES = 32 << 20

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names: other columns can't clash with its own.

    Ids are whole numbers, or text that spells them. Bytes of a text that are no UTF-8 become U+FFFD.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), valid_text(text_col).alias("text"))


def valid_text(text_col: str) -> Column:
    """The column as text in which bytes that are no UTF-8 are replaced by U+FFFD."""
    return F.make_valid_utf8(F.col(text_col).cast("string"))


#: Setting that names the folder of the tokenizers' files, on the driver.
TOKENIZER_FOLDER = "spark.visitmart.tokenizers"


def tokenizer_path(spark: SparkSession, name: str) -> str:
    """Place of a tokenizer's file: in the folder that the session names, or in /opt/tokenizers."""
    return f"{spark.conf.get(TOKENIZER_FOLDER, '/opt/tokenizers').rstrip('/')}/{name}"


def driver_file(uri: str) -> bytes:
    """A file's bytes, read on the driver from a local path or any file system that Arrow knows."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    file_system, name = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
    try:
        with file_system.open_input_stream(name) as stream:
            return stream.readall()
    except FileNotFoundError:
        raise FileNotFoundError(f"no tokenizer file at {uri}; give its path, or name its folder in {TOKENIZER_FOLDER}") from None


def unused(frame: DataFrame, name: str) -> str:
    """The name, with underscores after it if the frame has a column that is called so."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def session_with(spark: SparkSession, **conf: str) -> SparkSession:
    """A session like the given one with some settings of its own; the given one keeps its settings."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in conf.items():
        own.conf.set(key, value)
    return own


_freeing = threading.Lock()
_inside: dict[int, tuple[int, str]] = {}


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries inside go as each query ends; staged tables hold what is needed later.

    The setting is the session's. Of threads that are inside at once, the first sets it and the last puts it back.
    """
    key = id(spark._jsparkSession)
    with _freeing:
        count, before = _inside.get(key, (0, spark.conf.get(FREE_SHUFFLES, "false")))
        _inside[key] = count + 1, before
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _freeing:
            count, before = _inside.pop(key)
            if count > 1:
                _inside[key] = count - 1, before
            else:
                spark.conf.set(FREE_SHUFFLES, before)


def written(frame: DataFrame, path: str) -> DataFrame:
    """The frame written to a path of the shared folder and read back: lineage ends here, lost executors lose nothing."""
    spark = frame.sparkSession
    with freed_shuffles(spark):
        frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def staged(frame: DataFrame, prefix: str) -> DataFrame:
    """``written`` at a new path in the application's scratch folder."""
    return written(frame, scratch_path(frame.sparkSession, prefix))


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove what ``written`` wrote; frames that read it end here."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def small_side(frame: DataFrame, row_bytes: int) -> DataFrame:
    """The frame, marked for broadcast if its rows are counted to fit ``SMALL_SIDE_BYTES``, else for a merge join."""
    return frame.hint("broadcast" if frame.count() * row_bytes <= SMALL_SIDE_BYTES else "merge")


def by_doc(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """A join on ``doc_id`` in which null ids meet; a merge join at any size, as file sizes tell little of the rows."""
    named = right.withColumnRenamed("doc_id", "_doc_id").hint("merge")
    return left.join(named, left["doc_id"].eqNullSafe(named["_doc_id"]), how).drop("_doc_id")


def id_crc32(column: str = "doc_id") -> Column:
    """CRC-32 of an id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def passes(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each take ``PASS_BYTES`` at most, or are one text."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = size = 0
        for row, length in enumerate(lengths.tolist()):
            if row > at and size + length > PASS_BYTES:
                yield batch.slice(at, row - at)
                at, size = row, 0
            size += length
        if at < batch.num_rows:
            yield batch.slice(at)


def arrow_map(
    frame: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str | StructType,
    column: str = "text",
) -> DataFrame:
    """``work`` over passes of the frame; it is given a batch and returns a batch or None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in passes(batches, column):
            out = work(batch)
            if out is not None and out.num_rows:
                yield out

    return frame.mapInArrow(run, schema)
