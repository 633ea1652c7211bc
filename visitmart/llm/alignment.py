"""Alignment of two tokenizers over the same bytes.

Tokens of A and B are cut into groups where both end. Most groups are one token each of the same
bytes: an array made once gives each A id the B id of its bytes, and these groups are counted in
vectors as long as A's vocabulary. Only the links of the other groups, as (pair, documents that hold it),
enter the shuffle on pairs.

Documents are encoded once, in blocks of bounded bytes, and kept as links with their numbers. A
block's different pairs go out as one row each with the number of its documents that hold them,
meet their corpus counts by pair, and come back to the block; no document's links are shuffled by pair.

Texts are encoded word by word, and words that come again are not encoded again: neither tokenizer
joins what lies before a space with the space, as long as a character that is no white space is before it and another than a space after it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import driver_file, passes, staged, tokenizer_path, valid_text

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: A worker that holds more words, or more than eight times as many links, forgets all before its next block.
KEPT_WORDS = 300_000

SPACE = "▁"
_PLAIN = re.compile(r"\A | \Z|\s ")
_WORD_END = re.compile(r"(?<=\S) (?=[^ ])")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character stands for in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves; the others are numbered from U+0100 in their order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(printable)]
    return {chr(byte): byte for byte in printable} | {chr(256 + at): byte for at, byte in enumerate(others)}


def identity_map(a_bytes: list[bytes], b_bytes: list[bytes], b_single: list[bool]) -> np.ndarray:
    """For each A id the B id of the same bytes, or -1; of two B ids the one that is no single-byte fallback, then the smaller."""
    of_bytes: dict[bytes, int] = {}
    for single in (True, False):
        for at in reversed(range(len(b_bytes))):
            if b_single[at] == single:
                of_bytes[b_bytes[at]] = at
    return np.array([of_bytes.get(token, -1) if token else -1 for token in a_bytes], np.int64)


def gathered(offsets: np.ndarray, values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of the given rows one after the other, and their sizes."""
    starts, sizes = offsets[rows], offsets[rows + 1] - offsets[rows]
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return values[shift + np.arange(len(shift))], sizes


class Words:
    """Words by number, with their links: A ids of identical groups, codes of the other links, and their groups as text."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}
        self.texts: list[str] = []
        #: Valid, tokens of A, tokens of B, groups.
        self.counts = np.zeros((0, 4), np.int64)
        self.lists = {name: (np.zeros(1, np.int64), np.zeros(0, np.int64)) for name in ("same", "other")}

    def add(self, words: list[str], texts: list[str], counts: np.ndarray, lists: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.numbers.update(zip(words, range(len(self.texts), len(self.texts) + len(words))))
        self.texts += texts
        self.counts = np.concatenate([self.counts, counts])
        for name, (sizes, values) in lists.items():
            offsets, before = self.lists[name]
            self.lists[name] = np.concatenate([offsets, offsets[-1] + np.cumsum(sizes)]), np.concatenate([before, values])

    def full(self) -> bool:
        return len(self.texts) > KEPT_WORDS or sum(len(values) for _, values in self.lists.values()) > 8 * KEPT_WORDS


class Pair:
    """The two tokenizers, the bytes of their ids, and the words met so far with their links."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        self.a_bytes, self.b_bytes, self.identity = tables(a_file, b_file)
        self.a_sizes, self.b_sizes = (np.array(list(map(len, tokens))) for tokens in (self.a_bytes, self.b_bytes))
        pieces = [self.b.id_to_piece(at) for at in range(self.b.get_piece_size())]
        #: Words are independent if no piece of B has a space behind another character.
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces)
        names = [f"{at},".encode() for at in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names = np.frombuffer(b"".join(names), np.uint8)
        self.name_offsets = np.concatenate([[0], np.cumsum(list(map(len, names)))])
        self.words = Words()

    def cut(self, text: str) -> list[str]:
        """The text's words, each without the space before it."""
        if not self.by_word:
            return [text]
        return _WORD_END.split(text) if _PLAIN.search(text) else text.split(" ")

    def known(self, words: list[str]) -> np.ndarray:
        """The number of each word in ``self.words``; numbers hold until the next call."""
        if self.words.full():
            self.words = Words()
        new = [word for word in dict.fromkeys(words) if word not in self.words.numbers]
        if new:
            a_lists = [done.ids for done in self.a.encode_batch_fast([f" {word}" for word in new], add_special_tokens=False)]
            self._link(new, a_lists, self.b.encode(new, num_threads=1))
        return np.fromiter(map(self.words.numbers.__getitem__, words), np.int64, len(words))

    def _link(self, words: list[str], a_lists: list[list[int]], b_lists: list[list[int]]) -> None:
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        a_flat, b_flat = list(chain.from_iterable(a_lists)), list(chain.from_iterable(b_lists))
        spelled = [f" {word}".encode() for word in words]
        whole = b"".join(spelled)
        if b"".join([a_bytes[t] for t in a_flat]) != whole or b"".join([b_bytes[t] for t in b_flat]) != whole:
            good, bad = [], []
            for entry in zip(spelled, words, a_lists, b_lists):
                same = b"".join([a_bytes[t] for t in entry[2]]) == b"".join([b_bytes[t] for t in entry[3]]) == entry[0]
                (good if same else bad).append(entry[1:])
            none = np.zeros(len(bad), np.int64), np.zeros(0, np.int64)
            self.words.add([word for word, _, _ in bad], [""] * len(bad), np.zeros((len(bad), 4), np.int64), {"same": none, "other": none})
            if good:
                self._link(*map(list, zip(*good)))
            return
        a, b = np.array(a_flat), np.array(b_flat)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        # Between two neighbouring ends, of whichever tokenizer, one token of each lies: one link.
        ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        ends = ends[np.append(ends[1:] != ends[:-1], True)]
        in_a, in_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        closes = (a_ends[in_a] == ends) & (b_ends[in_b] == ends)
        alone = closes & np.concatenate([[True], closes[:-1]])
        same = alone & (self.identity[a[in_a]] == b[in_b])

        word_ends = np.cumsum([len(word) for word in spelled])
        to_link = np.searchsorted(ends, word_ends, "right")
        to_group = np.searchsorted(np.flatnonzero(closes), to_link)
        to_same = np.concatenate([[0], np.cumsum(same)])[to_link]
        sizes = {"same": np.diff(to_same, prepend=0), "other": np.diff(to_link - to_same, prepend=0)}
        counts = [np.ones(len(words), np.int64), list(map(len, a_lists)), list(map(len, b_lists)), np.diff(to_group, prepend=0)]
        self.words.add(
            words,
            self._groups(a, b, a_ends, b_ends, ends[closes], to_group),
            np.stack(counts, axis=1),
            {"same": (sizes["same"], a[in_a][same]), "other": (sizes["other"], (a[in_a] * len(b_bytes) + b[in_b])[~same])},
        )

    def _groups(self, a, b, a_ends, b_ends, group_ends, to_group) -> list[str]:
        """Per word its groups as text: ids of A, a bar, ids of B; written for all words at once."""
        keys = np.concatenate([2 * np.searchsorted(group_ends, a_ends), 2 * np.searchsorted(group_ends, b_ends) + 1])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        out, sizes = gathered(self.name_offsets, self.names, np.concatenate([a, b])[order])
        last = np.append(keys[1:] != keys[:-1], True)
        item_ends = np.cumsum(sizes)
        out[item_ends[last] - 1] = np.where(keys[last] % 2 == 0, ord("|"), ord(";"))
        text = out.tobytes().decode()
        word_ends = item_ends[np.searchsorted(keys, 2 * to_group) - 1].tolist()
        return [text[start : end - 1] for start, end in zip([0, *word_ends], word_ends)]


@lru_cache(maxsize=2)
def tables(a_file: bytes, b_file: bytes) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """Bytes of A's and of B's ids, and the identity map."""
    import sentencepiece

    alphabet = byte_alphabet()
    described = json.loads(a_file)
    vocabulary: dict[str, int] = dict(described["model"]["vocab"])
    plain = {token["content"]: token["id"] for token in described.get("added_tokens", [])}
    a_bytes = [b""] * (max([*vocabulary.values(), *plain.values()]) + 1)
    for token, at in vocabulary.items():
        if token not in plain:
            a_bytes[at] = bytes(alphabet[c] for c in token)
    for token, at in plain.items():
        a_bytes[at] = token.encode()
    b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
    pieces = [b.id_to_piece(at) for at in range(b.get_piece_size())]
    single = [b.is_byte(at) for at in range(len(pieces))]
    unwritten = [b.is_control(at) or b.is_unknown(at) for at in range(len(pieces))]
    b_bytes = [
        bytes([int(piece[3:5], 16)]) if one else b"" if none else piece.replace(SPACE, " ").encode()
        for piece, one, none in zip(pieces, single, unwritten)
    ]
    return a_bytes, b_bytes, identity_map(a_bytes, b_bytes, single)


@lru_cache(maxsize=2)
def _pair(a_file: bytes, b_file: bytes) -> Pair:
    """The worker's pair: words met in one task serve the next."""
    return Pair(a_file, b_file)


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _one(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return _lists(np.array([0, len(values)]), values, kind)


ENCODED = (
    "block long, doc_id {id}, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "same array<int>, same_times array<int>, other array<int>, other_times array<int>, "
    "pairs array<int>, pair_docs array<int>, vector array<long>"
)


def encode(docs: DataFrame, a_file: bytes, b_file: bytes, id_col: str, text_col: str, digest_groups: bool) -> DataFrame:
    """Rows of three kinds: documents; blocks with their pairs (``pairs`` not null); a task's vector (``vector`` not null)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), valid_text(text_col).alias("text"))
    schema = ENCODED.format(id=id_type)

    def of_block(pair: Pair, block: int, batch: pa.RecordBatch, vector: np.ndarray) -> Iterator[dict]:
        cut = [pair.cut(text) if text else [] for text in batch.column("text").to_pylist()]
        size = len(cut)
        numbers = pair.known(list(chain.from_iterable(cut)))
        words, docs = pair.words, np.arange(size + 1)
        of_doc = np.repeat(docs[:-1], list(map(len, cut)))
        counts = words.counts[numbers]
        whole = np.ones(size, bool)
        whole[of_doc[counts[:, 0] == 0]] = False  # a word that is not given back takes its document's tokens
        stay = whole[of_doc]
        numbers, of_doc, counts = numbers[stay], of_doc[stay], counts[stay]
        first = np.searchsorted(of_doc, docs)
        sums = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(counts, axis=0)])
        n_a, n_b, n_groups = (np.diff(sums[first], axis=0)[:, at] for at in (1, 2, 3))

        texts = list(map(words.texts.__getitem__, numbers.tolist()))
        groups = [";".join(texts[start:end]) for start, end in zip(first.tolist(), first[1:].tolist())]
        if digest_groups:
            groups = [text and hashlib.sha256(text.encode()).hexdigest() for text in groups]

        columns, found, n_links = {}, {}, np.zeros(size, np.int64)
        for name in ("same", "other"):
            values, sizes = gathered(*words.lists[name], numbers)
            keys, times = np.unique(np.repeat(of_doc, sizes) << 32 | values, return_counts=True)
            found[name] = keys >> 32, keys & 0xFFFFFFFF
            offsets = np.searchsorted(found[name][0], docs)
            columns[name], columns[f"{name}_times"] = (_lists(offsets, column, pa.int32()) for column in (found[name][1], times))
            n_links += np.diff(np.concatenate([[0], np.cumsum(times)])[offsets])
        (same_doc, same), (other_doc, other) = found["same"], found["other"]
        np.add.at(vector, same, 1)
        # A pair of same bytes may also be linked in a group of several; a document counts it once.
        counted = np.isin(other_doc << 32 | other, same_doc << 32 | same * len(pair.b_bytes) + pair.identity[same], invert=True)
        # All pairs of the block, as their counts are asked for; those known by their vector alone add no documents.
        pairs, at = np.unique(other, return_inverse=True)
        yield {
            "block": pa.array(np.full(size, block), pa.int64()),
            "doc_id": batch.column("doc_id"),
            **{name: pa.array(n, pa.int64()) for name, n in zip(("n_a", "n_b", "n_groups", "n_links"), (n_a, n_b, n_groups, n_links))},
            "groups": pa.array(groups, pa.string()),
            **columns,
        }
        yield {
            "block": pa.array([block], pa.int64()),
            "pairs": _one(pairs, pa.int32()),
            "pair_docs": _one(np.bincount(at[counted], minlength=len(pairs)), pa.int32()),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_file, b_file)
        vector = np.zeros(len(pair.a_bytes), np.int64)
        block = TaskContext.get().partitionId() << 32
        for batch in passes(batches):
            for columns in of_block(pair, block, batch, vector):
                yield _row_batch(columns, batch.schema.field("doc_id").type)
            block += 1
        if vector.any():
            yield _row_batch({"block": pa.array([block], pa.int64()), "vector": _one(vector, pa.int64())}, None)

    def _row_batch(columns: dict, id_kind: pa.DataType | None) -> pa.RecordBatch:
        size = len(next(iter(columns.values())))
        kinds = {
            "block": pa.int64(), "doc_id": id_kind or ids, "groups": pa.string(), "vector": pa.list_(pa.int64()),
            **dict.fromkeys(("n_a", "n_b", "n_groups", "n_links"), pa.int64()),
            **dict.fromkeys(("same", "same_times", "other", "other_times", "pairs", "pair_docs"), pa.list_(pa.int32())),
        }
        names = [part.split()[0] for part in schema.split(", ")]
        return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(size, kinds[name])) for name in names], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    ids = to_arrow_type(docs.schema[id_col].dataType)
    return rows.mapInArrow(run, schema)


def corpus_counts(encoded: DataFrame, identity: np.ndarray, width: int) -> DataFrame:
    """(code, n): in how many documents a pair is linked; ``code`` is A's id times ``width`` plus B's."""
    spark = encoded.sparkSession
    vectors = encoded.where("vector IS NOT NULL").select(F.posexplode("vector").alias("a", "n")).where("n > 0")
    same = vectors.groupBy("a").agg(F.sum("n").alias("n"))
    map_rows = [(at, int(b)) for at, b in enumerate(identity) if b >= 0]
    # One row for each id of the vocabulary.
    ids = F.broadcast(spark.createDataFrame(map_rows, "a int, b int"))
    same = same.join(ids, "a").select((F.col("a") * width + F.col("b")).cast("int").alias("code"), "n")
    other = block_pairs(encoded).select("code", "n")
    return same.union(other).groupBy("code").agg(F.sum("n").alias("n"))


def block_pairs(encoded: DataFrame) -> DataFrame:
    """(block, code, n) of the pairs that enter the shuffle: one row for a pair and block, with the block's documents that hold it."""
    listed = encoded.where("pairs IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "pair_docs")).alias("pair"))
    return listed.select("block", F.col("pair.pairs").alias("code"), F.col("pair.pair_docs").cast("long").alias("n"))


def align(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_a: str | None = None,
    tokenizer_b: str | None = None,
    digest_groups: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Per document its alignment, and the corpus counts of linked pairs.

    The first frame is (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), a row for each row given; ``groups`` lists
    the groups as ``a1,a2|b1;a3|b2,b3``, or with ``digest_groups`` the SHA-256 of that. The second is (a_id, b_id, n_docs).

    A is a byte-level BPE (JSON), B a piece model that adds a space; A is given space and text. Null
    and empty texts, and texts whose bytes one of them does not give back, have no tokens: zeros
    and empty groups. Rows repeated, or sharing an id, count as documents each; ids may be of any type. Bytes that
    are no UTF-8 become U+FFFD. No rows in, no rows out, and no pairs.
    """
    spark = docs.sparkSession
    a_file = driver_file(tokenizer_a or tokenizer_path(spark, TOKENIZER_A))
    b_file = driver_file(tokenizer_b or tokenizer_path(spark, TOKENIZER_B))
    a_bytes, b_bytes, identity = tables(a_file, b_file)
    width = len(b_bytes)
    if len(a_bytes) * width >= 1 << 31:
        raise ValueError("the vocabularies are too large for pairs of 31 bits")
    encoded = staged(encode(docs, a_file, b_file, id_col, text_col, digest_groups), "aligned")
    counts = staged(corpus_counts(encoded, identity, width), "pair_counts")

    # Two vectors as long as A's vocabulary: each id's highest count, and that of its identical pair.
    best = np.zeros(len(a_bytes), np.int64)
    for row in counts.groupBy(F.floor(F.col("code") / width).alias("a")).agg(F.max("n").alias("n")).collect():
        best[row["a"]] = row["n"]
    own_code = F.broadcast(docs.sparkSession.createDataFrame([(int(a * width + b),) for a, b in enumerate(identity) if b >= 0], "code int"))
    same = np.zeros(len(a_bytes), np.int64)
    for row in counts.join(own_code, "code").collect():
        same[row["code"] // width] = row["n"]

    known = block_pairs(encoded).select(F.col("block").alias("of_block"), "code").join(counts.hint("merge"), "code")
    of_docs = encoded.where("n_links IS NOT NULL").drop("pairs", "pair_docs", "vector")
    kind = docs.schema[id_col].dataType.simpleString()
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
    found = of_docs.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(_summed(best, same, width), out)
    pairs = counts.select(F.floor(F.col("code") / width).cast("int").alias("a_id"), (F.col("code") % width).alias("b_id"), F.col("n").alias("n_docs"))
    return found, pairs


def _summed(best: np.ndarray, same: np.ndarray, width: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Per document of a block the links with their A id's highest count, and the sum of all links' counts."""

    def per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    def lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
        column = table.column(name).combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.asarray(column.offsets) - column.offsets[0].as_py()

    def run(docs: pa.Table, known: pa.Table) -> pa.Table:
        code = known.column("code").to_numpy()
        order = np.argsort(code)
        code, count = code[order], known.column("n").to_numpy()[order]
        n_best = count_sum = np.zeros(docs.num_rows, np.int64)
        for ids_name, times_name in (("same", "same_times"), ("other", "other_times")):
            ids, offsets = lists(docs, ids_name)
            times, _ = lists(docs, times_name)
            if ids_name == "same":
                n, top = same[ids], best[ids]
            else:
                n = count[np.searchsorted(code, ids)] if len(ids) else ids
                top = best[ids // width]
            n_best = n_best + per_row(times * (n == top), offsets)
            count_sum = count_sum + per_row(times * n, offsets)
        kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        kept = kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(count_sum, pa.int64()))
        return kept.append_column("groups", docs.column("groups"))

    return run
