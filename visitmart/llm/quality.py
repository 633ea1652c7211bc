"""Quality classifier: naive Bayes support vectors.

A text's features are indicators of hashed n-grams: single words, word pairs, and runs of one to
three word shapes. Each indicator is scaled by the log ratio of its smoothed shares in the two
classes, counted over all labelled training rows. A linear model with hinge loss is fitted to the
scaled indicators by dual coordinate descent, on a sample of at most ``SAMPLE_ROWS`` labelled
rows. Margins become scores between 0 and 1 by a logistic curve fitted to the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import arrow_map, passes, small_side, staged, text_rows
from visitmart.llm.words import LOWER, SPACED, column_bytes, mixed, run_hashes, word_spans

FEATURES = 1 << 18
#: Labelled rows, at most, that the margin is fitted on; counts are taken over all labelled rows.
SAMPLE_ROWS = 8000
#: Features, at most, of all rows of the sample; bounds the driver's memory where texts are long.
SAMPLE_FEATURES = 16_000_000
SMOOTHING = 1.0
COST = 0.05
ROUNDS = 12
THRESHOLD = 0.3
LABEL_ROW_BYTES = 64
#: Range of the hashes that the sample is drawn by, and the steps that they are counted in.
DRAWS = 1 << 40
DRAW_STEPS = 1 << 16

#: What a byte tells of a word's shape, one bit each: lower case, upper case, digit, end of a
#: sentence or clause, other ASCII sign, byte of a letter beyond ASCII.
SHAPE = np.zeros(256, np.uint8)
SHAPE[0x21:0x7F] = 16
SHAPE[0x61:0x7B] = 1
SHAPE[0x41:0x5B] = 2
SHAPE[0x30:0x3A] = 4
SHAPE[[ord(c) for c in ".,;:?'\"()-"]] = 8
SHAPE[0x80:] = 32
#: Word lengths in bytes from which on a word counts as longer.
LONGER = np.array([2, 4, 8, 16])


def features(column: pa.Array, buckets: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each row: (index of each row's first feature and one more, features)."""
    data, offsets = column_bytes(column)
    starts, ends, first = word_spans(data, offsets, SPACED)
    rows = len(first) - 1
    row_of = np.repeat(np.arange(rows), np.diff(first))
    words = run_hashes(LOWER[data], starts, ends)
    shape = np.zeros(0, np.uint64)
    if len(starts):
        shape = np.bitwise_or.reduceat(SHAPE[data], starts).astype(np.uint64)
        again = np.zeros(len(words), np.uint64)
        again[1:] = (words[1:] == words[:-1]) & (row_of[1:] == row_of[:-1])
        shape |= np.searchsorted(LONGER, ends - starts, side="right").astype(np.uint64) << np.uint64(8)
        shape |= again << np.uint64(16)
    found = [np.zeros(0, np.int64)]
    for kind, (values, size) in enumerate(((words, 1), (words, 2), (shape, 1), (shape, 2), (shape, 3))):
        at = np.arange(max(0, len(values) - size + 1))
        at = at[row_of[at] == row_of[at + size - 1]] if len(at) else at
        hashed = mixed(run_hashes(values, at, at + size) + np.uint64(kind))
        bucket = (hashed % np.uint64(buckets)).astype(np.int64)
        found.append(row_of[at] * buckets + bucket if len(at) else at)
    distinct = np.unique(np.concatenate(found))
    return np.searchsorted(distinct, np.arange(rows + 1) * buckets), distinct % buckets


@dataclass
class Model:
    """Weights of the features (log ratios times the fitted weights), offset, and the logistic curve."""

    weights: np.ndarray
    offset: float
    slope: float
    shift: float
    #: Rows that the margin was fitted on.
    rows_used: int = 0

    def scores(self, column: pa.Array) -> np.ndarray:
        first, found = features(column, len(self.weights))
        return self.curve(margins(first, self.weights[found]) + self.offset)

    def curve(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -40, 40)))


def margins(first: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Sums of parts row by row, each divided by the root of the row's number of features."""
    count = np.diff(first)
    out = np.zeros(len(count))
    some = count > 0
    if some.any():
        out[some] = np.add.reduceat(parts, first[:-1][some]) / np.sqrt(count[some])
    return out


def fit(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float = COST, rounds: int = ROUNDS) -> Model:
    """Dual coordinate descent for the hinge loss (L1), over rows of scaled indicators.

    One multiplier per row, between 0 and ``cost``; each step solves for one of them and keeps
    the weights in step. Rows are visited in a new order each round, from a fixed seed.
    """
    sign = np.where(labels > 0, 1.0, -1.0)
    weights, offset = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    scaled = [ratio[r] / np.sqrt(max(1, len(r))) for r in rows]
    norm = np.array([s @ s + 1 for s in scaled])
    # The smaller class counts as much as the larger.
    limit = cost * np.where(sign > 0, len(rows) / max(1, 2 * (sign > 0).sum()), len(rows) / max(1, 2 * (sign < 0).sum()))
    draw = np.random.default_rng(0)
    for _ in range(rounds):
        for i in draw.permutation(len(rows)):
            gradient = sign[i] * (weights[rows[i]] @ scaled[i] + offset) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), limit[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                weights[rows[i]] += step * scaled[i]
                offset += step
                alpha[i] = new
    model = Model(weights * ratio, offset, 1.0, 0.0)
    margin = np.array([weights[r] @ s for r, s in zip(rows, scaled)]) + offset
    model.slope, model.shift = _logistic(margin, labels)
    return model


def _logistic(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve of the labels over the margins, by Newton steps.

    Labels are drawn in a little from 0 and 1, so that the curve stays finite where the classes part cleanly.
    """
    if not len(margin):
        return 1.0, 0.0
    ones = (labels > 0).sum()
    goal = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (len(labels) - ones + 2))
    at = np.array([1.0, 0.0])
    x = np.column_stack([margin, np.ones(len(margin))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -40, 40)))
        slope = x.T @ (p - goal) + 1e-6 * at
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at -= step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def _bound(taught: DataFrame, wanted: int) -> int:
    """The least end of a step below which ``wanted`` of the rows' draws lie; the range's end if there are not so many."""
    width = DRAWS // DRAW_STEPS
    steps = taught.groupBy(F.floor(F.col("draw") / width).cast("long").alias("step")).agg(F.count("*").alias("n"))
    within = 0
    for step, n in sorted(map(tuple, steps.collect())):
        within += n
        if within >= wanted:
            return (step + 1) * width
    return DRAWS


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    buckets: int = FEATURES,
    sample_rows: int = SAMPLE_ROWS,
    sample_features: int = SAMPLE_FEATURES,
) -> Model:
    """A model from all rows of the documents that have a label 0 or 1.

    The margin is fitted on ``sample_rows`` of these rows, or all if there are fewer, up to ``sample_features`` features
    in all and one row at least; ``Model.rows_used`` tells on how many.
    Rows with other labels or null ids teach nothing; a document with both labels teaches both.
    Without labelled rows the model scores 0.5 throughout; with one class, that class.
    """
    known = labels.select(
        F.col("doc_id").cast("long").alias("_id"), F.col(f"`{label_col}`").cast("int").alias("label")
    ).where("_id IS NOT NULL AND label IN (0, 1)").distinct()
    rows = text_rows(docs, id_col, text_col)
    taught = rows.join(small_side(known, LABEL_ROW_BYTES), F.col("doc_id") == F.col("_id")).drop("_id")
    # Rows in the sample: those with the smallest hashes. The bound leaves in as many as are wanted, and some of its step.
    taught = taught.withColumn("draw", F.pmod(F.xxhash64("doc_id", "label"), F.lit(DRAWS)))
    bound = _bound(taught, sample_rows)
    marked = taught.select("text", "label", (F.col("draw") < F.lit(bound)).alias("chosen"), "draw")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), np.int64)
        for batch in passes(batches):
            first, found = features(batch.column("text"), buckets)
            own = batch.column("label").to_numpy(zero_copy_only=False)
            each = np.repeat(own, np.diff(first))
            for label in (0, 1):
                counts[label] += np.bincount(found[each == label], minlength=buckets)
            some = np.flatnonzero(batch.column("chosen").to_numpy(zero_copy_only=False))
            if len(some):
                draw = batch.column("draw").to_pylist()
                yield rows_out(
                    [int(own[i]) for i in some], [draw[i] for i in some], [found[first[i] : first[i + 1]] for i in some]
                )
        for label in (0, 1):
            some = np.flatnonzero(counts[label])
            if len(some):
                yield counts_out(label, some, counts[label][some])

    def rows_out(label: list[int], draw: list[int], lists: list[np.ndarray]) -> pa.RecordBatch:
        n, none = len(label), pa.nulls(len(label), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(label, pa.int64()), pa.array(draw, pa.int64()), pa.array(lists, pa.list_(pa.int64())), none, none], names=names
        )

    def counts_out(label: int, some: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        size = len(some)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(size, label), pa.int64()),
                pa.nulls(size, pa.int64()),
                pa.nulls(size, pa.list_(pa.int64())),
                pa.array(some, pa.int64()),
                pa.array(n, pa.int64()),
            ],
            names=names,
        )

    names = ["label", "draw", "found", "feature", "n"]
    schema = "label long, draw long, found array<long>, feature long, n long"
    both = staged(marked.mapInArrow(run, schema), "quality_training")
    ratio = np.full((2, buckets), SMOOTHING)
    sums = both.where("feature IS NOT NULL").groupBy("label", "feature").agg(F.sum("n").alias("n"))
    for label, feature, n in sums.toLocalIterator():
        ratio[label][feature] += n
    ratio = ratio / ratio.sum(axis=1, keepdims=True)
    ratio = np.log(ratio[1] / ratio[0])

    sample = both.where("draw IS NOT NULL").select("draw", "label", "found").orderBy("draw", "label").limit(sample_rows)
    lists: list[np.ndarray] = []
    truth: list[int] = []
    held = 0
    for row in sample.toLocalIterator():
        held += len(row.found)
        if lists and held > sample_features:
            break
        lists.append(np.array(row.found, np.int32))
        truth.append(row.label)
    model = fit(lists, np.array(truth, int), ratio)
    model.rows_used = len(lists)
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row: how likely label 1 is, from the text alone.

    Null and empty texts have no features and get the model's offset. Repeated rows get equal scores.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(model.scores(batch.column("text")), pa.float64())], names=["doc_id", "score"]
        )

    return arrow_map(text_rows(docs, id_col, text_col), work, "doc_id long, score double")
