"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1; a blank, which stands for any run of other
characters, has one too. The vector of a letter trigram binds (multiplies) the vectors of its
letters, each rolled by its place in the trigram. A text bundles (adds) the vectors of all its
trigrams; a language's prototype bundles those of its training texts. The prototype with the
largest cosine to a text names its language.

All sums are sums of whole numbers, so they are the same in any order and on any cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from visitmart.llm.common import arrow_map, text_rows

DIMENSIONS = 2048
SEED = 7
#: Symbols: the blank, a-z, and the slots that other letters are hashed to.
SYMBOLS = 128
UNKNOWN = "und"
#: Texts, and distinct trigrams, that one matrix product takes.
BLOCK_TEXTS = 256
BLOCK_TRIGRAMS = 8192


class Letters:
    """Vectors of symbols and trigrams, and the symbols of texts."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED) -> None:
        draw = np.random.default_rng(seed).integers(0, 2, (SYMBOLS, dimensions), dtype=np.int8)
        base = draw * np.int8(2) - np.int8(1)
        self.rolled = [np.roll(base, place, axis=1) for place in (2, 1, 0)]
        self.known: dict[int, int] = {}

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Symbols of code points of lower-cased text; 0 for what is no letter."""
        distinct, where = np.unique(codes, return_inverse=True)
        for code in distinct.tolist():
            if code not in self.known:
                slot = code - 96 if 97 <= code <= 122 else 27 + (code * 2654435761 >> 9) % (SYMBOLS - 27)
                self.known[code] = slot if chr(code).isalpha() else 0
        return np.array([self.known[c] for c in distinct.tolist()], np.int64)[where]

    def vectors(self, trigrams: np.ndarray) -> np.ndarray:
        first, second, third = trigrams // SYMBOLS**2, trigrams // SYMBOLS % SYMBOLS, trigrams % SYMBOLS
        return (self.rolled[0][first] * self.rolled[1][second] * self.rolled[2][third]).astype(np.float32)

    def trigrams(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, trigram, count) of a few texts; a text without letters has none."""
        padded = [f" {(t or '').lower()} " for t in texts]
        codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
        of_text = np.repeat(np.arange(len(padded)), [len(t) for t in padded])
        symbol = self.symbols(codes)
        kept = symbol > 0
        kept[1:] |= (symbol[:-1] > 0) | (of_text[1:] != of_text[:-1])
        if len(kept):
            kept[0] = True
        symbol, of_text = symbol[kept], of_text[kept]
        whole = of_text[2:] == of_text[:-2]
        found = (symbol[:-2] * SYMBOLS + symbol[1:-1]) * SYMBOLS + symbol[2:]
        key, count = np.unique(of_text[2:][whole] * SYMBOLS**3 + found[whole], return_counts=True)
        return key // SYMBOLS**3, key % SYMBOLS**3, count

    def bundles(self, texts: list[str | None]) -> np.ndarray:
        """One row per text: the sum of its trigrams' vectors."""
        return self.bundles_and_sizes(texts)[0]

    def bundles_and_sizes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``bundles``, and how many trigrams each text has."""
        out = np.zeros((len(texts), self.rolled[0].shape[1]), np.float64)
        sizes = np.zeros(len(texts), np.int64)
        for at in range(0, len(texts), BLOCK_TEXTS):
            some = texts[at : at + BLOCK_TEXTS]
            text, trigram, count = self.trigrams(some)
            np.add.at(sizes, at + text, count)
            distinct, where = np.unique(trigram, return_inverse=True)
            for low in range(0, len(distinct), BLOCK_TRIGRAMS):
                block = distinct[low : low + BLOCK_TRIGRAMS]
                own = (where >= low) & (where < low + len(block))
                counts = np.zeros((len(some), len(block)), np.float32)
                counts[text[own], where[own] - low] = count[own]
                # Whole numbers: exact in 32 bits up to 2**24 trigrams, in 64 beyond.
                if len(count) and count[own].sum() >= 1 << 24:
                    out[at : at + len(some)] += counts.astype(np.float64) @ self.vectors(block)
                else:
                    out[at : at + len(some)] += counts @ self.vectors(block)
        return out, sizes


def decoded(column: pa.Array) -> list[str | None]:
    """The texts of a column; bytes that are no UTF-8 count as U+FFFD, which is no letter."""
    return [None if text is None else text.decode("utf-8", "replace") for text in column.cast(pa.binary()).to_pylist()]


def train(docs: DataFrame, dimensions: int = DIMENSIONS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Prototypes by language from all rows of (text, lang); null languages teach nothing.

    What comes to the driver is one number per language and dimension.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = Letters(dimensions, seed), {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at in range(0, batch.num_rows, BLOCK_TEXTS):
                rows = letters.bundles(decoded(batch.column("text").slice(at, BLOCK_TEXTS)))
                some = np.array(langs[at : at + BLOCK_TEXTS])
                for lang in set(some.tolist()):
                    sums[lang] = sums.get(lang, 0) + rows[some == lang].sum(axis=0)
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang] * dimensions, "place": np.arange(dimensions), "total": vector}
            )

    rows = docs.where("lang IS NOT NULL").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    summed = rows.mapInArrow(partial, "lang string, place long, total double")
    totals = summed.groupBy("lang", "place").agg(F.sum("total").alias("total"))
    prototypes: dict[str, np.ndarray] = {}
    for lang, place, total in totals.toLocalIterator():
        prototypes.setdefault(lang, np.zeros(dimensions))[place] = total
    return prototypes


def tag(
    docs: DataFrame,
    prototypes: dict[str, np.ndarray],
    text_col: str = "text",
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
    names_out: tuple[str, ...] = ("lang_pred", "score"),
) -> DataFrame:
    """The rows with all their columns, and the language and its score (columns of those names are replaced).

    With a third name in ``names_out`` the number of the text's trigrams is added.

    ``score`` is the cosine to the best prototype, 0 where it is negative; equal cosines go to
    the first language by name. Null texts, texts without a letter and all texts if nothing was
    learned get ``und`` and score 0. A text in letters that no prototype knows gets the best
    of the prototypes all the same, with a low score. Rows repeated are returned as often.
    """
    names = sorted(lang for lang, vector in prototypes.items() if vector.any())
    matrix = np.array([prototypes[n] / np.linalg.norm(prototypes[n]) for n in names]) if names else np.zeros((0, dimensions))
    letters: list[Letters] = []
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in names_out])

    def judged(texts: list[str | None]) -> tuple[list[str], list[float], list[int]]:
        has = [any(c.isalpha() for c in t or "") for t in texts]
        if not names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [0] * len(texts)
        bundles, sizes = letters[0].bundles_and_sizes(texts)
        norms = np.linalg.norm(bundles, axis=1)
        cosines = bundles @ matrix.T / np.maximum(norms, 1)[:, None]
        best = cosines.argmax(axis=1)
        top = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
        known = [names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has)]
        return known, [s if ok else 0.0 for s, ok in zip(top.tolist(), has)], sizes.tolist()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not letters:
            letters.append(Letters(dimensions, seed))
        texts = decoded(batch.column(text_col))
        found: tuple[list, list, list] = ([], [], [])
        for at in range(0, len(texts), BLOCK_TEXTS):
            for values, some in zip(found, judged(texts[at : at + BLOCK_TEXTS])):
                values += some
        made = [pa.array(values, kind) for values, kind in zip(found, (pa.string(), pa.float64(), pa.int64()))]
        return pa.RecordBatch.from_arrays([*batch.columns, *made[: len(names_out)]], names=[*batch.schema.names, *names_out])

    new = [StructField(name, kind) for name, kind in zip(names_out, (StringType(), DoubleType(), LongType()))]
    schema = StructType([*rows.schema.fields, *new])
    return arrow_map(rows, work, schema, text_col)


#: Of the training texts of a size, this share may lie below the cosine that a bound is taken from, and the bound is this part of it.
BOUND_SHARE = 0.005
BOUND_PART = 0.5
_STEPS = 1000


def size_class(trigrams: Column) -> Column:
    """Texts of about the same size: the power of two below their number of trigrams. Cosines grow with it."""
    return F.floor(F.log2(F.greatest(trigrams, F.lit(1)).cast("double"))).cast("int")


def least_scores(
    docs: DataFrame, prototypes: dict[str, np.ndarray], share: float = BOUND_SHARE, part: float = BOUND_PART, **options
) -> dict[int, float]:
    """By size class the score below which a text is in no language that was learned.

    It is ``part`` of the cosine that all but ``share`` of the training texts of that size reach; letter noise and unknown
    scripts stay far below it. All training rows (text, lang) count: their cosines are counted in
    thousandths, and these counts, at most a thousand for each power of two, come to the driver. Null
    languages and texts without a letter teach nothing.
    """
    pred, score, size = "lang_pred", "score", "n_trigrams"
    rows = docs.where("lang IS NOT NULL").select("text")
    tagged = tag(rows, prototypes, names_out=(pred, score, size), **options).where(F.col(pred) != UNKNOWN)
    steps = tagged.groupBy(size_class(F.col(size)).alias("size"), F.floor(F.col(score) * _STEPS).alias("step")).count()
    by_size: dict[int, list[tuple[int, int]]] = {}
    for row in steps.collect():
        by_size.setdefault(row["size"], []).append((row["step"], row["count"]))
    bounds = {}
    for size_at, counts in by_size.items():
        left = share * sum(n for _, n in counts)
        for step, n in sorted(counts):
            left -= n
            if left < 0:
                bounds[size_at] = part * step / _STEPS
                break
    return bounds


def reaches(score: Column, trigrams: Column, bounds: dict[int, float]) -> Column:
    """Whether a text's score reaches the bound of its size; sizes that taught nothing take the next smaller one's, or else the smallest one's."""
    if not bounds:
        return F.lit(True)
    least = F.lit(bounds[min(bounds)])
    for size_at in sorted(bounds):
        least = F.when(size_class(trigrams) >= size_at, F.lit(bounds[size_at])).otherwise(least)
    return score >= least


def identify(
    docs: DataFrame,
    prototypes: dict[str, np.ndarray],
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, see ``tag``."""
    return tag(text_rows(docs, id_col, text_col), prototypes, "text", dimensions, seed).drop("text")
