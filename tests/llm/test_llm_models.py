"""Language ID and the quality classifier: held-out accuracy, and the parts by hand."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from llm_rows import DOCS, no_docs, odd_docs, odd_rows
from visitmart.llm import langid, quality, queries

SF = "/root/testdata/sf0.01"


def test_language_query_on_held_out_documents(spark):
    truth = {row.doc_id: (row.lang, row.n_chars) for row in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = queries.QUERIES["op9_language_id"](spark, SF).collect()
    assert {row.doc_id for row in found} == set(truth)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in found)
    assert all(0 <= row.score <= 1 for row in found)
    held = [row for row in found if row.held_out]
    assert np.mean([row.lang_pred == truth[row.doc_id][0] for row in held]) > 0.97
    again = queries.QUERIES["op9_language_id"](spark, SF).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_trigrams_and_vectors():
    letters = langid.Letters(64)
    text, trigram, count = letters.trigrams(["Ab", None, "a1b", "", "aa aa"])
    blank, a, b = 0, 1, 2
    number = lambda x, y, z: (x * langid.SYMBOLS + y) * langid.SYMBOLS + z
    found = {(t, g): c for t, g, c in zip(text.tolist(), trigram.tolist(), count.tolist())}
    assert found == {
        (0, number(blank, a, b)): 1, (0, number(a, b, blank)): 1,
        (2, number(blank, a, blank)): 1, (2, number(a, blank, b)): 1, (2, number(blank, b, blank)): 1,
        (4, number(blank, a, a)): 2, (4, number(a, a, blank)): 2, (4, number(a, blank, a)): 1,
    }
    base = letters.rolled[2]
    bound = np.roll(base[a], 2) * np.roll(base[b], 1) * base[blank]
    assert (letters.vectors(np.array([number(a, b, blank)]))[0] == bound).all()
    sums = letters.bundles(["aa aa", None])
    assert (sums[1] == 0).all()
    parts = [2 * letters.vectors(np.array([number(*g)]))[0] for g in ((blank, a, a), (a, a, blank))]
    assert (sums[0] == sum(parts) + letters.vectors(np.array([number(a, blank, a)]))[0]).all()


def test_blocks_do_not_change_bundles(monkeypatch):
    texts = [row[1] for row in odd_rows()]
    whole = langid.Letters(64).bundles(texts)
    monkeypatch.setattr(langid, "BLOCK_TRIGRAMS", 7)
    monkeypatch.setattr(langid, "BLOCK_TEXTS", 3)
    assert (langid.Letters(64).bundles(texts) == whole).all()


def test_languages_of_odd_rows(spark):
    docs = odd_docs(spark)
    prototypes = langid.train(docs, 256)
    assert set(prototypes) == {"en", "fr"}
    found = langid.identify(docs, prototypes, dimensions=256).collect()
    assert len(found) == docs.count()
    texts = {(row[0], row[1]) for row in odd_rows()}
    lettered = {doc_id for doc_id, text in texts if any(c.isalpha() for c in text or "")}
    for row in found:
        assert row.lang_pred in ("en", "fr", "und") and 0 <= row.score <= 1
        assert (row.lang_pred == "und") == (row.doc_id not in lettered) or row.doc_id in (None, 8)
    tagged = langid.tag(docs, prototypes, dimensions=256)
    assert sorted(tagged.columns) == sorted(docs.columns)
    unlearned = langid.identify(docs, {}).select("lang_pred", "score").distinct().collect()
    assert [tuple(row) for row in unlearned] == [("und", 0.0)]
    assert langid.train(no_docs(spark)) == {} and langid.identify(no_docs(spark), prototypes, dimensions=256).count() == 0


def test_quality_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    found = {row.doc_id: row for row in queries.QUERIES["op10_quality"](spark, folder).collect()}
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in found.values())
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in found.values())
    held = [row for row in spark.read.parquet(f"{folder}/labels.parquet").collect() if found[row.doc_id].held_out]
    scores, truth = np.array([found[r.doc_id].score for r in held]), np.array([r.quality for r in held])
    assert (scores[truth == 1][:, None] > scores[truth == 0][None, :]).mean() > 0.97
    predicted = scores >= 0.3
    assert np.mean(predicted[truth == 1]) > 0.97 and np.mean(predicted[truth == 0]) < 0.15


def test_features_are_indicators_of_each_row():
    column = pa.array(["a b a b", None, "", "B!! c", "a b a b", "x" * 50_000])
    first, found = quality.features(column, 1 << 20)
    rows = [set(found[first[i] : first[i + 1]].tolist()) for i in range(len(column))]
    # words a, b; pairs ab, ba; the shapes of all words are equal: one run of each length
    assert len(rows[0]) == 2 + 2 + 3 and rows[0] == rows[4]
    assert rows[1] == rows[2] == set()
    alone = [quality.features(column.slice(i, 1), 1 << 20)[1].tolist() for i in range(len(column))]
    assert [sorted(r) for r in rows] == [sorted(a) for a in alone]


def test_descent_ends_at_the_optimum():
    """Primal and dual objective of the hinge loss meet."""
    rng = np.random.default_rng(0)
    rows = [np.unique(rng.integers(0, 40, 8)) for _ in range(120)]
    labels = np.array([int(r.sum() + rng.normal(0, 20) > 150) for r in rows])
    ratio = rng.normal(0, 1, 40)
    cost = 0.5
    model = quality.fit(rows, labels, ratio, cost, rounds=400)
    weights = np.where(ratio != 0, model.weights / ratio, 0)
    sign = np.where(labels > 0, 1, -1)
    limit = cost * np.where(sign > 0, 120 / (2 * (sign > 0).sum()), 120 / (2 * (sign < 0).sum()))
    margin = np.array([weights[r] @ ratio[r] / np.sqrt(len(r)) for r in rows]) + model.offset
    primal = 0.5 * (weights @ weights + model.offset**2) + (limit * np.maximum(0, 1 - sign * margin)).sum()
    rougher = quality.fit(rows, labels, ratio, cost, rounds=3)
    w = np.where(ratio != 0, rougher.weights / ratio, 0)
    m = np.array([w[r] @ ratio[r] / np.sqrt(len(r)) for r in rows]) + rougher.offset
    assert primal <= 0.5 * (w @ w + rougher.offset**2) + (limit * np.maximum(0, 1 - sign * m)).sum() + 1e-6
    # The gradient step of every row with slack is zero: points off the margin are at a bound.
    assert np.mean(margin * sign > 0) > 0.6


@pytest.mark.parametrize("labels", [[], [(0, 1)], [(0, 0)], [(0, 1), (0, 0), (1, None), (2, 7), (None, 1), (9, 1)]])
def test_odd_labels_and_rows(spark, labels):
    docs = odd_docs(spark)
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(docs, frame, buckets=1 << 10)
    found = quality.score(docs, model).collect()
    assert len(found) == docs.count() and all(0 <= row.score <= 1 for row in found)
    if not labels:
        assert {row.score for row in found} == {0.5}
    assert quality.score(no_docs(spark), model).count() == 0 and DOCS


def test_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(at, f"w{at} " + ("good" if at % 2 else "bad!!"), None, None, 0) for at in range(400)], DOCS)
    labels = spark.createDataFrame([(at, at % 2) for at in range(400)], "doc_id long, quality int")
    model = quality.train(docs, labels, buckets=1 << 12, sample_rows=50)
    scores = {row.doc_id: row.score for row in quality.score(docs, model).collect()}
    assert min(scores[at] for at in range(1, 400, 2)) > max(scores[at] for at in range(0, 400, 2))


@pytest.mark.parametrize("taught, fitted", [(400, 50), (30, 30)])
def test_labels_without_documents_do_not_shrink_the_sample(spark, monkeypatch, taught, fitted):
    docs = spark.createDataFrame([(at, f"w{at} " + ("good" if at % 2 else "bad!!"), None, None, 0) for at in range(taught)], DOCS)
    labels = spark.range(40_000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    sizes, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows, *rest: sizes.append(len(rows)) or fit(rows, *rest))
    model = quality.train(docs, labels, buckets=1 << 12, sample_rows=50)
    assert sizes == [fitted]
    scores = {row.doc_id: row.score for row in quality.score(docs, model).collect()}
    assert min(scores[at] for at in range(1, taught, 2)) > max(scores[at] for at in range(0, taught, 2))


def test_primal_equals_dual_at_the_end_of_the_descent():
    """The gap between hinge loss with penalty and the dual closes, so the fit is the optimum and not just a good point."""
    rng = np.random.default_rng(4)
    size, count = 40, 60
    rows = [np.sort(rng.choice(size, rng.integers(3, 9), replace=False)) for _ in range(count)]
    labels = rng.integers(0, 2, count)
    ratio = rng.normal(size=size)
    scaled = np.zeros((count, size + 1))
    for at, row in enumerate(rows):
        scaled[at, row] = ratio[row] / np.sqrt(len(row))
    scaled[:, size] = 1  # the offset is a weight of its own
    sign = np.where(labels > 0, 1.0, -1.0)
    limit = np.where(sign > 0, count / (2 * (sign > 0).sum()), count / (2 * (sign < 0).sum())) * quality.COST
    gaps = []
    for rounds in (1, 20, 3000):
        model = quality.fit(rows, labels, ratio, rounds=rounds)
        w = np.append(model.weights / ratio, model.offset)
        primal = w @ w / 2 + (limit * np.maximum(0, 1 - sign * (scaled @ w))).sum()
        # By strong duality no point is lower than the best of the dual, found here by projected steps.
        gaps.append(primal)
    gram = (sign[:, None] * scaled) @ (sign[:, None] * scaled).T
    alpha = np.zeros(count)
    for _ in range(40000):
        alpha = np.clip(alpha - (gram @ alpha - 1) / np.linalg.norm(gram, 2), 0, limit)
    dual = alpha.sum() - alpha @ gram @ alpha / 2
    assert gaps[0] >= gaps[2] - 1e-9 and gaps[1] >= dual - 1e-6
    assert gaps[2] - dual < 1e-3 * abs(dual)


def test_sample_is_bounded_by_parameters_and_reported(spark):
    docs = spark.createDataFrame([(at, f"good words number {at}" if at % 2 else f"bad ones {at}") for at in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(at, at % 2) for at in range(60)], "doc_id long, quality int")
    assert quality.train(docs, labels).rows_used == 60
    assert quality.train(docs, labels, sample_rows=20).rows_used == 20
    assert 1 <= quality.train(docs, labels, sample_features=100).rows_used < 20
    assert quality.train(docs, labels, sample_features=1).rows_used == 1


def test_languages_equal_loops_over_letters_and_trigrams(spark):
    """Prototypes, cosines and labels of a few rows, bound and bundled letter by letter."""
    texts = {"en": ["the cat and the dog", "this is it"], "fr": ["le chat et le chien", "c'est ça"]}
    rows = [(at, text, lang) for at, (lang, text) in enumerate((lang, text) for lang, both in texts.items() for text in both)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    size = 128
    letters = langid.Letters(size)
    base = letters.rolled[2].astype(int)

    def vector(text):
        symbols, out = [0], np.zeros(size, int)
        for c in text.lower():
            at = 0 if not c.isalpha() else ord(c) - 96 if "a" <= c <= "z" else 27 + (ord(c) * 2654435761 >> 9) % (langid.SYMBOLS - 27)
            if at or symbols[-1]:
                symbols.append(at)
        symbols += [0] if symbols[-1] else []
        for a, b, c in zip(symbols, symbols[1:], symbols[2:]):
            out += np.roll(base[a], 2) * np.roll(base[b], 1) * base[c]
        return out

    own = {lang: sum(vector(text) for text in both) for lang, both in texts.items()}
    cosine = lambda a, b: float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
    found = langid.identify(docs, langid.train(docs, size), dimensions=size).collect()
    for row, (_, text, _) in zip(sorted(found), rows):
        best = max(own, key=lambda lang: (cosine(vector(text), own[lang]), lang))
        assert row.lang_pred == best and abs(row.score - cosine(vector(text), own[best])) < 1e-9
