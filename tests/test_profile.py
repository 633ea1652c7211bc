from pyspark.sql import functions as F

from conftest import rows_of
from visitmart.operators.profile import column_domains, first_rows, null_counts, row_counts, sample_rows


def frame(spark):
    return spark.createDataFrame(
        [("a", 1, True), ("a", 1, True), ("b", None, False), (None, 2, None)], "name string, n int, flag boolean"
    )


def test_row_counts(spark):
    assert rows_of(row_counts(frame(spark))) == [(4, 3, 1)]
    assert rows_of(row_counts(frame(spark).limit(0))) == [(0, 0, 0)]


def test_domains(spark):
    assert set(rows_of(column_domains(frame(spark), ["name", "n", "flag"]))) == {
        ("name", "a"),
        ("name", "b"),
        ("name", None),
        ("n", "1"),
        ("n", "2"),
        ("n", None),
        ("flag", "true"),
        ("flag", "false"),
        ("flag", None),
    }


def test_null_counts(spark):
    assert rows_of(null_counts(frame(spark), ["name", "n"])) == [("n", 1, 3), ("name", 1, 3)]


def test_samples(spark):
    assert rows_of(sample_rows(frame(spark), "n", null=True)) == [("b", None, False)]
    assert sample_rows(frame(spark), "n", null=False, rows=2).count() == 2
    assert sample_rows(frame(spark).where(F.lit(False)), "n", null=True).first() is None


def test_first_rows(spark):
    found = rows_of(first_rows(frame(spark), ["name", "flag"], ["n", "name"]))
    assert sorted(found, key=str) == sorted(
        [
            ("name", True, None, 2, None),
            ("name", False, "b", None, False),
            ("flag", True, None, 2, None),
            ("flag", False, "b", None, False),
        ],
        key=str,
    )
    assert first_rows(frame(spark).limit(0), ["n"], ["n"]).count() == 0
