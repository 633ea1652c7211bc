"""Table profile: counts, value domains, nulls and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(frame: DataFrame) -> DataFrame:
    """One row: total rows, distinct rows and rows that repeat another one."""
    groups = frame.groupBy(*frame.columns).agg(F.count("*").alias("copies"))
    total = F.coalesce(F.sum("copies"), F.lit(0))
    return groups.agg(
        total.alias("total_rows"),
        F.count("*").alias("distinct_rows"),
        (total - F.count("*")).alias("duplicate_rows"),
    )


def column_domains(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of each column as text, NULL included, from one pass over the frame."""
    texts = frame.select(*[F.col(name).cast("string").alias(name) for name in columns])
    return texts.unpivot([], list(columns), "column_name", "value").distinct()


def null_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the number of rows without and with a value, from one pass over the frame."""
    counts = frame.agg(F.count("*").alias("__rows"), *[F.count(name).alias(name) for name in columns])
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                (F.col("__rows") - F.col(name)).alias("null_rows"),
                F.col(name).alias("value_rows"),
            )
            for name in columns
        ]
    )
    return counts.select(F.inline(lines))


def sample_rows(frame: DataFrame, column: str, *, null: bool, rows: int = 1) -> DataFrame:
    """A few rows where the column is null, or where it has a value; reads no more than needed."""
    wanted = F.col(column).isNull() if null else F.col(column).isNotNull()
    return frame.where(wanted).limit(rows)


def first_rows(frame: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per column the first row where it is null, and the first where it has a value.

    ``order`` names the columns that rank the rows, nulls first; it should tell all rows apart
    that differ. One aggregate finds all of them; a case without rows has none in the result.
    """
    row = F.struct(*order, *[name for name in frame.columns if name not in order])
    cases = [(name, null, F.col(name).isNull() if null else F.col(name).isNotNull()) for name in columns for null in (True, False)]
    found = frame.agg(*[F.min(F.when(case, row)).alias(f"__{at}") for at, (_, _, case) in enumerate(cases)])
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("profiled_column"), F.lit(null).alias("is_null"), F.col(f"__{at}").alias("row"))
            for at, (name, null, _) in enumerate(cases)
        ]
    )
    return (
        found.select(F.inline(lines))
        .where("row IS NOT NULL")
        .select("profiled_column", "is_null", *[F.col("row").getField(name).alias(name) for name in frame.columns])
    )
