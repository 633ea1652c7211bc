"""SQL text as a distributed DataFrame: over frames, over the catalog, or run at a JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from visitmart.functions.sqlnames import register_sql_functions
from visitmart.session import scratch_table
from visitmart.sinks.load import write_csv


def sql_over_frames(
    spark: SparkSession,
    query: str,
    frames: Mapping[str, DataFrame],
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Run SQL text over frames: ``{name}`` in it stands for the frame of that name.

    ``:name`` parameters are bound. The frames get no name in the session, so views and tables
    of the caller that are called alike stay as they are. A brace of the text itself is doubled.
    """
    register_sql_functions(spark)
    return spark.sql(query, args=dict(params or {}), **frames)


@dataclass(frozen=True)
class Split:
    """How a JDBC result is cut into tasks: ranges of a numeric, date or timestamp column.

    Choose a near-unique column, so that no range holds most of the rows. Bounds only
    place the cuts: rows beyond them, and rows without a value, stay in the result.
    """

    column: str
    parts: int
    lower: Any = None
    upper: Any = None


def read_query(spark: SparkSession, query: str, jdbc: Mapping[str, str], split: Split) -> DataFrame:
    """Result of a query run by the source database, read by ``split.parts`` tasks.

    ``jdbc`` holds Spark's JDBC options (url, driver, user, password, ...). Missing
    bounds are asked from the database with a one-row aggregate. The database runs the query
    once for the bounds and once per part: give bounds where the query aggregates, or let the
    query read a table that the database has made of it.
    """
    query = query.strip().rstrip(";")
    lower, upper = split.lower, split.upper
    if lower is None or upper is None:
        bounds = (
            f"SELECT min({split.column}) AS lo, max({split.column}) AS hi, count(*) AS n FROM ({query}) bounds_of"
        )
        row = spark.read.format("jdbc").options(**jdbc).option("query", bounds).load().first()
        if row[0] is None and row[2] > 0:
            raise ValueError(f"no row has a value in the split column {split.column}")
        lower = row[0] if lower is None else lower
        upper = row[1] if upper is None else upper
    reader = spark.read.format("jdbc").options(**jdbc).option("dbtable", f"({query}) source_query")
    if lower is None or upper is None:
        # An empty result has no cuts to place.
        return reader.load()
    return (
        reader.option("partitionColumn", split.column)
        .option("lowerBound", _bound(lower))
        .option("upperBound", _bound(upper))
        .option("numPartitions", split.parts)
        .load()
    )


def _bound(value: Any) -> str:
    """Bound as Spark reads it; numbers must be whole there, and a cut need not be exact."""
    return str(int(value)) if isinstance(value, (Decimal, float)) else str(value)


class SqlFrames:
    """Runs SQL text and hands back a DataFrame that stays on the executors.

    Without ``jdbc`` the SQL is Spark's and sees the session catalog; with it the
    database runs the SQL. Results that were also written as CSV are kept in tables that this
    object owns: use it in a ``with`` block, or call ``close``, to drop them.
    """

    def __init__(self, spark: SparkSession, jdbc: Mapping[str, str] | None = None):
        self.spark = spark
        self.jdbc = jdbc
        self.kept: list[str] = []

    def __enter__(self) -> SqlFrames:
        return self

    def __exit__(self, *error) -> None:
        self.close()

    def close(self) -> None:
        """Drop the tables behind the frames of ``save_csv``; such frames end here."""
        while self.kept:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.kept.pop()}")

    # This call's name, arguments and their defaults.
    def create_df(
        self,
        sql: str,
        save_csv: bool = False,
        file_path: str = "./df.csv",
        split: Split | None = None,
    ) -> DataFrame:
        """Frame of the query; ``save_csv`` also writes it as a CSV folder with NaN for null.

        For that the result is written once as a table, from which the file and the frame are
        taken, so that the query runs once and both hold the same rows. ``split`` says how a
        JDBC result is read in parallel and is needed there.
        """
        if self.jdbc is None:
            register_sql_functions(self.spark)
            frame = self.spark.sql(sql)
        elif split is None:
            raise ValueError("a JDBC query needs a split column, or one task would read the whole result")
        else:
            frame = read_query(self.spark, sql, self.jdbc, split)
        if save_csv:
            frame = self._kept(frame)
            write_csv(frame, file_path)
        return frame

    def _kept(self, frame: DataFrame) -> DataFrame:
        """The frame's rows as a table of this object; columns without a type become text."""
        table = scratch_table(self.spark, "sql_frame")
        untyped = {name: frame[name].cast("string") for name, kind in frame.dtypes if kind == "void"}
        frame.withColumns(untyped).write.format("parquet").saveAsTable(table)
        self.kept.append(table)
        return self.spark.table(table)
