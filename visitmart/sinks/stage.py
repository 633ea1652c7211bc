"""A written copy of new rows, made before a target is touched."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


@contextmanager
def staged(frame: DataFrame, target: str, *partition_by: str) -> Iterator[str]:
    """Name of a table next to the target that holds the frame's rows; dropped afterwards.

    What can fail in the frame's own work fails here, with the target still whole. The
    frame may also read the target.
    """
    stage = f"{target}__stage_{uuid.uuid4().hex}"
    try:
        frame.write.partitionBy(*partition_by).format("parquet").saveAsTable(stage)
        yield stage
    finally:
        frame.sparkSession.sql(f"DROP TABLE IF EXISTS {stage}")


def spread_by(frame: DataFrame, column: str | None) -> DataFrame:
    """Rows of a partition brought together, so that a load writes few files for each.

    The rebalance lets adaptive execution cut a partition that holds more than a file's worth,
    and it is left out where adaptive execution is off.
    """
    return frame.hint("rebalance", column) if column else frame


def in_table_order(frame: DataFrame, table: str) -> DataFrame:
    """The frame's columns by name in the order of the table, which must have them all."""
    columns = frame.sparkSession.table(table).columns
    unknown = {name.lower() for name in frame.columns} - {name.lower() for name in columns}
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(sorted(unknown))}")
    return frame.select(*columns)


def insert_over(spark: SparkSession, source: str, table: str, mode: str) -> None:
    """Overwrite a table by the rows of another one, in the given partition overwrite mode.

    ``static`` empties the whole table, ``dynamic`` the partitions that the new rows are in. The
    insert takes the mode from its session and from nowhere else, so it runs in a session of its
    own: the caller's session, and other threads in it, keep their setting.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    own.catalog.setCurrentCatalog(spark.catalog.currentCatalog())
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    in_table_order(own.table(source), table).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
