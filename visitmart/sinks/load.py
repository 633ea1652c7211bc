"""Truncate-and-load and CSV export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from visitmart.sinks import versions
from visitmart.sinks.stage import in_table_order, insert_over, spread_by, staged


def truncate_load(frame: DataFrame, table: str, *, direct: bool = False) -> None:
    """Replace all rows of a catalog table, keeping its definition; create it if it is missing.

    Columns are matched by name. Tables made here are published in versions (``versions.py``): readers see the
    old rows until all new ones are there, a load that fails changes nothing, of two loads at once the
    second raises ``ConcurrentLoad``, and the frame may read the target.

    Tables that others made are emptied and filled: rows of partitions that the new rows don't reach go as
    well, whatever partition overwrite mode the session has. The rows are staged first, so that the
    target is empty only while finished rows are copied. ``direct`` writes them once, by truncate and append: for
    frames that don't read the target, where an empty target after a failure does no harm.
    """
    spark = frame.sparkSession
    if versions.is_versioned(spark, table):
        base = versions.newest(spark, table)
        versions.publish(frame, table, base, base.partition_by, spread=lambda rows: spread_by(rows, base.partition_by))
    elif not spark.catalog.tableExists(table):
        if versions.can_hold(spark, table):
            versions.publish(frame, table, versions.newest(spark, table))
        else:
            frame.write.saveAsTable(table)
    elif direct:
        rows = in_table_order(frame, table)
        spark.sql(f"TRUNCATE TABLE {table}")
        rows.write.insertInto(table)
    else:
        with staged(in_table_order(frame, table), table) as stage:
            insert_over(spark, stage, table, "static")


def truncate_load_jdbc(frame: DataFrame, table: str, jdbc: Mapping[str, str]) -> None:
    """Empty a database table, then append; the table's definition stays."""
    (
        frame.write.format("jdbc")
        .options(**jdbc)
        .option("dbtable", table)
        .option("truncate", "true")
        .mode("overwrite")
        .save()
    )


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV folder with a header in each file and ``NaN`` for null.

    Text is written as it is, blanks included, and quotes are doubled. There is no row
    number column, as distributed rows have no order.
    """
    (
        frame.write.mode("overwrite")
        .option("header", True)
        .option("nullValue", "NaN")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
