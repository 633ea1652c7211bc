"""Replace a date window of a mart that is partitioned by day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.functions.daywindow import DayWindow
from visitmart.sinks import versions
from visitmart.sinks.stage import in_table_order, insert_over, spread_by, staged

DAY_COLUMN = "event_day"


def with_day(frame: DataFrame, time_col: str = "event_at") -> DataFrame:
    """The frame with the partition column of the mart."""
    return frame.withColumn(DAY_COLUMN, F.col(time_col).cast("date"))


def spread_by_day(frame: DataFrame) -> DataFrame:
    """Rows of a day brought together, so that a load writes few files per day."""
    return spread_by(frame, DAY_COLUMN)


def create_mart(frame: DataFrame, mart: str, time_col: str = "event_at") -> None:
    """Table partitioned by day, holding the frame and published in versions."""
    spark = frame.sparkSession
    if spark.catalog.tableExists(mart) or versions.is_versioned(spark, mart):
        raise ValueError(f"{mart} exists")
    versions.publish(with_day(frame, time_col), mart, versions.newest(spark, mart), DAY_COLUMN, spread=spread_by_day)


def replace_window(frame: DataFrame, mart: str, window: DayWindow, time_col: str = "event_at") -> None:
    """Delete the mart's rows in the window and add the frame's rows, as one publication.

    ``mart`` comes from ``create_mart``. A reader sees the mart before or after, never between. Only
    the window's days are written, so the cost follows the window, not the mart. A load that fails changes
    nothing; of two loads at once the second raises ``ConcurrentLoad`` and can be run again.

    With bounds inside a day, the old rows of that day outside the window are kept. The
    rows of a daily mart lie at midnight, so give it bounds at midnight: a day that the
    window only cuts would keep its old row and get a second one.

    A managed table partitioned by ``event_day`` that was made otherwise is rewritten in place, days first and
    emptied days after: ``adopt_mart`` turns it into one that is published.
    """
    spark = frame.sparkSession
    if not versions.is_versioned(spark, mart):
        _replace_in_place(frame, mart, window, time_col)
        return
    base = versions.newest(spark, mart)
    fresh = with_day(frame, time_col)
    if not window.whole_days:
        fresh = fresh.unionByName(_kept_of_cut_days(spark.table(base.table).drop(versions.LOAD_COLUMN), window, time_col))

    versions.publish(
        fresh,
        mart,
        base,
        DAY_COLUMN,
        keep=lambda value: not _within(window, _day(value)),
        accept=lambda values: _check_inside(window, {_day(value) for value in values}),
        spread=spread_by_day,
    )


def adopt_mart(spark: SparkSession, table: str, mart: str) -> None:
    """Publish a table partitioned by ``event_day`` under a new name; the table stays."""
    base = versions.newest(spark, mart)
    versions.publish(spark.table(table), mart, base, DAY_COLUMN, spread=spread_by_day)


def _kept_of_cut_days(rows: DataFrame, window: DayWindow, time_col: str) -> DataFrame:
    """Old rows of the days that the window reaches which lie outside its bounds."""
    inside = F.coalesce(window.holds(F.col(time_col)), F.lit(False))
    affected = F.col(DAY_COLUMN).between(F.lit(window.first_day), F.lit(window.last_day))
    return rows.where(affected & ~inside)


def _check_inside(window: DayWindow, days: set[date | None]) -> None:
    outside = [day for day in days if not _within(window, day)]
    if outside:
        raise ValueError(f"new rows lie outside the window: {outside[:5]}")


def _replace_in_place(frame: DataFrame, mart: str, window: DayWindow, time_col: str) -> None:
    """Days overwritten by partition, then emptied days dropped. The rows are staged first; running it again mends a failure after that."""
    spark = frame.sparkSession
    fresh = in_table_order(with_day(frame, time_col), mart)
    if not window.whole_days:
        fresh = fresh.unionByName(_kept_of_cut_days(spark.table(mart), window, time_col))
    with staged(spread_by_day(fresh), mart, DAY_COLUMN) as stage:
        new_days = _days(spark, stage)
        _check_inside(window, new_days)
        emptied = [day for day in _days(spark, mart) if _within(window, day) and day not in new_days]
        insert_over(spark, stage, mart, "dynamic")
        if emptied:
            specs = ", ".join(f"PARTITION ({DAY_COLUMN} = DATE '{day}')" for day in emptied)
            spark.sql(f"ALTER TABLE {mart} DROP IF EXISTS {specs}")


def overwrite_window(frame: DataFrame, mart: str, window: DayWindow, time_col: str = "event_at") -> None:
    """As ``replace_window``, in one commit, for table formats that overwrite by condition.

    No such format is installed here: this has only been run against a stand-in for a frame.
    """
    frame.writeTo(mart).overwrite(window.holds(F.col(time_col)))


def _within(window: DayWindow, day: date | None) -> bool:
    return day is not None and window.first_day <= day <= window.last_day


def _days(spark: SparkSession, table: str) -> set[date | None]:
    """Day partitions of a table, from the catalog; there is one entry per calendar day."""
    values = (row[0].split("=", 1)[1] for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return {_day(None if value == "__HIVE_DEFAULT_PARTITION__" else value) for value in values}


def _day(value: str | None) -> date | None:
    return None if value is None else date.fromisoformat(value)
