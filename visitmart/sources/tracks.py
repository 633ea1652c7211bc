"""Event tracks of several sources as one frame.

Every plan works on rows ``(anonymous_id, source, received_at, active_at, event)``;
``active_at`` is the stamp that decides the day. They come from one table per source
(``stack_tracks``) or from one log that holds all sources (``split_log``). Stamps are
zone-less UTC; zoned columns are converted.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from visitmart.functions.daywindow import DayWindow, utc_ntz

# The platforms in output order, and the platform that each source counts for.
PLATFORMS = ("web", "aos", "ios")
SOURCE_PLATFORM = {"web": "web", "click": "web", "aos": "aos", "ios": "ios"}
# The column that decides the day, per source table.
DAY_STAMP = {"web": "timestamp", "click": "received_at", "aos": "timestamp", "ios": "timestamp"}


def on_platform(platform: str) -> str:
    """Condition for track rows of a platform, as SQL."""
    names = [f"'{source}'" for source, of in SOURCE_PLATFORM.items() if of == platform]
    return f"source IN ({', '.join(names)})"


def platform_of() -> str:
    """Platform of a track row, as SQL."""
    cases = [f"WHEN {on_platform(platform)} THEN '{platform}'" for platform in PLATFORMS]
    return f"CASE {' '.join(cases)} END"


@dataclass(frozen=True)
class TrackTable:
    """One source table and the columns to read from it.

    ``day`` names a partition column with the UTC date of ``active_at``, if there is
    one: a window then opens the files of its own days only.
    """

    frame: DataFrame
    active_at: str = "timestamp"
    received_at: str = "received_at"
    user: str = "anonymous_id"
    event: str = "event"
    day: str | None = None

    def _zoned(self, column: str) -> bool:
        return isinstance(self.frame.schema[column].dataType, T.TimestampType)

    def _stamp(self, column: str) -> Column:
        return utc_ntz(F.col(column)) if self._zoned(column) else F.col(column).cast("timestamp_ntz")

    def rows(self, source: str, window: DayWindow | None = None) -> DataFrame:
        frame = self.frame
        if window is not None:
            frame = frame.where(window.covers(F.col(self.active_at), zoned=self._zoned(self.active_at)))
            if self.day is not None:
                frame = frame.where(window.covers_day(F.col(self.day)))
        return frame.select(
            F.col(self.user).alias("anonymous_id"),
            F.lit(source).alias("source"),
            self._stamp(self.received_at).alias("received_at"),
            self._stamp(self.active_at).alias("active_at"),
            F.col(self.event).alias("event"),
        )


def stack_tracks(tables: Mapping[str, TrackTable], window: DayWindow | None = None) -> DataFrame:
    """UNION ALL of the source tables; the window reaches each table's scan."""
    _known(tables)
    return reduce(DataFrame.unionByName, (table.rows(source, window) for source, table in tables.items()))


@dataclass(frozen=True)
class TrackRule:
    """Which log rows belong to a source, and the zone-less stamp they count with, as SQL."""

    where: str
    stamp: str


def split_log(
    log: DataFrame,
    rules: Mapping[str, TrackRule],
    *,
    user: str,
    event: str,
    stamp: str,
    slack: timedelta = timedelta(0),
    window: DayWindow | None = None,
    day: str | None = None,
) -> DataFrame:
    """The tracks held in one log, read with a single scan; a row may belong to several sources.

    ``user`` and ``event`` are SQL over the log's columns. A rule's stamp may lie up to
    ``slack`` before the log's ``stamp`` column and never after it. So the window prunes
    the scan on ``stamp``, and on ``day`` if the log has a partition column with the date
    of ``stamp``; it is then applied exactly.
    """
    _known(rules)
    if window is not None:
        log = log.where(window.covers(F.col(stamp), slack=slack))
        if day is not None:
            log = log.where(window.covers_day(F.col(day), slack=slack))
    members = ", ".join(f"CASE WHEN {rule.where} THEN '{source}' END" for source, rule in rules.items())
    other_stamps = [
        f"WHEN __source = '{source}' THEN {rule.stamp}" for source, rule in rules.items() if rule.stamp != stamp
    ]
    at = f"CASE {' '.join(other_stamps)} ELSE {stamp} END" if other_stamps else stamp
    rows = (
        log.selectExpr("*", f"explode(array({members})) AS __source")
        .where("__source IS NOT NULL")
        .selectExpr(
            f"{user} AS anonymous_id",
            "__source AS source",
            f"{at} AS received_at",
            f"{at} AS active_at",
            f"{event} AS event",
        )
    )
    return rows if window is None else rows.where(window.covers(F.col("active_at")))


def _known(sources: Mapping[str, object]) -> None:
    unknown = set(sources) - set(SOURCE_PLATFORM)
    if unknown or not sources:
        raise ValueError(f"sources must be among {sorted(SOURCE_PLATFORM)}, got {sorted(sources)}")
