"""Daily visit mart of a date window: ``spark-submit visitmart/jobs/daily_visits.py --web ... --mart ...``.

Reads one table per source, by name, and replaces the window in the mart. Without
bounds the window is yesterday in shifted time; bounds must be at midnight, as the mart has
one row per user and day. ``--full-refresh`` empties the mart first and loads everything up to
the window's end.

All sources are needed, since a run replaces the counts of all platforms. A mart that shall
never have a source can be made with ``--without SOURCE``; a mart that exists is not refilled so.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from visitmart.functions.daywindow import SHIFT_HOURS, DayWindow, resolve_window
from visitmart.plans.visits import daily_visits
from visitmart.session import build_session
from visitmart.sinks.load import truncate_load
from visitmart.sinks.window import create_mart, replace_window, with_day
from visitmart.sources.tables import named_table
from visitmart.sources.tracks import DAY_STAMP, TrackTable, stack_tracks


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    for source, stamp in DAY_STAMP.items():
        parser.add_argument(f"--{source}", metavar="TABLE", help=f"{source} tracks, counted on the day of {stamp}")
    parser.add_argument("--without", action="append", default=[], choices=list(DAY_STAMP), metavar="SOURCE")
    parser.add_argument("--mart", required=True, metavar="TABLE")
    parser.add_argument("--start-at", default="")
    parser.add_argument("--end-at", default="")
    parser.add_argument("--full-refresh", action="store_true")
    parser.add_argument(
        "--day-partition", metavar="COLUMN", help="partition column of the sources with the UTC date of that stamp"
    )
    parser.add_argument("--shift-hours", type=int, default=SHIFT_HOURS)
    args = parser.parse_args(argv)
    for source in DAY_STAMP:
        if bool(getattr(args, source)) == (source in args.without):
            parser.error(f"name a table for {source}, or leave it out by --without {source}")
    if len(set(args.without)) == len(DAY_STAMP):
        parser.error("name at least one source table")
    return args


def run(spark: SparkSession, args: argparse.Namespace, now: datetime) -> DayWindow:
    window = resolve_window(now, args.start_at, args.end_at, args.full_refresh, args.shift_hours)
    if not window.whole_days:
        raise ValueError("the window's bounds must be at midnight: the mart has one row per user and day")
    exists = spark.catalog.tableExists(args.mart)
    if exists and args.without:
        raise ValueError(f"{args.mart} exists; refilling it without {', '.join(args.without)} would wipe counts")
    tables = {
        source: TrackTable(named_table(spark, getattr(args, source)), active_at=stamp, day=args.day_partition)
        for source, stamp in DAY_STAMP.items()
        if getattr(args, source)
    }
    visits = daily_visits(stack_tracks(tables, window), args.shift_hours)
    if not exists:
        create_mart(visits, args.mart)
    elif args.full_refresh:
        truncate_load(with_day(visits), args.mart)
    else:
        replace_window(visits, args.mart, window)
    return window


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments(argv)
    run(build_session("daily_visits"), args, datetime.now(timezone.utc))


if __name__ == "__main__":
    main()
