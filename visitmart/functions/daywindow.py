"""Shifted days and half-open date windows on zone-less time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hours between the stored UTC stamp and the business day, and the first day of a full refresh.
SHIFT_HOURS = 9
REFRESH_START = datetime(1999, 1, 1)


def ntz(moment: datetime) -> Column:
    """Zone-less timestamp literal, folded by Catalyst so that it can reach the scan."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def utc_ntz(instant: Column) -> Column:
    """A zoned timestamp as its zone-less UTC stamp, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), ntz(datetime(1970, 1, 1)))


def shift(stamp: Column, hours: int = SHIFT_HOURS) -> Column:
    """The stamp moved by whole hours."""
    return stamp + F.make_dt_interval(hours=F.lit(hours))


def shifted_day(stamp: Column, hours: int = SHIFT_HOURS) -> Column:
    """Midnight of the shifted day.

    Goes through DATE: ``date_trunc`` would turn a zone-less stamp into a zoned one.
    """
    return shift(stamp, hours).cast("date").cast("timestamp_ntz")


@dataclass(frozen=True)
class DayWindow:
    """Half-open range ``[lo, hi)`` of shifted time."""

    lo: datetime
    hi: datetime
    shift_hours: int = SHIFT_HOURS

    def covers(self, stamp: Column, *, zoned: bool = False, slack: timedelta = timedelta(0)) -> Column:
        """True for unshifted stamps whose shifted value lies in the window.

        The bounds are moved, not the column, so Parquet and JDBC scans get a plain range.
        ``slack`` widens the upper end for a coarse filter on a finer column.
        """
        back = timedelta(hours=self.shift_hours)
        lo, hi = self.lo - back, self.hi - back + slack
        if zoned:
            return (stamp >= _zoned(lo)) & (stamp < _zoned(hi))
        return (stamp >= ntz(lo)) & (stamp < ntz(hi))

    def covers_day(self, day: Column, *, slack: timedelta = timedelta(0)) -> Column:
        """True for the unshifted calendar days that the window touches; prunes day partitions."""
        back = timedelta(hours=self.shift_hours)
        last = self.hi - back + slack - timedelta(microseconds=1)
        return day.between(F.lit((self.lo - back).date()), F.lit(last.date()))

    def holds(self, shifted: Column) -> Column:
        """True for values that are already in shifted time, such as a mart's day column."""
        return (shifted >= ntz(self.lo)) & (shifted < ntz(self.hi))

    @property
    def first_day(self) -> date:
        return self.lo.date()

    @property
    def last_day(self) -> date:
        return (self.hi - timedelta(microseconds=1)).date()

    @property
    def whole_days(self) -> bool:
        midnight = datetime.min.time()
        return self.lo.time() == midnight and self.hi.time() == midnight


def _zoned(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ") + "+00:00").cast("timestamp")


def _parse(text: str) -> datetime:
    moment = datetime.fromisoformat(text)
    if moment.tzinfo is not None:
        raise ValueError(f"window bounds are zone-less, got {text!r}")
    return moment


def _given(text: str | None) -> bool:
    """Job arguments stand for "not given" as None, as empty text or as a pair of quotes."""
    return text is not None and text.strip() not in ("", "''")


def resolve_window(
    now: datetime,
    start_at: str | None = None,
    end_at: str | None = None,
    full_refresh: bool = False,
    shift_hours: int = SHIFT_HOURS,
) -> DayWindow:
    """Window of a run: yesterday in shifted time, unless a bound is given.

    ``now`` is UTC (naive or aware). Each bound can be given alone. A full refresh
    starts at ``REFRESH_START`` and leaves the end as it is.
    """
    if now.tzinfo is not None:
        now = now.astimezone(timezone.utc).replace(tzinfo=None)
    today = datetime.combine((now + timedelta(hours=shift_hours)).date(), datetime.min.time())
    lo = _parse(start_at) if _given(start_at) else today - timedelta(days=1)
    hi = _parse(end_at) if _given(end_at) else today
    if full_refresh:
        lo = REFRESH_START
    if lo >= hi:
        raise ValueError(f"empty window: {lo} is not before {hi}")
    return DayWindow(lo, hi, shift_hours)
