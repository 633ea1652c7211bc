"""Visit marts: event counts and 0/1 visit flags per platform.

All plans take track rows (see ``visitmart.sources.tracks``), flag them by platform and
aggregate once. The aggregate's map-side step shrinks hot users before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.functions.daywindow import SHIFT_HOURS, shifted_day
from visitmart.functions.flags import add_up, nonzero_flag
from visitmart.sources.tracks import PLATFORMS, SOURCE_PLATFORM, on_platform, platform_of

# Columns and conditions below are SQL text over the track columns.


def _aggregate(groups, columns: Iterable[str]) -> DataFrame:
    return groups.agg(*[F.expr(column) for column in columns])


def _by_platform(visits: dict[str, str], counts: dict[str, str]) -> list[str]:
    """Output columns in order: visit flag and event count of each platform."""
    return [
        column
        for platform in PLATFORMS
        for column in (f"{visits[platform]} AS {platform}_visit", f"{counts[platform]} AS {platform}_event")
    ]


# --- per user --------------------------------------------------------------------


def user_visits_asis(tracks: DataFrame) -> DataFrame:
    """Totals per user, in the shape of full outer joins chained on the web platform's key.

    Users without web events get a NULL id and time and one row per other platform,
    and so does the NULL user. ``total_event`` is NULL unless all platforms are present.
    """
    return _user_rows(_user_totals(tracks), merged=False)


def user_visits_asis_distinct(tracks: DataFrame) -> DataFrame:
    """As ``user_visits_asis``, with equal (user, time, event) rows of the web sources counted once."""
    web = on_platform("web")
    # Web rows meet their copies here. Rows of other platforms carry no time and no
    # event in the key, so they shrink to one row per user before the shuffle.
    copies = tracks.groupBy(
        "anonymous_id",
        F.expr(f"{platform_of()} AS platform"),
        F.expr(f"CASE WHEN {web} THEN received_at END AS web_at"),
        F.expr(f"CASE WHEN {web} THEN event END AS web_event"),
    )
    unique = _aggregate(copies, ["min(received_at) AS received_at", "count(event) AS events"])
    counts = {platform: f"CASE WHEN platform = '{platform}' THEN events END" for platform in PLATFORMS}
    counts["web"] = "CASE WHEN platform = 'web' THEN least(events, 1) END"
    totals = _aggregate(
        unique.groupBy("anonymous_id"),
        [
            column
            for platform in PLATFORMS
            for column in _platform_total(platform, f"platform = '{platform}'", f"sum({counts[platform]})")
        ],
    )
    return _user_rows(totals, merged=False)


def user_visits(tracks: DataFrame) -> DataFrame:
    """Totals per user with one row per known user, whatever platforms it was seen on.

    ``received_at`` is the first time on any platform, and ``total_event`` adds what is
    there. The NULL user stays one row per platform, as NULL keys never match.
    """
    return _user_rows(_user_totals(tracks), merged=True)


def _platform_total(platform: str, on: str, count: str) -> list[str]:
    """Was the user there, since when, and with how many events."""
    return [
        f"bool_or({on}) AS on_{platform}",
        f"min(CASE WHEN {on} THEN received_at END) AS {platform}_at",
        f"{count} AS {platform}_event",
    ]


def _user_totals(tracks: DataFrame) -> DataFrame:
    columns = []
    for platform in PLATFORMS:
        on = on_platform(platform)
        columns += _platform_total(platform, on, f"count(CASE WHEN {on} THEN event END)")
    return _aggregate(tracks.groupBy("anonymous_id"), columns)


def _user_rows(totals: DataFrame, *, merged: bool) -> DataFrame:
    """The rows that the joins of the platforms would give, out of one row per user.

    Each output row stands for a set of platforms: all platforms of the user where the
    join finds partners, a single platform where it does not. ``merged`` joins on
    whichever key is present; otherwise only users seen on the web have partners.
    """
    partners = "(anonymous_id IS NOT NULL)" if merged else "(anonymous_id IS NOT NULL AND on_web)"
    together = ", ".join(f"'{platform}', on_{platform}" for platform in PLATFORMS)
    sets = [f"CASE WHEN {partners} THEN named_struct({together}) END"]
    for platform in PLATFORMS:
        alone = ", ".join(f"'{other}', {str(other == platform).lower()}" for other in PLATFORMS)
        sets.append(f"CASE WHEN NOT {partners} AND on_{platform} THEN named_struct({alone}) END")
    rows = totals.selectExpr("*", f"explode(array({', '.join(sets)})) AS seen").where("seen IS NOT NULL")

    visits = {platform: f"CAST(seen.{platform} AS INT)" for platform in PLATFORMS}
    events = {platform: f"CASE WHEN seen.{platform} THEN {platform}_event END" for platform in PLATFORMS}
    counts = {platform: f"coalesce({event}, 0)" for platform, event in events.items()}
    if merged:
        user = "anonymous_id"
        first_at = "least(" + ", ".join(f"CASE WHEN seen.{p} THEN {p}_at END" for p in PLATFORMS) + ")"
        total_event = add_up(counts.values())
    else:
        user = "CASE WHEN seen.web THEN anonymous_id END"
        first_at = "CASE WHEN seen.web THEN web_at END"
        total_event = add_up(events.values())
    return rows.selectExpr(
        f"{user} AS anonymous_id",
        f"{first_at} AS received_at",
        *_by_platform(visits, counts),
        f"{add_up(visits.values())} AS total_visit",
        f"{total_event} AS total_event",
    )


# --- per user and time stamp -----------------------------------------------------


def visits_by_stamp(tracks: DataFrame) -> DataFrame:
    """Per known user and raw stamp.

    All three ``*_event`` columns hold the number of rows of the group, and
    ``total_event`` the number of platforms: the counts are of flags that are never NULL.
    """
    seen = _aggregate(
        tracks.where("anonymous_id IS NOT NULL").groupBy("anonymous_id", "received_at"),
        [f"max(CASE WHEN {on_platform(platform)} THEN 1 ELSE 0 END) AS {platform}" for platform in PLATFORMS]
        + ["count(*) AS events"],
    )
    visits = {platform: platform for platform in PLATFORMS}
    return _stamp_rows(seen, visits, f"greatest({', '.join(PLATFORMS)})")


def visits_by_stamp_dedup(tracks: DataFrame) -> DataFrame:
    """Per user and raw stamp, NULL user included, with each source counted once per stamp."""
    sources = {source: f"from_{source}" for source in SOURCE_PLATFORM}
    seen = _aggregate(
        tracks.groupBy("anonymous_id", "received_at"),
        [f"max(CASE WHEN source = '{source}' THEN 1 ELSE 0 END) AS {flag}" for source, flag in sources.items()],
    ).selectExpr("*", f"CAST({add_up(sources.values())} AS BIGINT) AS events")
    visits = {
        platform: nonzero_flag(add_up(flag for source, flag in sources.items() if SOURCE_PLATFORM[source] == platform))
        for platform in PLATFORMS
    }
    return _stamp_rows(seen, visits, nonzero_flag(add_up(visits.values())))


def _stamp_rows(groups: DataFrame, visits: dict[str, str], total_visit: str) -> DataFrame:
    return groups.selectExpr(
        "anonymous_id",
        "received_at AS event_at",
        *_by_platform(visits, {platform: "events" for platform in PLATFORMS}),
        f"{total_visit} AS total_visit",
        f"{add_up(visits.values())} AS total_event",
    )


# --- per user and day ------------------------------------------------------------


def daily_visits(tracks: DataFrame, shift_hours: int = SHIFT_HOURS, min_events: int = 1) -> DataFrame:
    """Per known user and shifted day.

    A source counts for a user's day when it has at least ``min_events`` rows there.
    For a date window pass the window to ``stack_tracks`` or ``split_log``.
    """
    day = shifted_day(F.col("active_at"), shift_hours)
    groups = _aggregate(
        tracks.where("anonymous_id IS NOT NULL").groupBy("anonymous_id", day.alias("event_at")),
        [f"count_if(source = '{source}') AS from_{source}" for source in SOURCE_PLATFORM],
    )
    kept = {source: f"from_{source}" for source in SOURCE_PLATFORM}
    if min_events > 1:
        groups = groups.where(f"greatest({', '.join(kept.values())}) >= {min_events}")
        kept = {source: f"CASE WHEN {n} >= {min_events} THEN {n} ELSE 0 END" for source, n in kept.items()}
    counts = {
        platform: add_up(count for source, count in kept.items() if SOURCE_PLATFORM[source] == platform)
        for platform in PLATFORMS
    }
    visits = {platform: nonzero_flag(count) for platform, count in counts.items()}
    return groups.selectExpr(
        "anonymous_id",
        "event_at",
        *_by_platform(visits, counts),
        f"{nonzero_flag(add_up(visits.values()))} AS total_visit",
        f"{add_up(counts.values())} AS total_event",
    )
