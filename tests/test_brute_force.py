"""The visit plans and the JSON columns against plain Python on random rows."""

import json
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from visitmart.functions.daywindow import DayWindow
from visitmart.functions.jsoncols import as_flag, as_int, as_text, first_value, marked_json, member, one_value
from visitmart.plans import visits
from visitmart.sources.tracks import TrackTable, stack_tracks

SOURCES = {"web": "web", "click": "web", "aos": "aos", "ios": "ios"}
PLATFORMS = ("web", "aos", "ios")
SCHEMA = "anonymous_id string, received_at timestamp_ntz, timestamp timestamp_ntz, event string"
START = datetime(2024, 1, 1)


def random_rows(seed):
    """(source, user, received_at, timestamp, event): few values each, so that everything repeats."""
    rng = random.Random(seed)
    rows = []
    for _ in range(rng.choice([40, 150])):
        stamp = START + timedelta(hours=rng.randrange(0, 96, 5), minutes=rng.choice([0, 59]))
        rows.append(
            (
                rng.choice(list(SOURCES)),
                rng.choice([None, "a", "b", "c", "d", "e", "f", "g", "h"]),
                stamp,
                stamp + timedelta(hours=rng.choice([0, 0, 6])),
                rng.choice([None, "x", "y"]),
            )
        )
    # One user on a single platform each.
    rows += [(source, f"only_{source}", START, START, "x") for source in SOURCES]
    return rows


def frame_of(spark, rows, window=None):
    tables = {
        source: TrackTable(spark.createDataFrame([row[1:] for row in rows if row[0] == source], SCHEMA))
        for source in SOURCES
    }
    return stack_tracks(tables, window)


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


def totals(rows, distinct):
    """Per platform: user -> (first time, events)."""
    found = {}
    for platform in PLATFORMS:
        mine = [row[1:3] + row[4:] for row in rows if SOURCES[row[0]] == platform]
        if distinct and platform == "web":
            mine = list(set(mine))
        groups = defaultdict(list)
        for user, stamp, event in mine:
            groups[user].append((stamp, event))
        found[platform] = {
            user: (min(stamp for stamp, _ in seen), sum(event is not None for _, event in seen))
            for user, seen in groups.items()
        }
    return found


def joined(rows, distinct=False, merged=False):
    """Nested-loop full outer joins, as SQL defines them."""
    per = totals(rows, distinct)
    lines = [({"web": entry}, user) for user, entry in per["web"].items()]
    for platform in ("aos", "ios"):
        used = set()
        for line in range(len(lines)):
            seen, user = lines[line]
            if user is not None and user in per[platform]:
                lines[line] = ({**seen, platform: per[platform][user]}, user)
                used.add(user)
        for user, entry in per[platform].items():
            if user not in used:
                lines.append(({platform: entry}, user if merged else None))
    out = []
    for seen, user in lines:
        counts = [seen[p][1] if p in seen else None for p in PLATFORMS]
        if merged:
            first, total = min(entry[0] for entry in seen.values()), sum(n or 0 for n in counts)
        else:
            first = seen["web"][0] if "web" in seen else None
            total = None if None in counts else sum(counts)
        flags = [int(p in seen) for p in PLATFORMS]
        body = [value for flag, n in zip(flags, counts) for value in (flag, n or 0)]
        out.append((user, first, *body, sum(flags), total))
    return in_order(out)


def by_stamp(rows, dedup):
    groups = defaultdict(list)
    for source, user, stamp, _, _ in rows:
        if dedup or user is not None:
            groups[user, stamp].append(source)
    out = []
    for (user, stamp), sources in groups.items():
        n = len(set(sources)) if dedup else len(sources)
        flags = [int(any(SOURCES[source] == platform for source in sources)) for platform in PLATFORMS]
        out.append((user, stamp, *[value for flag in flags for value in (flag, n)], max(flags), sum(flags)))
    return in_order(out)


def daily(rows, window=None, least=1):
    groups = defaultdict(lambda: defaultdict(int))
    for source, user, _, active, _ in rows:
        shifted = active + timedelta(hours=9)
        if user is None or (window and not window.lo <= shifted < window.hi):
            continue
        groups[user, datetime.combine(shifted.date(), datetime.min.time())][source] += 1
    out = []
    for (user, day), found in groups.items():
        kept = {source: n for source, n in found.items() if n >= least}
        if kept:
            counts = [sum(n for source, n in kept.items() if SOURCES[source] == p) for p in PLATFORMS]
            body = [value for n in counts for value in (int(n > 0), n)]
            out.append((user, day, *body, 1, sum(counts)))
    return in_order(out)


@pytest.mark.parametrize("seed", range(4))
def test_visit_plans(spark, seed):
    rows = random_rows(seed)
    tracks = frame_of(spark, rows).cache()
    assert rows_of(visits.user_visits_asis(tracks)) == joined(rows)
    assert rows_of(visits.user_visits_asis_distinct(tracks)) == joined(rows, distinct=True)
    assert rows_of(visits.user_visits(tracks)) == joined(rows, merged=True)
    assert rows_of(visits.visits_by_stamp(tracks)) == by_stamp(rows, dedup=False)
    assert rows_of(visits.visits_by_stamp_dedup(tracks)) == by_stamp(rows, dedup=True)
    assert rows_of(visits.daily_visits(tracks)) == daily(rows)
    assert rows_of(visits.daily_visits(tracks, min_events=2)) == daily(rows, least=2)
    window = DayWindow(datetime(2024, 1, 2), datetime(2024, 1, 3, 12))
    assert rows_of(visits.daily_visits(frame_of(spark, rows, window))) == daily(rows, window)


def random_value(rng, depth=0):
    kinds = [None, True, False, 0, -7, 12, 2**31, 1.5, "", "7", " 8 ", "-3", "abc", "true", "false", "3.5", "a@b", "é\n\"q"]
    if depth < 2:
        kinds += [{"1003": 5}, {}, [], [1], [{"1003": "9"}]]
    return rng.choice(kinds)


def random_text(rng):
    document = {
        key: random_value(rng) for key in rng.sample(["1002", "1003", "1014", "email", "x y"], rng.randrange(0, 5))
    }
    shape = rng.randrange(10)
    if shape == 0:
        return rng.choice([None, "", "bad", "[]", "null", "5", '"x"', "{", '{"1003":'])
    if shape <= 3:
        others = [rng.choice([{"1003": 1}, {"1003": 1}, 5, None, "x", [], [{"1003": 2}]]) for _ in range(rng.randrange(3))]
        first = document if rng.random() < 0.8 else rng.choice([5, None, [{"1003": 2}]])
        return json.dumps([first, *others], ensure_ascii=rng.random() < 0.5)
    return json.dumps(document, indent=rng.choice([None, 2]))


def expected(text):
    """Integer and flag of member 1003, as the column rules say."""
    try:
        value = json.loads(text) if text else None
    except ValueError:
        return None, None
    if isinstance(value, list):
        value = value[0] if value else None
    member = value.get("1003") if isinstance(value, dict) else None
    flag = member if isinstance(member, bool) else {"true": True, "false": False}.get(member if isinstance(member, str) else "")
    if isinstance(member, bool) or not isinstance(member, (int, str)):
        return None, flag
    try:
        number = int(member)
    except ValueError:
        return None, flag
    return (number if -(2**31) <= number < 2**31 else None), flag


def test_json_columns(spark):
    rng = random.Random(5)
    texts = [random_text(rng) for _ in range(3000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "at int, text string")
    text = F.col("text")
    value = as_text(member(first_value(one_value(marked_json(text), text)), "1003"))
    found = frame.select("at", as_int(value).alias("n"), as_flag(value).alias("flag")).orderBy("at").collect()
    wrong = [
        (text, (row.n, row.flag), expected(text))
        for text, row in zip(texts, found)
        if (row.n, row.flag) != expected(text)
    ]
    assert wrong == []
