"""Publication in versions: failures at each step, loads at once, readers, and what stays on disk."""

import glob
import threading
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of
from visitmart.functions.daywindow import DayWindow
from visitmart.session import scratch_table
from visitmart.sinks import versions
from visitmart.sinks.load import truncate_load
from visitmart.sinks.window import DAY_COLUMN, adopt_mart, create_mart, replace_window, spread_by_day, with_day

SCHEMA = "anonymous_id string, event_at timestamp_ntz, n int"
WINDOW = DayWindow(datetime(2024, 1, 2), datetime(2024, 1, 4))
OLD = [("a", at("2024-01-01"), 1), ("a", at("2024-01-02"), 1), ("a", at("2024-01-03"), 1)]
NEW = [("a", at("2024-01-01"), 1), ("b", at("2024-01-02"), 2)]


def days(spark, rows):
    return spark.createDataFrame([(user, at(day), n) for user, day, n in rows], SCHEMA)


def mart_rows(spark, mart):
    return rows_of(spark.table(mart).drop(DAY_COLUMN))


@pytest.fixture
def mart(spark):
    name = scratch_table(spark, "published")
    create_mart(days(spark, [("a", "2024-01-01", 1), ("a", "2024-01-02", 1), ("a", "2024-01-03", 1)]), name)
    return name


def folder(spark, mart):
    return versions._folder(spark, *mart.split(".")).removeprefix("file:")


def loads(spark, mart):
    return {path for path in glob.glob(f"{folder(spark, mart)}/*/{DAY_COLUMN}=*")}


def tables(spark, mart):
    database, name = mart.split(".")
    return {row.name for row in spark.catalog.listTables(database) if row.name.startswith(name)}


STEPS = ["_write", "_make", "_add", "_commit", "_point", "_pointed", "_retire"]


def fail_at(monkeypatch, step, moment, calls=1):
    """The step raises, before or after its work, when it is called for the nth time."""
    work, seen = getattr(versions, step), []

    def failing(*args):
        seen.append(args)
        if len(seen) == calls and moment == "before":
            raise OSError("lost")
        done = work(*args)
        if len(seen) == calls:
            raise OSError("lost")
        return done

    monkeypatch.setattr(versions, step, failing)


@pytest.mark.parametrize("step", ["_write", "_make", "_add"])
@pytest.mark.parametrize("moment", ["before", "after"])
@pytest.mark.parametrize("kind", ["window", "whole"])
def test_failure_before_the_commit_changes_nothing(spark, mart, monkeypatch, step, moment, kind):
    files, known = loads(spark, mart), tables(spark, mart)
    fresh = days(spark, [("b", "2024-01-02", 2)])
    with monkeypatch.context() as patch:
        fail_at(patch, step, moment)
        with pytest.raises(OSError):
            replace_window(fresh, mart, WINDOW) if kind == "window" else truncate_load(with_day(fresh), mart)
    assert mart_rows(spark, mart) == OLD
    assert loads(spark, mart) == files and tables(spark, mart) == known
    replace_window(fresh, mart, WINDOW)
    assert mart_rows(spark, mart) == NEW


def test_failure_of_the_commit_itself_changes_nothing(spark, mart, monkeypatch):
    with monkeypatch.context() as patch:
        fail_at(patch, "_commit", "before")
        with pytest.raises(OSError):
            replace_window(days(spark, [("b", "2024-01-02", 2)]), mart, WINDOW)
    assert mart_rows(spark, mart) == OLD and versions.newest(spark, mart).number == 1


def test_failure_after_the_commit_shows_the_old_rows_until_the_next_load(spark, mart, monkeypatch):
    # newest() points first, publish() second
    with monkeypatch.context() as patch:
        fail_at(patch, "_point", "before", calls=2)
        with pytest.raises(OSError):
            replace_window(days(spark, [("b", "2024-01-02", 2)]), mart, WINDOW)
    assert mart_rows(spark, mart) == OLD
    assert versions.newest(spark, mart).number == 2
    assert mart_rows(spark, mart) == NEW


def test_failure_while_old_versions_go_leaves_the_new_rows(spark, mart, monkeypatch):
    with monkeypatch.context() as patch:
        fail_at(patch, "_retire", "before")
        with pytest.raises(OSError):
            replace_window(days(spark, [("b", "2024-01-02", 2)]), mart, WINDOW)
    assert mart_rows(spark, mart) == NEW
    replace_window(days(spark, [("c", "2024-01-03", 3)]), mart, WINDOW)
    assert mart_rows(spark, mart) == [("a", at("2024-01-01"), 1), ("c", at("2024-01-03"), 3)]


def test_first_publication_fails_whole(spark, monkeypatch):
    name = scratch_table(spark, "published")
    for step in ("_write", "_make", "_add", "_commit"):
        with monkeypatch.context() as patch:
            fail_at(patch, step, "before")
            with pytest.raises(OSError):
                truncate_load(spark.sql("SELECT 1 AS a"), name)
        assert not spark.catalog.tableExists(name)
    truncate_load(spark.sql("SELECT 2 AS a"), name)
    assert rows_of(spark.table(name)) == [(2,)]


def test_of_two_loads_from_one_version_the_second_raises(spark, mart):
    base = versions.newest(spark, mart)
    replace_window(days(spark, [("b", "2024-01-02", 2)]), mart, WINDOW)
    files, known = loads(spark, mart), tables(spark, mart)
    with pytest.raises(versions.ConcurrentLoad):
        versions.publish(with_day(days(spark, [("late", "2024-01-05", 5)])), mart, base, DAY_COLUMN, keep=lambda value: True)
    assert mart_rows(spark, mart) == NEW
    assert loads(spark, mart) == files and tables(spark, mart) == known


def test_loads_in_threads(spark, mart):
    """Of loads that start together one wins; what the others raise tells them to run again."""
    start, done, lost = threading.Barrier(4), [], []

    def load(number):
        frame = days(spark, [(f"t{number}", "2024-01-02", number)])
        start.wait()
        try:
            replace_window(frame, mart, WINDOW)
            done.append(number)
        except versions.ConcurrentLoad:
            lost.append(number)

    threads = [threading.Thread(target=load, args=(number,)) for number in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert done and len(done) + len(lost) == 4
    assert mart_rows(spark, mart)[1:] == [(f"t{done[-1]}", at("2024-01-02"), done[-1])] or len(done) > 1
    assert versions.newest(spark, mart).number == 1 + len(done)


def test_a_reader_ends_on_the_version_it_began_with(spark, mart):
    began = spark.table(mart).drop(DAY_COLUMN)
    replace_window(days(spark, [("b", "2024-01-02", 2)]), mart, WINDOW)
    assert rows_of(began) == OLD
    assert mart_rows(spark, mart) == NEW


def test_only_days_of_the_window_are_written_and_old_folders_go(spark, mart):
    first = [path for path in loads(spark, mart) if "2024-01-01" in path]
    for number in range(5):
        replace_window(days(spark, [("b", "2024-01-02", number)]), mart, WINDOW)
        assert [path for path in loads(spark, mart) if "2024-01-01" in path] == first
    listed = {part for n in versions._numbers(spark, *mart.split(".")) for part in versions._partitions(spark, versions._version_table(*mart.split("."), n))}
    assert len(loads(spark, mart)) == len(listed) == 3
    assert len(tables(spark, mart)) == 1 + versions.KEPT_VERSIONS
    versions.drop_versioned(spark, mart)
    assert not tables(spark, mart) and not glob.glob(folder(spark, mart))


def test_days_are_pruned_through_the_view(spark, mart):
    plan = spark.table(mart).where("event_day = DATE '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_day" in plan
    assert spark.table(mart).where("event_day = DATE '2024-01-02'").count() == 1


def test_null_days_and_odd_values(spark):
    name = scratch_table(spark, "published")
    create_mart(days(spark, [("a", "2024-01-01", 1)]).union(spark.sql("SELECT 'x', NULL, 1")), name)
    assert spark.table(name).where(F.col(DAY_COLUMN).isNull()).count() == 1
    replace_window(days(spark, [("b", "2024-01-02", 2)]), name, WINDOW)
    assert mart_rows(spark, name) == [("a", at("2024-01-01"), 1), ("b", at("2024-01-02"), 2), ("x", None, 1)]
    odd = scratch_table(spark, "published")
    rows = [("it's", 1), ("a/b=c", 2), ("", 3), (None, 4), ("%2F", 5), ("é\\n", 6)]
    frame = spark.createDataFrame(rows, "kind string, n int")
    for _ in range(3):
        base = versions.newest(spark, odd)
        versions.publish(frame, odd, base, "kind", keep=lambda value: False)
    assert sorted(row.n for row in spark.table(odd).collect()) == [1, 2, 3, 4, 5, 6]
    assert {row.kind for row in spark.table(odd).collect()} == {kind or None for kind, _ in rows}


def test_definition_is_kept_and_columns_go_by_name(spark):
    name = scratch_table(spark, "published")
    truncate_load(spark.sql("SELECT CAST(1 AS bigint) AS a, 'x' AS b"), name)
    truncate_load(spark.sql("SELECT 'y' AS B, 2 AS a"), f"spark_catalog.{name}")
    assert rows_of(spark.table(name)) == [(2, "y")] and spark.table(name).dtypes == [("a", "bigint"), ("b", "string")]
    for bad in ("SELECT 1 AS a, 'x' AS b, 2 AS c", "SELECT 1 AS a"):
        with pytest.raises(Exception):
            truncate_load(spark.sql(bad), name)
    truncate_load(spark.table(name).withColumn("a", F.col("a") + 1), name)
    assert rows_of(spark.table(name)) == [(3, "y")]


def test_a_mart_is_made_once(spark, mart):
    with pytest.raises(ValueError):
        create_mart(days(spark, []), mart)


def test_tables_made_otherwise_are_rewritten_in_place_or_adopted(spark):
    plain, mart = scratch_table(spark, "plain"), scratch_table(spark, "published")
    rows = with_day(days(spark, [("a", "2024-01-01", 1), ("a", "2024-01-02", 1), ("a", "2024-01-03", 1)]))
    spread_by_day(rows).write.partitionBy(DAY_COLUMN).format("parquet").saveAsTable(plain)
    adopt_mart(spark, plain, mart)
    replace_window(days(spark, [("b", "2024-01-02", 2)]), plain, WINDOW)
    replace_window(days(spark, [("b", "2024-01-02", 2)]), mart, WINDOW)
    assert mart_rows(spark, plain) == mart_rows(spark, mart) == NEW
    inside = DayWindow(datetime(2024, 1, 2, 12), datetime(2024, 1, 2, 14))
    replace_window(days(spark, [("c", "2024-01-02 13:00:00", 3)]), plain, inside)
    assert mart_rows(spark, plain) == [*NEW, ("c", at("2024-01-02 13:00:00"), 3)]
    with pytest.raises(ValueError):
        replace_window(days(spark, [("x", "2024-02-01", 1)]), plain, WINDOW)
    for direct in (False, True):
        truncate_load(with_day(days(spark, [("q", "2024-06-01", 7)])), plain, direct=direct)
        assert mart_rows(spark, plain) == [("q", at("2024-06-01"), 7)]
