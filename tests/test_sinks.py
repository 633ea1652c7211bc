import glob
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import at, rows_of
from visitmart.functions.daywindow import DayWindow
from visitmart.session import scratch_path, scratch_table
from visitmart.sinks.load import truncate_load, write_csv
from visitmart.sinks.window import DAY_COLUMN, create_mart, overwrite_window, replace_window, with_day

SCHEMA = "anonymous_id string, event_at timestamp_ntz, n int"


def mart_rows(spark, mart):
    return rows_of(spark.table(mart).drop(DAY_COLUMN))


def days(spark, rows):
    return spark.createDataFrame([(user, at(day), n) for user, day, n in rows], SCHEMA)


@pytest.fixture
def mart(spark):
    name = scratch_table(spark, "mart")
    create_mart(days(spark, [("a", "2024-01-01", 1), ("a", "2024-01-02", 1), ("a", "2024-01-03", 1)]), name)
    return name


WINDOW = DayWindow(datetime(2024, 1, 2), datetime(2024, 1, 4))


def test_replace_keeps_fills_and_clears(spark, mart):
    for _ in range(2):
        replace_window(days(spark, [("b", "2024-01-02", 2), ("c", "2024-01-02", 3)]), mart, WINDOW)
        assert mart_rows(spark, mart) == [
            ("a", at("2024-01-01"), 1),
            ("b", at("2024-01-02"), 2),
            ("c", at("2024-01-02"), 3),
        ]


def test_replace_by_nothing(spark, mart):
    replace_window(days(spark, []), mart, WINDOW)
    assert mart_rows(spark, mart) == [("a", at("2024-01-01"), 1)]


def test_cleared_day_can_be_filled_again(spark, mart):
    replace_window(days(spark, []), mart, WINDOW)
    replace_window(days(spark, [("z", "2024-01-03", 9)]), mart, WINDOW)
    assert mart_rows(spark, mart) == [("a", at("2024-01-01"), 1), ("z", at("2024-01-03"), 9)]


def test_backfill_far_from_today(spark, mart):
    window = DayWindow(datetime(2020, 5, 1), datetime(2020, 5, 2))
    replace_window(days(spark, [("old", "2020-05-01", 5)]), mart, window)
    assert len(mart_rows(spark, mart)) == 4


def test_bounds_inside_a_day_keep_the_rest_of_it(spark):
    mart = scratch_table(spark, "mart")
    create_mart(days(spark, [("a", "2024-01-02 01:00:00", 1), ("a", "2024-01-02 13:00:00", 1)]), mart)
    window = DayWindow(datetime(2024, 1, 2, 12), datetime(2024, 1, 2, 14))
    replace_window(days(spark, [("b", "2024-01-02 13:30:00", 2)]), mart, window)
    assert mart_rows(spark, mart) == [("a", at("2024-01-02 01:00:00"), 1), ("b", at("2024-01-02 13:30:00"), 2)]


def test_rows_outside_the_window_leave_the_mart_alone(spark, mart):
    before = mart_rows(spark, mart)
    for stray in (days(spark, [("x", "2024-02-01", 1)]), days(spark, []).union(spark.sql("SELECT 'x', NULL, 1"))):
        with pytest.raises(ValueError):
            replace_window(stray, mart, WINDOW)
    assert mart_rows(spark, mart) == before
    assert not [t for t in spark.catalog.listTables(mart.split(".")[0]) if "__stage_" in t.name]


def test_failing_rows_leave_the_mart_alone(spark, mart):
    before = mart_rows(spark, mart)
    broken = days(spark, [("x", "2024-01-02", 1)]).withColumn("n", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        replace_window(broken, mart, WINDOW)
    assert mart_rows(spark, mart) == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_new_rows_may_come_from_the_mart(spark, mart):
    doubled = spark.table(mart).where("event_day >= '2024-01-02'").withColumn("n", F.col("n") * 2).drop(DAY_COLUMN)
    replace_window(doubled, mart, WINDOW)
    assert [row[2] for row in mart_rows(spark, mart)] == [1, 2, 2]


def test_overwrite_by_condition_states_the_window(spark):
    class Frame:
        def writeTo(self, table):
            self.table = table
            return self

        def overwrite(self, condition):
            self.condition = condition

    frame = Frame()
    overwrite_window(frame, "lake.mart", WINDOW)
    assert frame.table == "lake.mart"
    stamps = days(spark, [("a", f"2024-01-0{day}", day) for day in (1, 2, 3, 4)])
    assert [row.n for row in stamps.where(frame.condition).orderBy("n").collect()] == [2, 3]


@pytest.mark.parametrize("seed", range(3))
def test_windows_in_a_row_equal_delete_and_append(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)

    def random_rows(lo, hi, least):
        hours = int((hi - lo).total_seconds() // 3600)
        return [(f"u{rng.randrange(5)}", lo + timedelta(hours=rng.randrange(hours)), rng.randrange(100)) for _ in range(least)]

    model = random_rows(start, start + timedelta(days=6), 40)
    mart = scratch_table(spark, "mart")
    create_mart(spark.createDataFrame(model, SCHEMA), mart)
    for _ in range(5):
        unit = rng.choice([24, 6])
        lo = start + timedelta(hours=unit * rng.randrange(5 * 24 // unit))
        hi = lo + timedelta(hours=unit * rng.randrange(1, 6))
        fresh = random_rows(lo, hi, rng.choice([0, 1, 8]))
        replace_window(spark.createDataFrame(fresh, SCHEMA), mart, DayWindow(lo, hi))
        model = [row for row in model if not lo <= row[1] < hi] + fresh
        expected = spark.createDataFrame(model, SCHEMA)
        assert mart_rows(spark, mart) == rows_of(expected)
        kept_days = {row[0] for row in spark.table(mart).select(F.col("event_at").cast("date")).distinct().collect()}
        assert {row[0] for row in spark.table(mart).select(DAY_COLUMN).distinct().collect()} == kept_days


def test_truncate_load(spark, mart):
    truncate_load(with_day(days(spark, [("q", "2024-06-01", 7)])), mart)
    assert mart_rows(spark, mart) == [("q", at("2024-06-01"), 7)]
    table = scratch_table(spark, "plain")
    truncate_load(spark.sql("SELECT 1 AS a, 'x' AS b"), table)
    truncate_load(spark.sql("SELECT 'y' AS b, 2 AS a"), table)
    assert rows_of(spark.table(table)) == [(2, "y")]
    assert rows_of(spark.table(f"spark_catalog.{table}")) == [(2, "y")]


@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("direct", [False, True])
def test_truncate_load_empties_all_days(spark, mart, mode, direct):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        truncate_load(with_day(days(spark, [("q", "2024-01-02", 7)])), mart, direct=direct)
        assert spark.conf.get(key) == mode
    finally:
        spark.conf.set(key, before)
    assert mart_rows(spark, mart) == [("q", at("2024-01-02"), 7)]


def test_window_replace_leaves_the_sessions_setting(spark, mart, monkeypatch):
    """The setting is not changed for a moment, as another thread would see it."""
    changed = []
    kind = type(spark.conf)
    plain = kind.set
    monkeypatch.setattr(kind, "set", lambda self, key, value: (changed.append(key) if self is spark.conf else None, plain(self, key, value))[1])
    replace_window(days(spark, [("b", "2024-01-02", 2)]), mart, WINDOW)
    assert changed == []
    assert mart_rows(spark, mart) == [("a", at("2024-01-01"), 1), ("b", at("2024-01-02"), 2)]


def test_unqualified_names_are_those_of_the_session(spark):
    full = scratch_table(spark, "plain")
    database, name = full.split(".")
    truncate_load(spark.sql("SELECT 1 AS a"), full)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)
    try:
        truncate_load(spark.sql("SELECT 2 AS a"), name)
        assert rows_of(spark.table(name)) == [(2,)]
    finally:
        spark.catalog.setCurrentDatabase(before)


def test_truncate_load_from_itself_and_after_a_failure(spark):
    table = scratch_table(spark, "plain")
    truncate_load(spark.sql("SELECT 1 AS a UNION ALL SELECT 2"), table)
    truncate_load(spark.table(table).where("a > 1"), table)
    assert rows_of(spark.table(table)) == [(2,)]
    with pytest.raises(Exception, match="lost"):
        truncate_load(spark.table(table).withColumn("a", F.raise_error(F.lit("lost")).cast("int")), table)
    assert rows_of(spark.table(table)) == [(2,)]


def test_columns_the_target_lacks_are_not_dropped_silently(spark, mart):
    more = days(spark, [("b", "2024-01-02", 2)]).withColumn("more", F.lit(1))
    before = mart_rows(spark, mart)
    with pytest.raises(ValueError, match="more"):
        replace_window(more, mart, WINDOW)
    with pytest.raises(ValueError, match="more"):
        truncate_load(with_day(more), mart)
    assert mart_rows(spark, mart) == before


def test_few_files_per_day(spark):
    many = spark.range(20000).select(
        F.col("id").cast("string").alias("anonymous_id"),
        (F.lit("2024-01-01").cast("date") + (F.col("id") % 20).cast("int")).cast("timestamp_ntz").alias("event_at"),
        F.lit(1).alias("n"),
    )
    mart = scratch_table(spark, "mart")
    create_mart(many.repartition(8, "anonymous_id"), mart)
    files = spark.table(mart).select(DAY_COLUMN, F.input_file_name().alias("file")).distinct()
    assert files.count() <= 40


def test_heavy_day_is_cut_into_several_files(spark):
    rows = spark.range(200000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("anonymous_id"),
        F.when(F.col("id") % 100 == 0, "2024-01-02").otherwise("2024-01-01").cast("timestamp_ntz").alias("event_at"),
        F.lit(1).alias("n"),
    )
    mart = scratch_table(spark, "mart")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        create_mart(rows, mart)
        replace_window(rows, mart, DayWindow(datetime(2024, 1, 1), datetime(2024, 1, 3)))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    named = spark.table(mart).select(DAY_COLUMN, F.input_file_name().alias("file"))
    files = named.groupBy(DAY_COLUMN).agg(F.count_distinct("file"), F.count("*"))
    found = {str(row[0]): (row[1], row[2]) for row in files.collect()}
    assert found["2024-01-01"][0] > 3 and found["2024-01-01"][1] == 198000
    assert found["2024-01-02"] == (1, 2000)


def test_one_day_with_adaptive_execution_off(spark):
    rows = spark.range(1000, numPartitions=8).select(
        F.col("id").cast("string").alias("anonymous_id"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("event_at"),
        F.lit(1).alias("n"),
    )
    mart = scratch_table(spark, "mart")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        create_mart(rows, mart)
        replace_window(rows, mart, DayWindow(datetime(2024, 1, 1), datetime(2024, 1, 2)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert spark.table(mart).count() == 1000


def test_csv(spark):
    path = scratch_path(spark, "csv")
    frame = spark.createDataFrame([(1, None, ' a "b", c '), (2, "", None)], "n int, text string, more string")
    write_csv(frame.coalesce(1), path)
    (file,) = glob.glob(f"{path}/part-*.csv")
    with open(file) as opened:
        assert opened.read().splitlines() == ["n,text,more", '1,NaN," a ""b"", c "', '2,"",NaN']
    back = spark.read.option("header", True).option("escape", '"').option("nullValue", "NaN").csv(path)
    assert rows_of(back.selectExpr("cast(n as int) n", "text", "more")) == rows_of(frame)
