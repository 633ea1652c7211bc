"""What the physical plans must look like."""

import re
from datetime import datetime

import pytest

from conftest import SF
from visitmart import catalog, sample
from visitmart.functions.daywindow import DayWindow
from visitmart.plans import visits
from visitmart.plans.outreach import outreach_ods
from visitmart.sources.query import sql_over_frames
from visitmart.sources.tracks import TrackRule, TrackTable, split_log, stack_tracks


def plan(frame, capsys) -> str:
    frame.explain("formatted")
    return capsys.readouterr().out


def hash_exchanges(text: str) -> int:
    return len(re.findall(r"Arguments: hashpartitioning", text))


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("daily_visits", 1),
        ("daily_visits_window", 1),
        ("having_min_events", 1),
        ("visits_by_stamp", 1),
        ("visits_by_stamp_dedup", 1),
        ("user_visits", 1),
        ("user_visits_asis", 1),
        ("user_visits_asis_distinct", 2),
        ("outreach_ods", 0),
        ("outreach_parsed", 0),
        ("outreach_rejects", 0),
        ("profile_domain", 1),
        ("profile_counts", 1),
        ("profile_nulls", 0),
    ],
)
def test_one_scan_and_few_shuffles(spark, capsys, name, exchanges):
    text = plan(catalog.QUERIES[name](spark, SF), capsys)
    assert hash_exchanges(text) == exchanges
    main_table = "orders" if name.startswith(("outreach", "profile")) else "events"
    assert len(re.findall(rf"Location: .*{main_table}\.parquet", text)) == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "Python" not in text


def test_window_reaches_the_log_scan(spark, capsys):
    text = plan(catalog.QUERIES["daily_visits_window"](spark, SF), capsys)
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    assert "GreaterThanOrEqual(ts,2024-01-09T15:00)" in pushed
    assert "LessThan(ts,2024-01-10T16:00)" in pushed
    read = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "props" not in read and "event_id" not in read


@pytest.mark.parametrize("zoned", [False, True])
def test_window_reaches_each_source_table(spark, capsys, tmp_path, zoned):
    kind = "timestamp" if zoned else "timestamp_ntz"
    tables = {}
    for source in ("web", "click", "aos", "ios"):
        path = f"{tmp_path}/{source}"
        spark.sql(
            f"SELECT 'u' AS anonymous_id, {kind}'2024-01-02' AS timestamp, {kind}'2024-01-02' AS received_at,"
            " 'a' AS event, 'wide' AS unused"
        ).write.parquet(path)
        tables[source] = TrackTable(spark.read.parquet(path))
    window = DayWindow(datetime(2024, 1, 2), datetime(2024, 1, 3))
    text = plan(visits.daily_visits(stack_tracks(tables, window)), capsys)
    pushed = re.findall(r"PushedFilters: (.*)", text)
    assert len(pushed) == 4
    for filters in pushed:
        assert "IsNotNull(anonymous_id)" in filters
        assert re.search(r"GreaterThanOrEqual\(timestamp,2024-01-01[T ]15:00", filters)
        assert re.search(r"LessThan\(timestamp,2024-01-02[T ]15:00", filters)
    assert all("unused" not in schema for schema in re.findall(r"ReadSchema: (.*)", text))
    assert hash_exchanges(text) == 1


def test_window_prunes_day_partitions(spark, capsys, tmp_path):
    spark.sql(
        "SELECT 'u' AS anonymous_id, timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, id) AS ts, 'view' AS event_type"
        " FROM range(96)"
    ).selectExpr("*", "CAST(ts AS DATE) AS dt").write.partitionBy("dt").parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    window = DayWindow(datetime(2024, 1, 3), datetime(2024, 1, 4))
    rules = {"web": TrackRule("event_type = 'view'", "ts")}
    split = split_log(log, rules, user="anonymous_id", event="event_type", stamp="ts", window=window, day="dt")
    table = TrackTable(log, active_at="ts", received_at="ts", event="event_type", day="dt")
    for tracks in (split, stack_tracks({"web": table}, window)):
        daily = visits.daily_visits(tracks)
        text = plan(daily, capsys)
        partitions = re.search(r"PartitionFilters: (.*)", text).group(1)
        assert "dt" in partitions and "2024-01-02" in partitions and "2024-01-03" in partitions
        assert [row.total_event for row in daily.collect()] == [24]
        assert len(tracks.select("active_at").inputFiles()) >= 2


def test_sources_as_tables_need_one_shuffle(spark, capsys):
    text = plan(visits.daily_visits(stack_tracks(sample.track_tables(spark, SF))), capsys)
    assert hash_exchanges(text) == 1


def test_small_lookup_is_broadcast_by_its_size(spark, capsys):
    assert "BroadcastHashJoin" in plan(catalog.QUERIES["outreach_ods"](spark, SF), capsys)


def test_pipeline_filter_reaches_both_scans(spark, capsys, tmp_path):
    sample.boxes(spark, SF).write.parquet(f"{tmp_path}/boxes")
    boxes, pipelines = spark.read.parquet(f"{tmp_path}/boxes"), sample.pipelines(spark, SF)
    pushed = re.findall(r"PushedFilters: (.*)", plan(outreach_ods(boxes, pipelines, 2), capsys))
    assert len(pushed) == 2
    assert any("EqualTo(pipelineid,2)" in filters for filters in pushed)
    assert any("EqualTo(r_regionkey,2)" in filters for filters in pushed)


def test_one_parse_per_json_column(spark, capsys):
    for name in ("sql_json_functions", "outreach_ods", "outreach_parsed", "outreach_rejects"):
        catalog.QUERIES[name](spark, SF).explain("extended")
        optimized = re.search(r"== Optimized Logical Plan ==(.*?)== Physical Plan ==", capsys.readouterr().out, re.DOTALL)
        assert len(re.findall(r"VariantExpressionEvalUtils.parseJson", optimized.group(1))) == 2, name


def test_three_calls_on_one_column_parse_once(spark):
    """Calls on one column are one parse per row in the generated code, in SQL over frames and on a table."""
    statement = """
        SELECT id, json_extract_path_text(fields, '1003') AS a, json_extract_path_text(fields, '1014') AS b,
               json_extract_path_text(fields, '1002') AS c, json_extract_array_element_text(assignedtosharingentries, 0) AS d
        FROM {boxes}
    """
    frame = sql_over_frames(spark, statement, {"boxes": sample.boxes(spark, SF)})
    stages = frame._jdf.queryExecution().debug().codegenToSeq()
    codes = [stages.apply(at)._2() for at in range(stages.size())]
    assert sum(code.count("VariantExpressionEvalUtils.parseJson(") for code in codes) == 2
    # In the plan it is one for each call, as each has its arguments as columns below it.
    plan_text = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan_text.count("VariantExpressionEvalUtils.parseJson(") == 4


def test_lookup_check_moves_one_row_per_task(spark, capsys):
    from visitmart.operators import joins

    lookup = sample.pipelines(spark, SF)
    assert joins.fits_broadcast(lookup)
    text = plan(lookup.agg({"*": "count"}), capsys)
    assert "Limit" not in text and "partial_count" in text


def test_json_is_typed_before_a_shuffle(spark, capsys, monkeypatch):
    from visitmart.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    text = plan(outreach_ods(sample.boxes(spark, SF), sample.pipelines(spark, SF), 2), capsys)
    exchanged = [line for line in re.findall(r"Exchange\nInput \[\d+\]: (.*)", text)]
    assert exchanged and all("assignedtosharingentries" not in line and "fields" not in line for line in exchanged)
