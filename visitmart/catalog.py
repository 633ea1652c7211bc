"""The library's queries over the provided tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart import sample
from visitmart.functions.daywindow import SHIFT_HOURS, DayWindow
from visitmart.operators.joins import full_outer_chain
from visitmart.operators.profile import column_domains, first_rows, null_counts, row_counts
from visitmart.plans import outreach, visits
from visitmart.session import scratch_path, scratch_table
from visitmart.sinks.load import truncate_load
from visitmart.sinks.window import DAY_COLUMN, create_mart, replace_window, with_day
from visitmart.sources.query import SqlFrames, sql_over_frames
from visitmart.sources.tables import named_table, parquet_table
from visitmart.sources.tracks import stack_tracks

# Counted per pipeline before the names are joined on, so that a pipeline with most boxes is a few rows by then.
STAGES_SQL = """
SELECT p.name AS pipeline_name, stagekey, in_range, boxes, first_at
FROM (SELECT pipelineid, stagekey,
             createddate >= CAST(:start_at AS timestamp_ntz) AND createddate < CAST(:end_at AS timestamp_ntz) AS in_range,
             count(*) AS boxes, min(createddate) AS first_at
      FROM {boxes}
      GROUP BY 1, 2, 3)
JOIN {pipelines} AS p ON pipelineid = p.id
"""

FLAGS_SQL = """
WITH opened AS (
  SELECT pipelineid, nvl(json_extract_path_text(fields, '1014'), 'none') AS flag,
         json_extract_array_element_text(assignedtosharingentries, 0) AS first_entry
  FROM {boxes}),
counted AS (
  SELECT pipelineid, flag, count(*) AS boxes, count(first_entry) AS with_entry,
         sum(nvl2(first_entry, 0, 1)) AS without_entry
  FROM opened GROUP BY 1, 2)
SELECT p.name AS pipeline_name, flag, boxes, with_entry, without_entry
FROM counted JOIN {pipelines} AS p ON pipelineid = p.id
"""

# Windows of the replace query: the mart is refilled on three days, the last of them without new rows.
REPLACED = DayWindow(datetime(2024, 1, 12), datetime(2024, 1, 15))
REFILLED = DayWindow(datetime(2024, 1, 12), datetime(2024, 1, 14))


def scan_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stack_tracks(sample.track_tables(spark, sf_dir))


def full_outer_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per person in three tables, joined on the first table's key."""

    def per_person(table: str, schema: str, key: str, count: str, *more) -> DataFrame:
        rows = parquet_table(spark, sf_dir, table, schema).groupBy(F.col(key).alias("person"))
        return rows.agg(F.count("*").alias(count), *more)

    return full_outer_chain(
        per_person("events", sample.EVENTS, "user_id", "events", F.min("ts").alias("first_at")),
        [
            per_person("orders", sample.ORDERS, "o_custkey", "orders"),
            per_person("customer", sample.CUSTOMER, "c_custkey", "accounts"),
        ],
        "person",
    )


def stages_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {"boxes": sample.boxes(spark, sf_dir), "pipelines": sample.pipelines(spark, sf_dir)}
    return sql_over_frames(spark, STAGES_SQL, frames, {"start_at": "1996-01-01", "end_at": "2001-01-01"})


def flags_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {"boxes": sample.boxes(spark, sf_dir), "pipelines": sample.pipelines(spark, sf_dir)}
    return sql_over_frames(spark, FLAGS_SQL, frames)


def sql_to_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    statement = f"""
        SELECT event_type, count(*) AS events, count(DISTINCT user_id) AS users, max(ts) AS last_at
        FROM parquet.`{sf_dir.rstrip('/')}/events.parquet` GROUP BY event_type
    """
    return SqlFrames(spark).create_df(statement)


def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    view = f"csv_boxes_{uuid.uuid4().hex}"
    sample.boxes(spark, sf_dir).createTempView(view)
    with SqlFrames(spark) as frames:
        frames.create_df(
            f"SELECT id, pipelineid, nullif(assignedtosharingentries, '') AS entries, fields, stagekey FROM {view}",
            save_csv=True,
            file_path=path,
        )
    spark.catalog.dropTempView(view)
    return spark.read.option("header", True).option("escape", '"').option("nullValue", "NaN").csv(path)


def sink_truncate_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_table(spark, "outreach_ods")
    old = outreach.outreach_ods(sample.boxes(spark, sf_dir), sample.pipelines(spark, sf_dir), 0)
    truncate_load(old, table)
    truncate_load(outreach_ods(spark, sf_dir).drop("batched_at"), table)
    return named_table(spark, f"spark_catalog.{table}")


def sink_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart of days that lie three days too early, then fully refreshed."""
    mart = scratch_table(spark, "visits")
    tracks = sample.tracks(spark, sf_dir)
    create_mart(visits.daily_visits(tracks, SHIFT_HOURS - 72), mart)
    truncate_load(with_day(visits.daily_visits(tracks)), mart)
    return spark.table(mart).drop(DAY_COLUMN)


def sink_window_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart first filled without the iOS source, then refilled in a window."""
    mart = scratch_table(spark, "visits")
    without_ios = sample.tracks(spark, sf_dir).where(F.col("source") != "ios")
    create_mart(visits.daily_visits(without_ios), mart)
    fresh = visits.daily_visits(sample.tracks(spark, sf_dir, REFILLED))
    replace_window(fresh, mart, REPLACED)
    return spark.table(mart).drop(DAY_COLUMN)


def outreach_ods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.outreach_ods(
        sample.boxes(spark, sf_dir), sample.pipelines(spark, sf_dir), sample.PIPELINE, sample.BATCHED_AT
    )


def outreach_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.outreach_parsed(sample.boxes(spark, sf_dir), sample.PIPELINE)


def outreach_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outreach.outreach_rejects(sample.boxes(spark, sf_dir), sample.PIPELINE)


def daily_visits_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits.daily_visits(sample.tracks(spark, sf_dir, sample.WINDOW))


PROFILED = ("rep_name", "category_id", "stage_type_id", "is_flagged", "leadsource_id")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_tracks": scan_tracks,
    "sql_over_frames": stages_by_sql,
    "sql_json_functions": flags_by_sql,
    "sql_to_frame": sql_to_frame,
    "user_visits_asis_distinct": lambda spark, sf: visits.user_visits_asis_distinct(sample.tracks(spark, sf)),
    "user_visits_asis": lambda spark, sf: visits.user_visits_asis(sample.tracks(spark, sf)),
    "user_visits": lambda spark, sf: visits.user_visits(sample.tracks(spark, sf)),
    "full_outer_chain": full_outer_join_chain,
    "visits_by_stamp": lambda spark, sf: visits.visits_by_stamp(sample.tracks(spark, sf)),
    "visits_by_stamp_dedup": lambda spark, sf: visits.visits_by_stamp_dedup(sample.tracks(spark, sf)),
    "daily_visits": lambda spark, sf: visits.daily_visits(sample.tracks(spark, sf)),
    "daily_visits_window": daily_visits_window,
    "having_min_events": lambda spark, sf: visits.daily_visits(sample.tracks(spark, sf), min_events=2),
    "outreach_ods": outreach_ods,
    "outreach_parsed": outreach_parsed,
    "outreach_rejects": outreach_rejects,
    "profile_counts": lambda spark, sf: row_counts(outreach_parsed(spark, sf)),
    "profile_domain": lambda spark, sf: column_domains(outreach_parsed(spark, sf), PROFILED),
    "profile_nulls": lambda spark, sf: null_counts(outreach_parsed(spark, sf), PROFILED),
    "profile_samples": lambda spark, sf: first_rows(outreach_parsed(spark, sf), PROFILED, outreach.SAMPLE_ORDER),
    "sink_truncate_load": sink_truncate_load,
    "sink_full_refresh": sink_full_refresh,
    "sink_window_replace": sink_window_replace,
    "sink_csv": sink_csv,
}
