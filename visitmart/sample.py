"""The provided tables read as the relations that the plans expect.

Tracks: every row of ``events``. A device id holds the user and a four-hour slot of the
day, NULL for one user, so that many devices miss a platform. Views are web tracks,
clicks and the dearer views are the second web source (the two overlap), purchases are
Android tracks stamped by the hour (with repeats), sign-ups and errors are iOS tracks
(errors without an event name).

Boxes: every row of ``orders``, with JSON columns in good and bad shape by price band.
Pipelines: ``region``; an order belongs to the region numbered by its priority.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from visitmart.functions.daywindow import DayWindow
from visitmart.sources.tables import parquet_table
from visitmart.sources.tracks import TrackRule, TrackTable, split_log

# Columns of the provided tables that are used here.
EVENTS = "ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
REGION = "r_regionkey INT, r_name STRING"
CUSTOMER = "c_custkey BIGINT"

WINDOW = DayWindow(datetime(2024, 1, 10), datetime(2024, 1, 11))
PIPELINE = 2
BATCHED_AT = datetime(2024, 1, 31, 9)
LOGGED_OUT_USER = 7
DEAR_VIEW = 30.0


# As SQL over the columns of events.
DEVICE = f"nullif(user_id, {LOGGED_OUT_USER}) * 6 + hour(ts) div 4"
EVENT = "nullif(event_type, 'error')"
RULES = {
    "web": TrackRule("event_type = 'view'", "ts"),
    "click": TrackRule(f"event_type = 'click' OR (event_type = 'view' AND value >= {DEAR_VIEW})", "ts"),
    "aos": TrackRule("event_type = 'purchase'", "CAST(date_trunc('hour', ts) AS timestamp_ntz)"),
    "ios": TrackRule("event_type IN ('signup', 'error')", "ts"),
}


def tracks(spark: SparkSession, sf_dir: str, window: DayWindow | None = None) -> DataFrame:
    """All tracks, from one scan of the log."""
    log = parquet_table(spark, sf_dir, "events", EVENTS)
    return split_log(
        log, RULES, user=DEVICE, event=EVENT, stamp="ts", slack=timedelta(hours=1), window=window
    )


def track_tables(spark: SparkSession, sf_dir: str) -> dict[str, TrackTable]:
    """The same tracks as one table per source."""
    log = parquet_table(spark, sf_dir, "events", EVENTS)
    return {
        source: TrackTable(
            log.where(rule.where).selectExpr(
                f"{DEVICE} AS anonymous_id",
                f"{rule.stamp} AS timestamp",
                f"{rule.stamp} AS received_at",
                f"{EVENT} AS event",
            )
        )
        for source, rule in RULES.items()
    }


def _banded(shapes: dict[int, str | None], usual: str) -> str:
    cases = [f"WHEN {band} THEN {'NULL' if text is None else repr(text)}" for band, text in shapes.items()]
    return f"CASE CAST(floor(o_totalprice / 10000) AS INT) {' '.join(cases)} ELSE {usual} END"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = """concat('[{"email":"rep', o_custkey, '@example.com"},{"email":"x@y"}]')"""
    flag = "CASE o_orderstatus WHEN 'F' THEN 'true' WHEN 'O' THEN 'false' ELSE 'null' END"
    fields = f"""concat('{{"1003":"', month(o_orderdate), '","1014":', {flag}, ',"1002":', day(o_orderdate), '}}')"""
    return parquet_table(spark, sf_dir, "orders", ORDERS).selectExpr(
        "o_orderkey AS id",
        "CAST(substr(o_orderpriority, 1, 1) AS INT) - 1 AS pipelineid",
        f"{_banded(ENTRY_SHAPES, entry)} AS assignedtosharingentries",
        f"{_banded(FIELD_SHAPES, fields)} AS fields",
        """CASE WHEN o_orderstatus = 'F' THEN CAST(month(o_orderdate) AS STRING) WHEN o_orderstatus = 'O' THEN '5'
           WHEN o_totalprice < 250000 THEN 'x' ELSE '' END AS stagekey""",
        "o_orderdate AS createddate",
    )


def pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet_table(spark, sf_dir, "region", REGION).selectExpr("r_regionkey AS id", "r_name AS name")


# Text of the JSON columns by price band (price / 10,000); other bands hold well-formed text.
ENTRY_SHAPES: dict[int, str | None] = {
    0: "[]",
    1: "{}",
    2: "bad",
    3: '[{"email":null}]',
    4: "null",
    5: None,
    6: "",
    7: '[{"email":"zy"}]',
    8: '[{"email":""}]',
    9: '{"email":"solo@example.com"}',
    10: "[5]",
    23: '[{"email":"first@example.com"},5]',
    25: '[{"email":"a@example.com"}] junk',
    26: '[{"email":5}]',
    27: '{"email":"a@example.com"}{"email":"b@example.com"}',
    28: '[{"email":"a@example.com"}]]',
}
FIELD_SHAPES: dict[int, str | None] = {
    11: "bad",
    12: "[]",
    13: None,
    14: '[{"1003":"9","1014":"true"},{"1003":"8"}]',
    15: '{"1003":"abc","1014":"maybe","1002":3000000000}',
    16: '{"1003":"","1014":"false","1002":true}',
    17: '{"1003":" 12 ","1014":null}',
    18: "{}",
    19: "5",
    20: '{"1003":"7"',
    24: '[{"1003":"3"},null,"x"]',
    29: '{"1003":"7"} junk',
    30: '{"1003":"7"},{"1003":"8"}',
    31: '{"1003":"7"}]',
    32: '{"1014":"yes","1002":4}',
}
