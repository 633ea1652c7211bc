"""CRM boxes with JSON text columns, flattened into typed tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.functions.daywindow import ntz
from visitmart.functions.jsoncols import (
    as_flag,
    as_int,
    as_text,
    first_value,
    marked_json,
    member,
    object_problem,
    one_value,
    part,
    text_only,
)
from visitmart.operators.joins import single_key_join

# Members of the two JSON columns.
EMAIL = "email"
CATEGORY = "1003"
FLAG = "1014"
LEAD_SOURCE = "1002"

# Ranks the rows of samples.
SAMPLE_ORDER = ("created_at", "rep_name", "category_id", "stage_type_id", "is_flagged", "leadsource_id")
PARSED_COLUMNS = ("rep_name", "category_id", "stage_type_id", "is_flagged", "leadsource_id", "created_at")


def _opened(boxes: DataFrame) -> DataFrame:
    """Boxes with the JSON columns parsed, once per row and column, and their members."""
    entries, fields = F.col("assignedtosharingentries"), F.col("fields")
    parsed = boxes.withColumns({"__entries_json": marked_json(entries), "__fields_json": marked_json(fields)})
    values = parsed.withColumns(
        {
            "__entries": one_value(F.col("__entries_json"), entries),
            "__values": one_value(F.col("__fields_json"), fields),
        }
    )
    firsts = values.withColumns({"__entry": first_value(F.col("__entries")), "__fields": first_value(F.col("__values"))})
    first = F.col("__fields")
    return firsts.withColumns(
        {
            "__email": member(F.col("__entry"), EMAIL),
            "__category": as_text(member(first, CATEGORY)),
            "__flag": as_text(member(first, FLAG)),
            "__source": as_text(member(first, LEAD_SOURCE)),
        }
    )


def _typed(boxes: DataFrame) -> DataFrame:
    """Boxes with the typed columns; the JSON columns and what was read from them are left out."""
    return (
        _opened(boxes)
        .withColumns(
            {
                "rep_name": part(text_only(F.col("__email")), "@", 0),
                "category_id": as_int(F.col("__category")),
                "is_flagged": as_flag(F.col("__flag")),
                "leadsource_id": as_int(F.col("__source")),
            }
        )
        .drop("assignedtosharingentries", "fields", *_READ)
    )


# Columns that only serve the parse.
_READ = ("__entries_json", "__fields_json", "__entries", "__values", "__entry", "__fields", "__email", "__category", "__flag", "__source")


def outreach_ods(
    boxes: DataFrame, pipelines: DataFrame, pipeline_id, batched_at: datetime | None = None
) -> DataFrame:
    """Boxes of one pipeline with the pipeline's name and typed columns.

    ``batched_at`` is the run's shifted time; without it the column is left out.
    A missing or unreadable JSON value gives NULL. If pipelines repeat the id, each box
    comes once per pipeline row, as in any inner join.
    """
    boxes = boxes.select("id", "pipelineid", "assignedtosharingentries", "fields", "stagekey", "createddate")
    names = pipelines.select(F.col("id").alias("pipeline_id"), F.col("name").alias("pipeline_name"))
    # Typed before the join, so that no JSON text is shuffled where the join needs a shuffle.
    typed = _typed(boxes.where(F.col("pipelineid") == pipeline_id))
    rows = single_key_join(typed, "pipelineid", names, "pipeline_id", pipeline_id).select(
        "id",
        "pipeline_id",
        "pipeline_name",
        "rep_name",
        "category_id",
        as_int(F.col("stagekey")).alias("stage_type_id"),
        "is_flagged",
        "leadsource_id",
        F.col("createddate").alias("created_at"),
    )
    return rows if batched_at is None else rows.withColumn("batched_at", ntz(batched_at))


def outreach_parsed(boxes: DataFrame, pipeline_id) -> DataFrame:
    """Boxes of one pipeline without ids; ``stage_type_id`` stays the text it is in the source."""
    return (
        _typed(boxes.where(F.col("pipelineid") == pipeline_id))
        .withColumnRenamed("stagekey", "stage_type_id")
        .withColumnRenamed("createddate", "created_at")
        .select(*PARSED_COLUMNS)
    )


def outreach_rejects(boxes: DataFrame, pipeline_id) -> DataFrame:
    """One row per value that could not be read, with the reason and the source text.

    A missing JSON member is a problem for the e-mail only; other members may be absent, null
    or empty. Every NULL that comes from an unusable text has its row here.
    """
    entries, fields = F.col("assignedtosharingentries"), F.col("fields")
    rows = _opened(boxes.where(F.col("pipelineid") == pipeline_id))
    email = F.col("__email")
    no_entry = object_problem(entries, F.col("__entries"), F.col("__entry"))
    no_email = (
        F.when(email.isNull(), "missing_key")
        .when(F.schema_of_variant(email) == "VOID", "null_value")
        .when(text_only(email).isNull(), "not_text")
    )
    given = F.coalesce(entries, F.lit("")) != ""
    flag = F.col("__flag")
    problems = F.array(
        _problem("rep_name", F.when(given, F.coalesce(no_entry, no_email)), entries),
        _problem("fields", object_problem(fields, F.col("__values"), F.col("__fields")), fields),
        _problem("category_id", _not_an_integer(F.col("__category")), fields),
        _problem("is_flagged", F.when((flag != "") & as_flag(flag).isNull(), "not_a_flag"), fields),
        _problem("leadsource_id", _not_an_integer(F.col("__source")), fields),
        _problem("stage_type_id", _not_an_integer(F.col("stagekey")), F.col("stagekey")),
    )
    return (
        rows.select("id", F.explode(problems).alias("problem"))
        .where(F.col("problem").isNotNull())
        .select("id", "problem.column_name", "problem.reason", "problem.source_text")
    )


def _not_an_integer(text: Column) -> Column:
    return F.when((text != "") & as_int(text).isNull(), "not_an_integer")


def _problem(column: str, reason: Column, source: Column) -> Column:
    return F.when(
        reason.isNotNull(),
        F.struct(F.lit(column).alias("column_name"), reason.alias("reason"), source.alias("source_text")),
    )
