from datetime import datetime

from pyspark.sql import functions as F

from conftest import SF, rows_of
from visitmart import sample
from visitmart.functions.jsoncols import as_flag, as_int, as_text, first_value, marked_json, member, one_value, part
from visitmart.operators.joins import BROADCAST_ROWS, fits_broadcast
from visitmart.plans.outreach import outreach_ods, outreach_parsed, outreach_rejects

SCHEMA = (
    "id string, pipelineid string, assignedtosharingentries string, fields string, stagekey string,"
    " createddate timestamp_ntz"
)
DAY = datetime(2024, 1, 1)

FIELD_CASES = [
    # text of member 1003 in its object, integer, flag
    ('{"1003":"7"}', 7, None),
    ('{"1003":7}', 7, None),
    ('{"1003":"abc"}', None, None),
    ('{"1003":""}', None, None),
    ('{"1003":"3.5"}', None, None),
    ('{"1003":null}', None, None),
    ("{}", None, None),
    ('{"1003":3.0}', None, None),
    ('{"1003":true}', None, True),
    ('{"1003":false}', None, False),
    ('{"1003":"true"}', None, True),
    ('{"1003":" 12 "}', 12, None),
    ('{"1003":"1_000"}', None, None),
    ('{"1003":3000000000}', None, None),
    ('{"1003":1,"1003":2}', 2, None),
    ('[{"1003":"9"},{"1003":"8"}]', 9, None),
    ('[{"1003":"9"},5,null]', 9, None),
    ('[5,{"1003":"9"}]', None, None),
    ('[[{"1003":"9"}]]', None, None),
    ('[{"1003":"9"},bad]', None, None),
    ("[]", None, None),
    ("null", None, None),
    ("5", None, None),
    ("bad", None, None),
    ('{"1003":"7"} junk', None, None),
    ('{"1003":"7"},{"1003":"8"}', None, None),
    ('{"1003":"7"}{"1003":"8"}', None, None),
    ('{"1003":"7"}]', None, None),
    ('{"1003":"7"}] junk [', None, None),
    ('[{"1003":"7"}]]', None, None),
    ("{'1003':'7'}", None, None),
    (' {"1003":"7"} ', 7, None),
    ("", None, None),
    (None, None, None),
]


def test_member_values(spark):
    frame = spark.createDataFrame([(at, case[0]) for at, case in enumerate(FIELD_CASES)], "at int, text string")
    text = F.col("text")
    value = as_text(member(first_value(one_value(marked_json(text), text)), "1003"))
    found = frame.select("at", as_int(value).alias("number"), as_flag(value).alias("flag")).orderBy("at").collect()
    assert [(row.number, row.flag) for row in found] == [case[1:] for case in FIELD_CASES]


EMAIL_CASES = [
    # text, name, reason
    ('[{"email":"z@y"}]', "z", None),
    ('[{"email":"zy"}]', "zy", None),
    ('[{"email":""}]', "", None),
    ('[{"email":"a@b"},{"email":"c@d"}]', "a", None),
    ('{"email":"solo@b"}', "solo", None),
    ('[{"email":"a@b"},5]', "a", None),
    ('[{"email":"a@b"},bad]', None, "malformed_json"),
    ('[[{"email":"a@b"}]]', None, "not_an_object"),
    ("[]", None, "empty_array"),
    ("{}", None, "missing_key"),
    ("[{}]", None, "missing_key"),
    ("bad", None, "malformed_json"),
    (" ", None, "malformed_json"),
    ('[{"email":"z@y"}', None, "malformed_json"),
    ('[{"email":null}]', None, "null_value"),
    ("null", None, "not_an_object"),
    ("[5]", None, "not_an_object"),
    ("[null]", None, "not_an_object"),
    ('"z@y"', None, "not_an_object"),
    ('[{"email":5}]', None, "not_text"),
    ('[{"email":true}]', None, "not_text"),
    ('[{"email":{"a":"b"}}]', None, "not_text"),
    ('[{"email":"z@y"}] junk', None, "malformed_json"),
    ('[{"email":"z@y"}]]', None, "malformed_json"),
    ('{"email":"z@y"}{"email":"a@b"}', None, "malformed_json"),
    (None, None, None),
    ("", None, None),
]


def boxes(spark, rows):
    return spark.createDataFrame([(str(at), "p", *row, DAY) for at, row in enumerate(rows)], SCHEMA)


def test_email_names_and_rejects(spark):
    frame = boxes(spark, [(case[0], "{}", "1") for case in EMAIL_CASES])
    names = outreach_ods(frame, spark.createDataFrame([("p", "P")], "id string, name string"), "p")
    found = {int(row.id): row.rep_name for row in names.collect()}
    assert [found[at] for at in range(len(EMAIL_CASES))] == [case[1] for case in EMAIL_CASES]
    rejects = {int(row.id): row for row in outreach_rejects(frame, "p").collect()}
    for at, (text, _, reason) in enumerate(EMAIL_CASES):
        if reason is None:
            assert at not in rejects
        else:
            assert (rejects[at].column_name, rejects[at].reason, rejects[at].source_text) == ("rep_name", reason, text)


def test_part_has_no_missing_index(spark):
    row = spark.range(1).select(part(F.lit("a@b"), "@", 1).alias("b"), part(F.lit("a"), "@", 1).alias("none")).first()
    assert (row.b, row.none) == ("b", "")


def test_field_and_stage_rejects(spark):
    frame = boxes(
        spark,
        [
            (None, '{"1003":"abc","1002":true,"1014":"maybe"}', "x"),
            (None, "[]", "5"),
            (None, "bad", ""),
            (None, "5", None),
            (None, '{"1003":"","1014":null}', "5"),
            (None, None, "3000000000"),
            (None, "[3]", "5"),
        ],
    )
    assert rows_of(outreach_rejects(frame, "p").select("id", "column_name", "reason")) == [
        ("0", "category_id", "not_an_integer"),
        ("0", "is_flagged", "not_a_flag"),
        ("0", "leadsource_id", "not_an_integer"),
        ("0", "stage_type_id", "not_an_integer"),
        ("1", "fields", "empty_array"),
        ("2", "fields", "malformed_json"),
        ("3", "fields", "not_an_object"),
        ("5", "stage_type_id", "not_an_integer"),
        ("6", "fields", "not_an_object"),
    ]


def test_bad_shapes_are_in_the_sample(spark):
    """The oracle check is worth as much as the shapes it meets."""
    found = {tuple(row) for row in outreach_rejects(sample.boxes(spark, SF), sample.PIPELINE).select("column_name", "reason").collect()}
    assert {("rep_name", "not_text"), ("rep_name", "malformed_json"), ("fields", "malformed_json"), ("is_flagged", "not_a_flag")} <= found
    texts = {row.source_text for row in outreach_rejects(sample.boxes(spark, SF), sample.PIPELINE).select("source_text").distinct().collect()}
    shapes = [*sample.ENTRY_SHAPES.items(), *sample.FIELD_SHAPES.items()]
    assert {text for band, text in shapes if band >= 25} <= texts


def test_stage_key(spark):
    frame = boxes(spark, [(None, None, "5"), (None, None, ""), (None, None, "x"), (None, None, None)])
    names = spark.createDataFrame([("p", "P")], "id string, name string")
    assert [row[0] for row in rows_of(outreach_ods(frame, names, "p").select("stage_type_id"))] == [5, None, None, None]
    assert {row[0] for row in outreach_parsed(frame, "p").select("stage_type_id").collect()} == {"5", "", "x", None}


def test_only_the_pipeline_and_batch_time(spark):
    frame = boxes(spark, [('[{"email":"z@y"}]', '{"1014":"true"}', "5")])
    frame = frame.unionByName(frame.withColumn("pipelineid", F.lit("q")))
    names = spark.createDataFrame([("p", "P"), ("q", "Q")], "id string, name string")
    batched_at = datetime(2024, 1, 2, 9, 30)
    assert rows_of(outreach_ods(frame, names, "p", batched_at)) == [
        ("0", "p", "P", "z", None, 5, True, None, DAY, batched_at)
    ]
    assert outreach_ods(frame, names, "absent").count() == 0


def copies_and_names(spark, copies, names):
    """Copies of one box, and as many pipeline rows of its id."""
    one = boxes(spark, [('[{"email":"z@y"}]', "{}", "5")])
    many = one.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("n").repartition(8)
    return many, spark.createDataFrame([("p", f"P{at}") for at in range(names)], "id string, name string")


def explained(frame, capsys):
    frame.explain()
    return capsys.readouterr().out


def test_few_lookup_rows_are_broadcast(spark, capsys):
    copies, names = copies_and_names(spark, 5000, 2)
    joined = outreach_ods(copies, names, "p")
    assert "BroadcastHashJoin" in explained(joined, capsys)
    assert joined.count() == 10000
    assert joined.groupBy("pipeline_name").count().count() == 2


def test_many_lookup_rows_are_joined_by_a_spread_shuffle(spark, capsys):
    copies, names = copies_and_names(spark, 80, BROADCAST_ROWS + 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = outreach_ods(copies, names, "p")
        plan = explained(joined, capsys)
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        sizes = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 80 * (BROADCAST_ROWS + 1)
        assert len(sizes) > 2 and max(sizes) < sum(sizes) * 0.6
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    adaptive = outreach_ods(copies, names, "p")
    assert adaptive.count() == 80 * (BROADCAST_ROWS + 1)
    assert "SortMergeJoin" in explained(adaptive, capsys)


def test_size_check(spark):
    assert fits_broadcast(spark.range(0)) and fits_broadcast(spark.range(BROADCAST_ROWS))
    assert not fits_broadcast(spark.range(BROADCAST_ROWS + 1))
    assert not fits_broadcast(spark.range(20).select(F.repeat(F.lit("x"), 1 << 20).alias("wide")))
