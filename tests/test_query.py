from datetime import date, datetime
from decimal import Decimal

import pytest

from conftest import rows_of
from visitmart.session import scratch_path, scratch_table, shared_folder
from visitmart.sources.query import Split, SqlFrames, read_query, sql_over_frames


def test_sql_over_frames_binds_parameters(spark):
    numbers = spark.range(5).withColumnRenamed("id", "n")
    names = spark.createDataFrame([(1, "one"), (4, "it's")], "n int, name string")
    found = sql_over_frames(
        spark,
        "SELECT x.n, y.name FROM {numbers} x LEFT JOIN {names} y ON x.n = y.n WHERE x.n > :least AND y.name = :name",
        {"numbers": numbers, "names": names},
        {"least": 0, "name": "it's"},
    )
    assert rows_of(found) == [(4, "it's")]


def test_frames_take_no_name_in_the_session(spark):
    spark.sql("SELECT 'mine' AS v").createOrReplaceTempView("numbers")
    before = {table.name for table in spark.catalog.listTables()}
    found = sql_over_frames(spark, "SELECT sum(id) AS total FROM {numbers}", {"numbers": spark.range(4)})
    assert found.first()[0] == 6
    assert spark.table("numbers").first()[0] == "mine"
    assert {table.name for table in spark.catalog.listTables()} == before
    spark.catalog.dropTempView("numbers")


DIALECT = [
    ("nvl(NULL, 3)", 3),
    ("nvl2(NULL, 1, 0)", 0),
    ("nvl2(5, 1, 0)", 1),
    ("decode(0, 0, 0, 1)", 0),
    ("decode(4, 0, 0, 1)", 1),
    ("decode(CAST(NULL AS INT), 0, 0, 1)", 1),
    ("decode('true', 'true', true, 'false', false)", True),
    ("decode('other', 'true', true, 'false', false)", None),
    ("split_part('z@y', '@', 1)", "z"),
    ("split_part('zy', '@', 1)", "zy"),
    ("json_extract_path_text('{\"1003\":\"7\"}', '1003')", "7"),
    ("json_extract_path_text('{\"a b\":1}', 'a b')", "1"),
    ("json_extract_path_text('{}', '1003')", None),
    ("json_extract_path_text('bad', '1003')", None),
    ("json_extract_path_text('{\"1003\":\"7\"} junk', '1003')", None),
    ("json_extract_path_text(json_extract_array_element_text('[{\"email\":\"z@y\"}]', 0), 'email')", "z@y"),
    ("json_extract_array_element_text('[{\"email\":\"z\"},5]', 0)", '{"email":"z"}'),
    ("json_extract_array_element_text('[]', 0)", None),
    ("CAST(date_trunc('day', timestamp_ntz'2024-01-01 15:00:00' + interval '9 hour') AS STRING)", "2024-01-02 00:00:00"),
    ("CAST(timestamp_ntz'2024-01-02 00:00:00' + interval '-1 days' AS STRING)", "2024-01-01 00:00:00"),
]


@pytest.mark.parametrize("expression, value", DIALECT)
def test_warehouse_sql_runs(spark, expression, value):
    assert SqlFrames(spark).create_df(f"SELECT {expression} AS v").first()[0] == value


def test_sql_with_ctes_unions_ordinals_and_lateral_aliases(spark):
    found = sql_over_frames(
        spark,
        """
        WITH stacked AS (
          SELECT k, 1 AS left_row, 0 AS right_row FROM {l} UNION ALL SELECT k, 0, 1 FROM {r}),
        once AS (SELECT k FROM {l} UNION SELECT k FROM {r})
        SELECT k, max(left_row) AS in_left, max(right_row) AS in_right, in_left + in_right AS sides
        FROM (SELECT s.* FROM stacked s JOIN once o ON s.k = o.k)
        WHERE k IS NOT NULL
        GROUP BY 1 HAVING count(*) > 0
        """,
        {"l": spark.range(3).toDF("k"), "r": spark.range(2, 4).toDF("k")},
    )
    assert rows_of(found) == [(0, 1, 0, 1), (1, 1, 0, 1), (2, 1, 1, 2), (3, 0, 1, 1)]


def test_create_df_and_csv(spark):
    path = scratch_path(spark, "frame")
    frame = SqlFrames(spark).create_df("SELECT 1 AS a, CAST(NULL AS STRING) AS b", save_csv=True, file_path=path)
    assert frame.columns == ["a", "b"] and rows_of(frame) == [(1, None)]
    assert rows_of(spark.read.option("header", True).csv(path)) == [("1", "NaN")]


def test_csv_and_frame_hold_the_same_rows(spark):
    path = scratch_path(spark, "frame")
    frame = SqlFrames(spark).create_df("SELECT id, rand() AS r FROM range(50)", save_csv=True, file_path=path)
    back = spark.read.option("header", True).csv(path).selectExpr("CAST(id AS BIGINT) id", "CAST(r AS DOUBLE) r")
    assert rows_of(frame) == rows_of(back)


def test_tables_behind_csv_frames_go_with_their_owner(spark):
    with SqlFrames(spark) as frames:
        frame = frames.create_df("SELECT 1 AS a, NULL AS b", save_csv=True, file_path=scratch_path(spark, "frame"))
        (table,) = frames.kept
        assert spark.catalog.tableExists(table) and rows_of(frame) == [(1, None)]
    assert not spark.catalog.tableExists(table)


def test_jdbc_needs_a_split(spark):
    with pytest.raises(ValueError, match="split"):
        SqlFrames(spark, {"url": "jdbc:none"}).create_df("SELECT 1")


class Reader:
    """Stands in for the JDBC reader: keeps the options and answers the bounds query."""

    def __init__(self, bounds):
        self.bounds, self.loads, self.given = bounds, [], {}

    @property
    def read(self):
        self.given = {}
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.given.update(options)
        return self

    def option(self, key, value):
        self.given[key] = value
        return self

    def load(self):
        self.loads.append(dict(self.given))
        return self

    def first(self):
        return self.bounds


def test_jdbc_query_is_cut_into_ranges():
    reader = Reader((3, 90, 50))
    read_query(reader, "SELECT id FROM t;", {"url": "jdbc:x", "user": "u"}, Split("id", 8))
    asked, read = reader.loads
    assert asked["query"].startswith("SELECT min(id)") and "(SELECT id FROM t)" in asked["query"]
    assert read == {
        "url": "jdbc:x",
        "user": "u",
        "dbtable": "(SELECT id FROM t) source_query",
        "partitionColumn": "id",
        "lowerBound": "3",
        "upperBound": "90",
        "numPartitions": 8,
    }


def test_jdbc_bounds_can_be_given():
    reader = Reader(None)
    read_query(reader, "SELECT id FROM t", {"url": "jdbc:x"}, Split("id", 4, 0, 100))
    assert len(reader.loads) == 1 and reader.loads[0]["upperBound"] == "100"


def test_jdbc_bounds_are_whole_numbers_or_dates():
    reader = Reader((Decimal("3.00"), 90.5, 50))
    read_query(reader, "SELECT id FROM t", {"url": "jdbc:x"}, Split("id", 8))
    assert (reader.loads[-1]["lowerBound"], reader.loads[-1]["upperBound"]) == ("3", "90")
    reader = Reader((date(2024, 1, 1), datetime(2024, 1, 2, 3), 50))
    read_query(reader, "SELECT d FROM t", {"url": "jdbc:x"}, Split("d", 8))
    assert (reader.loads[-1]["lowerBound"], reader.loads[-1]["upperBound"]) == ("2024-01-01", "2024-01-02 03:00:00")


def test_jdbc_split_column_without_values():
    with pytest.raises(ValueError, match="no row has a value"):
        read_query(Reader((None, None, 7)), "SELECT id FROM t", {"url": "jdbc:x"}, Split("id", 4))
    reader = Reader((None, None, 0))
    read_query(reader, "SELECT id FROM t", {"url": "jdbc:x"}, Split("id", 4))
    assert "partitionColumn" not in reader.loads[-1]


class Session:
    """Stands in for a session: the settings, the master and the context's checkpoint folder."""

    def __init__(self, master, **settings):
        self.conf, self.sparkContext = self, self
        self.master, self.settings, self.folder = master, settings, None

    def get(self, key, default=None):
        return self.settings.get(key.replace(".", "_"), default)

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder


def test_shared_folder_is_the_one_the_cluster_names():
    assert shared_folder(Session("yarn", spark_checkpoint_dir="hdfs://shared/x/")) == "hdfs://shared/x"
    with pytest.raises(RuntimeError):
        shared_folder(Session("yarn"))
    on_context = Session("yarn")
    on_context.setCheckpointDir("hdfs://shared/y")
    assert shared_folder(on_context) == "hdfs://shared/y"
    local = Session("local[2]")
    assert shared_folder(local).startswith("/tmp/") and shared_folder(local) == shared_folder(local)


def test_scratch_data_can_be_dropped(spark, monkeypatch):
    from visitmart import session

    monkeypatch.setattr(session, "SCRATCH_DATABASE", "visitmart_scratch_of_a_test")
    path, table = scratch_path(spark, "rows"), scratch_table(spark, "rows")
    spark.range(3).write.parquet(path)
    spark.range(3).write.saveAsTable(table)
    session.drop_scratch(spark)
    assert not spark.catalog.tableExists(table)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    session.drop_scratch(spark)


def test_scratch_tables_lie_in_the_shared_folder(spark):
    table = scratch_table(spark, "t")
    spark.range(1).write.saveAsTable(table)
    location = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()[1]
    assert spark.conf.get("spark.checkpoint.dir") in location
