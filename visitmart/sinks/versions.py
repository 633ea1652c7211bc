"""Tables that are published in versions: a reader sees the old rows or the new ones at any moment.

The name readers use is a view. Behind it each version is a table of its own, made of partitions
that never change: rows are written once, to the folder of their load, and a version only lists which
loads' partitions belong to it. So replacing a few days writes these days and no others.

A load goes through these steps:

1. its rows are written to a folder of their own;
2. a table with that folder's partitions and those kept from the version before is made under a name of its own;
3. that table is renamed to the next version's name. A name can be taken once, so of two loads that
   started from one version the second fails here and leaves nothing behind;
4. the view is pointed at the newest version, by one change in the catalog;
5. versions before the last two go, with the folders that only they list.

A failure before step 3 leaves the old version as it was. A load that fails after it is published by
whichever load comes next, or by running it again. The catalog must be Spark's own (in memory or a metastore).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Partition column of the version tables with the load that wrote a row; the view leaves it out.
LOAD_COLUMN = "loaded_by"
#: Versions that stay, the newest among them: reads that began on the one before end well.
KEPT_VERSIONS = 2

_NULL = "__HIVE_DEFAULT_PARTITION__"
_BATCH = 500


class ConcurrentLoad(RuntimeError):
    """Another load published a version since this one read the table; its rows are there, this one's are not."""


@dataclass(frozen=True)
class Version:
    """A published version: its number (0: none yet), its table, and its partitions as (load, value of the partition column)."""

    number: int
    table: str
    partitions: tuple[tuple[str, str | None], ...]
    partition_by: str | None = None


def can_hold(spark: SparkSession, name: str) -> bool:
    """Whether the name is in Spark's own catalog, so that versions can stand behind it."""
    return _names(spark, name) is not None


def _names(spark: SparkSession, name: str) -> tuple[str, str] | None:
    """Database and table, or None for a name in another catalog than Spark's own."""
    parts = name.replace("`", "").split(".")
    catalog = parts[0] if len(parts) == 3 else spark.catalog.currentCatalog()
    if catalog != "spark_catalog" or len(parts) > 3:
        return None
    return (parts[-2] if len(parts) > 1 else spark.catalog.currentDatabase()), parts[-1]


def _quoted(database: str, table: str) -> str:
    return f"`{database}`.`{table}`"


def _numbers(spark: SparkSession, database: str, table: str) -> list[int]:
    found = spark.sql(f"SHOW TABLES IN `{database}` LIKE '{table}__v*'").collect()
    matches = (re.fullmatch(re.escape(table.lower()) + r"__v(\d{8})", row["tableName"].lower()) for row in found)
    return sorted(int(match[1]) for match in matches if match)


def _version_table(database: str, table: str, number: int) -> str:
    return _quoted(database, f"{table}__v{number:08d}")


def _partitions(spark: SparkSession, table: str) -> tuple[tuple[str, str | None], ...]:
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        load, *rest = (unquote(part.split("=", 1)[1]) for part in row[0].split("/"))
        found.append((load, None if not rest or rest[0] == _NULL else rest[0]))
    return tuple(found)


def _folder(spark: SparkSession, database: str, table: str) -> str:
    location = {row[0]: row[1] for row in spark.sql(f"DESCRIBE DATABASE `{database}`").collect()}["Location"]
    return f"{location.rstrip('/')}/{table}__loads"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _delete(spark: SparkSession, path: str) -> None:
    files, at = _files(spark, path)
    files.delete(at, True)


def is_versioned(spark: SparkSession, name: str) -> bool:
    """Whether the name is one that ``publish`` made."""
    names = _names(spark, name)
    return names is not None and bool(_numbers(spark, *names))


def newest(spark: SparkSession, name: str) -> Version:
    """The newest version; the view points at it afterwards, also if a load ended before it did that."""
    database, table = _own_names(spark, name)
    numbers = _numbers(spark, database, table)
    if not numbers:
        return Version(0, "", ())
    _point(spark, database, table)
    behind = _version_table(database, table, numbers[-1])
    columns = [column.name for column in spark.catalog.listColumns(behind) if column.isPartition]
    return Version(numbers[-1], behind, _partitions(spark, behind), *columns[1:])


def _own_names(spark: SparkSession, name: str) -> tuple[str, str]:
    names = _names(spark, name)
    if names is None:
        raise ValueError(f"{name} is not in Spark's own catalog")
    return names


def publish(
    frame: DataFrame,
    name: str,
    base: Version,
    partition_by: str | None = None,
    keep: Callable[[str | None], bool] = lambda value: False,
    accept: Callable[[set[str | None]], None] = lambda values: None,
    spread: Callable[[DataFrame], DataFrame] = lambda frame: frame,
) -> Version:
    """Publish the frame's rows, and those partitions of ``base`` that ``keep`` names by their value, as the next version.

    ``accept`` is given the values of the new rows' partition column and may raise. Columns are those of ``base``, matched by
    name and cast, or the frame's own for a first version. ``ConcurrentLoad`` is raised, and nothing
    changed, if there is a version after ``base`` by then. The frame may read the table itself.
    """
    spark = frame.sparkSession
    database, table = _own_names(spark, name)
    if base.number:
        schema = spark.table(base.table).drop(LOAD_COLUMN).schema
        unknown = {c.lower() for c in frame.columns} - {c.lower() for c in schema.names}
        if unknown:
            raise ValueError(f"{name} has no column {', '.join(sorted(unknown))}")
        frame = frame.select(*[F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in schema])
    load, root = uuid.uuid4().hex, _folder(spark, database, table)
    own = f"{root}/{LOAD_COLUMN}={load}"
    stage = f"{table}__stage_{load}"
    try:
        values = _write(spread(frame), own, partition_by)
        accept(values)
        _make(spark, frame, _quoted(database, stage), root, partition_by)
        kept = [part for part in base.partitions if keep(part[1])]
        fresh = [(load, value) for value in values] if partition_by else [(load, None)]
        _add(spark, _quoted(database, stage), partition_by, [*kept, *fresh])
        _commit(spark, database, table, stage, base.number + 1)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, stage)}")
        _delete(spark, own)
        raise
    _point(spark, database, table)
    _retire(spark, database, table, root, partition_by)
    behind = _version_table(database, table, base.number + 1)
    return Version(base.number + 1, behind, tuple([*kept, *fresh]), partition_by)


def _write(frame: DataFrame, path: str, partition_by: str | None) -> set[str | None]:
    """Writes the rows; the values of the partition column are the names of the folders."""
    writer = frame.write.partitionBy(partition_by) if partition_by else frame.write
    writer.parquet(path)
    if not partition_by:
        return set()
    files, at = _files(frame.sparkSession, path)
    folders = (status.getPath().getName() for status in files.listStatus(at) if status.isDirectory())
    values = (unquote(folder.split("=", 1)[1]) for folder in folders if "=" in folder)
    return {None if value == _NULL else value for value in values}


def _make(spark: SparkSession, frame: DataFrame, stage: str, root: str, partition_by: str | None) -> None:
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in frame.schema)
    by = ", ".join(f"`{column}`" for column in (LOAD_COLUMN, partition_by) if column)
    spark.sql(f"CREATE TABLE {stage} ({columns}, `{LOAD_COLUMN}` string) USING parquet PARTITIONED BY ({by}) LOCATION '{root}'")


def _add(spark: SparkSession, stage: str, partition_by: str | None, partitions: list[tuple[str, str | None]]) -> None:
    def spec(load: str, value: str | None) -> str:
        escaped = "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"PARTITION ({LOAD_COLUMN} = '{load}'" + (f", `{partition_by}` = {escaped})" if partition_by else ")")

    for at in range(0, len(partitions), _BATCH):
        spark.sql(f"ALTER TABLE {stage} ADD {' '.join(spec(*part) for part in partitions[at : at + _BATCH])}")


def _commit(spark: SparkSession, database: str, table: str, stage: str, number: int) -> None:
    try:
        spark.sql(f"ALTER TABLE {_quoted(database, stage)} RENAME TO {_version_table(database, table, number)}")
    except AnalysisException as error:
        if number in _numbers(spark, database, table):
            raise ConcurrentLoad(f"another load published version {number} of {database}.{table}") from error
        raise


def _point(spark: SparkSession, database: str, table: str) -> None:
    """The view at the newest version. Looks again after each change, so that of several loads none leaves it at an older one."""
    while True:
        number = _numbers(spark, database, table)[-1]
        if number == _pointed(spark, database, table):
            return
        behind = _version_table(database, table, number)
        columns = ", ".join(f"`{column}`" for column in spark.table(behind).columns if column != LOAD_COLUMN)
        spark.sql(
            f"CREATE OR REPLACE VIEW {_quoted(database, table)} TBLPROPERTIES ('version' = '{number}') AS SELECT {columns} FROM {behind}"
        )


def _pointed(spark: SparkSession, database: str, table: str) -> int | None:
    if not spark.catalog.tableExists(_quoted(database, table)):
        return None
    found = {row[0]: row[1] for row in spark.sql(f"SHOW TBLPROPERTIES {_quoted(database, table)}").collect()}
    return int(found["version"]) if found.get("version", "").isdigit() else None


def _retire(spark: SparkSession, database: str, table: str, root: str, partition_by: str | None) -> None:
    """Drops versions before the last ones, and the folders that no version lists any more."""
    numbers = _numbers(spark, database, table)
    old, kept = numbers[:-KEPT_VERSIONS], numbers[-KEPT_VERSIONS:]
    if not old:
        return
    listed: set[tuple[str, str | None]] = set()
    for number in kept:
        listed |= set(_partitions(spark, _version_table(database, table, number)))
    for number in old:
        behind = _version_table(database, table, number)
        for load, value in set(_partitions(spark, behind)) - listed:
            folder = f"{root}/{LOAD_COLUMN}={load}"
            _delete(spark, f"{folder}/{partition_by}={_NULL if value is None else quote(value, safe=' ')}" if partition_by else folder)
        spark.sql(f"DROP TABLE IF EXISTS {behind}")


def drop_versioned(spark: SparkSession, name: str) -> None:
    """Drop the view, all versions and all their rows."""
    database, table = _own_names(spark, name)
    spark.sql(f"DROP VIEW IF EXISTS {_quoted(database, table)}")
    for number in _numbers(spark, database, table):
        spark.sql(f"DROP TABLE IF EXISTS {_version_table(database, table, number)}")
    _delete(spark, _folder(spark, database, table))
