"""Session settings and the shared folder that written tables may use."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH_DATABASE = "visitmart_scratch"


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; sizes come from ``spark-submit`` or ``conf``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Sessions that run many plans in turn keep the code generated for them.
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        # JSON objects that repeat a key keep its last value; without this they count as malformed.
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors see: the one named in ``spark.checkpoint.dir``.

    A checkpoint folder set on the context serves as well. Only a local session may do
    without either; it gets a fresh folder under /tmp.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="visitmart-", dir="/tmp"))
    return spark.sparkContext.getCheckpointDir()


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame's rows written once to the shared folder, with their lineage cut."""
    context = frame.sparkSession.sparkContext
    folder = shared_folder(frame.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return frame.checkpoint()


def scratch_folder(spark: SparkSession) -> str:
    """Folder of all that this application writes for itself, in the shared folder."""
    return f"{shared_folder(spark)}/{_scratch_name(spark)}"


def _scratch_name(spark: SparkSession) -> str:
    return f"{SCRATCH_DATABASE}_{re.sub('[^a-z0-9]', '_', spark.sparkContext.applicationId.lower())}"


def scratch_path(spark: SparkSession, prefix: str) -> str:
    """A new path in the application's scratch folder."""
    return f"{scratch_folder(spark)}/{prefix}_{uuid.uuid4().hex}"


def scratch_database(spark: SparkSession) -> str:
    """Database of this application's scratch tables, in its scratch folder.

    Named by the application, so that a lasting metastore never hands out an earlier one's folder.
    """
    name = _scratch_name(spark)
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_path(spark, 'tables')}'")
    return name


def scratch_table(spark: SparkSession, prefix: str) -> str:
    """A new table name in the application's scratch database."""
    return f"{scratch_database(spark)}.{prefix}_{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove all that this application wrote for itself, tables and files; frames that read it end here."""
    spark.sql(f"DROP DATABASE IF EXISTS {_scratch_name(spark)} CASCADE")
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
