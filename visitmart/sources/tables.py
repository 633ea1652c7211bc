"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def parquet_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """Table kept as ``<folder>/<name>.parquet``; with a schema no file is opened to learn it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """Table by one-, two- or three-part name."""
    return spark.table(name)
