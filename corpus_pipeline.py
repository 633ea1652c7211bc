"""A training corpus from ``documents``: language, near copies, benchmark, mix, shards.

Each stage works on all rows that the one before kept. All but the last return the columns they
were given; the last adds ``slot`` and ``shard``. ``run`` writes each stage's rows as Parquet in
the shared folder and reads them for the next.

Nulls, empty texts, repeated rows and empty tables: a null text, one without a letter
and one unlike all languages learned are rejected by the first stage; rows repeated in full, or sharing an id, are near copies if their
texts are, and then one of them stays; an empty table stays empty through all stages. Rows with a
null id are kept last in a group of near copies, rows with a null source are the last source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.llm import decontam, langid, mixing, sharding, simhash
from visitmart.llm.common import id_crc32, staged, unused
from visitmart.llm.queries import table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a language that was learned.

    Prototypes are learned as in the query of language ID, and from the same rows the cosine that a text of
    its size must have to one of them: ``und`` goes, and so do letter noise and unknown scripts.
    """
    held_out = F.coalesce(id_crc32() % 3 == 1, F.lit(False))
    training = docs.where(~held_out)
    prototypes = langid.train(training)
    pred, score, size = unused(docs, "_pred"), unused(docs, "_score"), unused(docs, "_size")
    tagged = langid.tag(docs, prototypes, names_out=(pred, score, size))
    reached = langid.reaches(F.col(score), F.col(size), langid.least_scores(training, prototypes))
    return tagged.where((F.col(pred) != langid.UNKNOWN) & reached).select(*docs.columns)


def numbered_rows(docs: DataFrame, prefix: str) -> tuple[str, DataFrame]:
    """(name of the number, the rows with it), written: a scan planned anew may pack files otherwise and number other rows."""
    row = unused(docs, "_row")
    return row, staged(docs.withColumn(row, F.monotonically_increasing_id()), prefix)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the row with the smallest id; of rows that share it, the first."""
    row, numbered = numbered_rows(docs, "pipeline_dedup_rows")
    groups = simhash.near_duplicates(numbered, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    named = groups.join(numbered.select(row, "doc_id"), row)
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row))
    kept = named.groupBy("component_id").agg(least.alias("kept")).select(F.col("kept").getField(row).alias(row))
    return numbered.join(staged(kept, "pipeline_kept").hint("merge"), row, "left_semi").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no window of a benchmark item."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them: not at all, once, or twice."""
    row, numbered = numbered_rows(docs, "pipeline_mix_rows")
    passes = unused(docs, "_passes")
    taken = mixing.mix(numbered, row_col=row).where("passes > 0").select(F.col("row").alias(row), F.col("passes").alias(passes))
    joined = numbered.join(staged(taken, "pipeline_mix").hint("merge"), row)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col(passes)))
    return joined.select(*[joined[f"`{c}`"] for c in docs.columns], each.alias(unused(docs, "_pass"))).select(*docs.columns)


def placed_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard; rows of one id share it."""
    return sharding.place(docs, "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("simhash_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("weighted_mix", mixed_sources),
    ("sharding", placed_in_shards),
]

#: Language ID and SimHash can't be expressed in SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
