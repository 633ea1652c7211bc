"""The operators over the provided tables, one query each, with production parameters.

Most queries run all but their last step while they are built: steps are written to the shared folder and read
back. What they return is lazy from the last written step on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmart.llm import alignment, decontam, embeddings, infill, langid, lines, mixing, phrases
from visitmart.llm import quality, secrets, sharding, simhash, tokens
from visitmart.llm.common import freed_shuffles, id_crc32
from visitmart.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept_sha256(text: str = "text") -> F.Column:
    return F.sha2(F.col(text).cast("binary"), 256).alias("kept_sha256")


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.document_tokens(table(spark, sf_dir, "documents"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", kept_sha256())


def shard_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "shards")
    placed = sharding.place(table(spark, sf_dir, "documents"), "doc_id")
    with freed_shuffles(spark):
        sharding.write_shards(placed, path)
    return spark.read.schema(placed.schema).parquet(path).select("doc_id", "slot", "shard")


def embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", kept_sha256())


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_crc32() % 3 == 1, F.lit(False))
    prototypes = langid.train(docs.where(~held_out))
    found = langid.identify(docs, prototypes)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_crc32() % 5 == 0, F.lit(False))
    model = quality.train(docs.where(~held_out), table(spark, sf_dir, "labels"))
    found = quality.score(docs, model)
    predicted = F.when(F.col("score") >= quality.THRESHOLD, 1).otherwise(0)
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def of_kind(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda span: span["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        of_kind("assign"),
        of_kind("access"),
        of_kind("hex"),
        F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = alignment.align(table(spark, sf_dir, "documents"), digest_groups=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.restore(infill.fill_in_middle(table(spark, sf_dir, "documents")).drop("pieces"))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts,
    "op2_substring_dedup": substring_dedup,
    "op3_sharding": shard_placement,
    "op4_embedding_dedup": embedding_groups,
    "op5_weighted_mix": weighted_mix,
    "op6_simhash": simhash_groups,
    "op7_line_dedup": line_dedup,
    "op8_decontamination": decontamination,
    "op9_language_id": language_id,
    "op10_quality": quality_score,
    "op11_secret_scan": secret_scan,
    "op12_token_alignment": tokenizer_alignment,
    "op13_fill_in_middle": fill_in_middle,
}
