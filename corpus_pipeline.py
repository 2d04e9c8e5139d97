"""The corpus pipeline: five stages over documents, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm import bpe, decontaminate, near_dup, quality, secrets
from subledger.llm.columns import col, fresh, text_of
from subledger.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Rows of about 60 bytes that may be sent to every executor: 12 MB.
BROADCAST_ROWS = 200_000


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; null and empty texts go."""
    return quality.quality_rules(docs).where("kept").select(*(col(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates.

    A document is its id and its text: rows that agree in both count as one,
    and rows that share an id but not the text are told apart. Texts without a
    word are in no class and stay.
    """
    row, gone = fresh(docs, "_row", "_gone")
    identity = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text_of("text")))
    keyed = docs.withColumn(row, identity)
    classes = near_dup.near_duplicates(keyed.select(row, "text"), key=row).checkpoint()
    dropped = classes.where(col(row) != F.col("class_id")).select(col(row).alias(gone)).distinct()
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    kept = keyed.join(dropped, col(row) == col(gone), "left_anti")
    if not classes.groupBy(row).count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates([row])
    return kept.drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_contamination(docs, benchmark)
    return found.where("not contaminated").select(*(col(c) for c in docs.columns))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in their texts; ``n_chars`` follows the text."""
    found = secrets.find_secrets(docs)
    hidden = found.withColumn("text", secrets.masked(F.col("text"), F.col("secrets")))
    if "n_chars" in docs.columns:
        changed = F.when(F.size("secrets") > 0, F.length("text")).otherwise(F.col("n_chars"))
        hidden = hidden.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return hidden.select(*(col(c) for c in docs.columns))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    kept = ["doc_id", "lang", "source"]
    (digest,) = fresh(docs, "_digest")
    signed = docs.select(*(col(c) for c in kept), "text", F.sha2(text_of("text"), 256).alias(digest))
    decoded = bpe.round_trip(signed, path, public_tokenizers.PATTERN, keep=[*kept, digest])
    return decoded.select(
        *(col(c) for c in kept),
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.sha2("decoded", 256) == col(digest)).alias("decodes"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_bpe", byte_bpe),
]

#: Near-duplicates can't be told in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
