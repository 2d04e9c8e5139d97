"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subledger.llm import (
    bpe,
    decontaminate,
    hard_negatives,
    hnsw,
    licenses,
    near_dup,
    oracle,
    prefix_trie,
    quality,
    secrets,
    sharding,
    token_counts,
    urls,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BASE_KINDS = ("assign", "access", "hex")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *(secrets.count_of(F.col("secrets"), k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(secrets.listed_spans(F.col("secrets"), BASE_KINDS), 256).alias("base_sha256"),
        secrets.listed_spans(F.col("secrets")).alias("spans"),
    )


#: Pages of one archive file, and what befalls the second replica of it: bytes
#: of one page length are damaged, pages of another are lost.
FILE_PAGES = 1_000
DAMAGED, LOST = (97, 5), (301, 7)


def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits a damaged replica of the archive that the pages make up."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    content = F.concat_ws("\n", "url", "html")
    size = F.coalesce(F.octet_length("html"), F.lit(0))
    damaged = F.when(size % DAMAGED[0] == DAMAGED[1], F.concat(F.lit("\x00"), F.substr(content, F.lit(2)))).otherwise(content)
    file = F.format_string("crawl-%06d", F.coalesce(F.floor(F.col("page_id") / FILE_PAGES), F.lit(-1)))
    placed = pages.withColumns({"file": file, "lost": size % LOST[0] == LOST[1], "record": F.col("page_id")})

    def manifest(content: Column) -> DataFrame:
        # A file's records follow each other; one task places a file's entries, not its contents.
        rows = warc.hashed_records(placed, content, ["file", "record", "lost"])
        before = Window.partitionBy("file").orderBy("record", "digest").rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))

    ours, theirs = manifest(content), manifest(damaged).where("not lost")
    return warc.audit(ours.drop("lost"), theirs.drop("lost"))


def tokenizer(name: str) -> str:
    """Where the file of a public tokenizer is."""
    import public_tokenizers

    return public_tokenizers.path(name)


TOKEN_LIMIT = 512


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", size)
    counted = token_counts.prefix_counts(documents, tokenizer("byte_bpe_50k.json"), keep=["doc_id", "n_bytes"])
    counts = F.col("prefix_tokens")
    return counted.select(
        "doc_id",
        "n_bytes",
        token_counts.tokens_of(counts).alias("n_tokens"),
        (token_counts.tokens_of(counts) > TOKEN_LIMIT).alias("over_limit"),
        token_counts.longest_within(counts, TOKEN_LIMIT).alias("chars_within_limit"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules"
    )


#: The rules that the query's contract names.
URL_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Sites whose pages make up the list of blocked URLs: the tables hold no such
#: list, and these are all the junk sites among their pages.
LISTED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    sites = "|".join(LISTED_SITES)
    listed = pages.select("url").where(urls.host_of(F.col("url")).rlike(rf"(^|\.)({sites})\."))
    judged = urls.url_filter(pages, URL_RULES, listed)
    return judged.select("page_id", "host", "path", "rule", "verdict", "listed", "canonical_url")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = tokenizer("byte_bpe_multi_50k.tiktoken")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.round_trip(documents, path, public_tokenizers.PATTERN, keep=["doc_id"])
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.license_scan(documents, licenses.known_licenses(spark))
    return found.select("doc_id", "text_digest", "license", F.array_join("notices", ",").alias("notices"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


SHARDS = 24


def op9_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        sharding.text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    sharded = sharding.shard_rows(documents, "doc_id", [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return sharding.number_rows(sharded, "shard", "slot")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(documents, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


#: One component of 256 is a step of the mined integer vectors.
SCALE = 256
ANCHORS, POSITIVES, NEGATIVES, HARDNESS = 100, 5, 10, (30, 90)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").where(hard_negatives.usable(F.col("embedding")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    given = rows.select("vec_id", moved.alias("label"), steps.alias("vector"))
    return hard_negatives.hard_negatives(given, ANCHORS, POSITIVES, NEGATIVES, *HARDNESS)


NEIGHBOUR_QUERIES, NEIGHBOURS = 50, 5


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest_rows(table(spark, sf_dir, "embeddings"), NEIGHBOUR_QUERIES, NEIGHBOURS)


#: Conversations of one family share their first turns, fewer than so many.
FAMILY, SHARED_TURNS = 100, 6


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns, FAMILY, SHARED_TURNS)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_warc_fixity,
        op3_token_counts,
        op4_quality_rules,
        op5_url_filter,
        op6_byte_bpe,
        op7_license_scan,
        op8_near_duplicates,
        op9_rendezvous_shards,
        op10_decontaminate,
        op11_hard_negatives,
        op12_nearest_neighbours,
        op13_prefix_trie,
    )
}

#: The others have no SQL: tests hold them against the libraries or brute force.
ORACLE: dict[str, str] = {
    "op1_secret_scan": oracle.SECRETS,
    "op2_warc_fixity": oracle.fixity(FILE_PAGES, DAMAGED, LOST),
    "op4_quality_rules": oracle.QUALITY,
    "op5_url_filter": oracle.url_filter(URL_RULES, LISTED_SITES),
    "op7_license_scan": oracle.license_scan(),
    "op10_decontaminate": oracle.DECONTAMINATE,
    "op11_hard_negatives": oracle.hard_negatives(SCALE, ANCHORS, POSITIVES, NEGATIVES, HARDNESS),
    "op13_prefix_trie": oracle.prefix_trie(FAMILY, SHARED_TURNS),
}
