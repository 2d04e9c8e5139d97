"""URL filters: host rules, and a block list behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.columns import LOWER, UPPER, col, fresh, without

# (verdict, host, path)
Rule = tuple[str, str, str]

WORDS = 8  # of 64 bits: a block is one cache line of 512 bits
BITS_PER_URL = 16
# Blocks of 72 bytes that may be sent to every executor: at most 36 MB, the
# filter of 16 million listed URLs. A larger filter is joined by shuffle.
BROADCAST_BLOCKS = 1 << 19


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.``, default port and final dot, and path without
    final slashes; null if there is no host. Scheme, query and fragment don't count."""
    bare = F.regexp_replace(F.regexp_replace(host, r"\.?(:80|:443)?$", ""), r"^www\.", "")
    return F.when(bare != "", F.concat(bare, F.regexp_replace(path, r"/+$", "")))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    _, h, p = rule
    return ((host == h) | host.endswith(f".{h}")) & path.startswith(p)


def _longest_first(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: -len(r[1] + r[2]))


def rule_for(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Host and path of the longest rule that fits, null if none does."""
    found = F.lit(None).cast("string")
    for rule in reversed(_longest_first(rules)):
        found = F.when(_fits(rule, host, path), F.lit(rule[1] + rule[2])).otherwise(found)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("long")


def _bits(key: Column) -> list[Column]:
    """One bit in each word, from six bits each of a second hash."""
    h = F.xxhash64(F.lit("bits"), key)
    return [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
        for i in range(WORDS)
    ]


def bloom_filter(listed: DataFrame, key: str, bits_per_url: int = BITS_PER_URL) -> tuple[DataFrame, int]:
    """Blocks of the filter of the distinct keys, and how many blocks there
    may be. Blocks without a key have no row."""
    keys = listed.select(col(key).alias("_key")).where("_key IS NOT NULL").distinct()
    blocks = max(1, -(-keys.count() * bits_per_url // (64 * WORDS)))
    marks = keys.select(_block(F.col("_key"), blocks).alias("_block"), F.array(*_bits(F.col("_key"))).alias("_m"))
    words = [F.bit_or(F.col("_m")[i]).alias(f"_w{i}") for i in range(WORDS)]
    return marks.groupBy("_block").agg(*words), blocks


def on_list(
    df: DataFrame,
    key: str,
    listed: DataFrame,
    listed_key: str,
    flag: str = "listed",
    bits_per_url: int = BITS_PER_URL,
) -> DataFrame:
    """All rows of ``df`` with ``flag``: whether the key is one of the listed.

    The filter lets possible hits pass to an exact join by key that removes
    false positives; all others skip that join. A null key is never listed,
    repeated list rows count once, an empty list lists nothing, and an input
    column named as the flag gives way. In the exact join the list's side is
    distinct, so a hot key is skewed on one side only and adaptive execution
    splits it.
    """
    df = without(df, flag)
    block, maybe, here = fresh(df, "_block", "_maybe", "_key")
    filter_, blocks = bloom_filter(listed, listed_key, bits_per_url)
    filter_ = filter_.select(F.col("_block").alias(block), F.struct(*(f"_w{i}" for i in range(WORDS))).alias(maybe))
    if blocks <= BROADCAST_BLOCKS:
        filter_ = F.broadcast(filter_)
    hit = F.lit(True)
    for i, bit in enumerate(_bits(col(key))):
        hit = hit & (col(maybe)[f"_w{i}"].bitwiseAND(bit) != 0)
    probed = df.withColumn(block, F.when(col(key).isNotNull(), _block(col(key), blocks)))
    probed = probed.join(filter_, block, "left").withColumn(maybe, F.coalesce(hit, F.lit(False))).drop(block)
    keys = listed.select(col(listed_key).alias(here)).where(col(here).isNotNull()).distinct()
    possible = probed.where(col(maybe)).join(keys.withColumn(flag, F.lit(True)), col(key) == col(here), "left")
    possible = possible.withColumn(flag, F.coalesce(col(flag), F.lit(False))).drop(here)
    return possible.unionByName(probed.where(~col(maybe)).withColumn(flag, F.lit(False))).drop(maybe)


def url_filter(
    df: DataFrame, rules: Sequence[Rule], listed: DataFrame, url: str = "url", listed_url: str = "url"
) -> DataFrame:
    """All rows of ``df`` with ``host``, ``path``, ``rule``, ``canonical_url``,
    ``listed`` and ``verdict`` (allow or block).

    The longest rule that fits decides; without one, listed URLs are blocked.
    URLs that are null or lack ``://`` have an empty host and path, fit no rule
    and are allowed. Input columns named as outputs give way. Each row gets its
    own verdict, so ties and repeated rows stay.
    """
    outputs = ("host", "path", "rule", "canonical_url", "listed", "verdict")
    if url.lower() in outputs:
        raise ValueError("the URL's column has the name of an output")
    parts = without(df, *outputs).withColumns({"host": host_of(col(url)), "path": path_of(col(url))})
    known = parts.withColumns({
        "rule": rule_for(rules, F.col("host"), F.col("path")),
        "canonical_url": canonical(F.col("host"), F.col("path")),
    })
    targets = listed.select(canonical(host_of(col(listed_url)), path_of(col(listed_url))).alias("_url"))
    judged = on_list(known, "canonical_url", targets, "_url")
    verdict = F.when(F.col("listed"), "block").otherwise("allow")
    for kind, h, p in rules:
        verdict = F.when(F.col("rule") == h + p, F.lit(kind)).otherwise(verdict)
    return judged.withColumn("verdict", verdict)
