"""Sharding by weighted rendezvous hashing of a stable key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.columns import col, fresh
from subledger.session import shared_dir

# Rows that one task numbers; decides the number of buckets, not the order.
BUCKET_ROWS = 4_000
# Slots that one array holds.
RUN_ROWS = 10_000


def _unit(key: Column, shard: int) -> Column:
    """A number in (0, 1) from 52 bits of a digest of key and shard."""
    digest = F.md5(F.concat(key, F.lit(f":{shard}")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _units(key: Column, shards: int) -> Column:
    """The numbers of a key for every shard; a null key is a key too."""
    text = F.coalesce(key.cast("string"), F.lit("\x00null"))
    return F.array(*(_unit(text, s) for s in range(shards)))


def rendezvous(units: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to ``len(weights)`` - 1, that a key of these numbers falls into.

    Each shard scores ``-ln(u) / weight`` and the lowest score wins, ties by
    the lower number, so shards take keys in proportion to their weights, and
    a further shard takes keys only into itself.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one for each shard")
    scores = [
        F.struct((-F.log(F.get(units, F.lit(s))) / F.lit(float(w))).alias("score"), F.lit(s).alias("shard"))
        for s, w in enumerate(weights)
    ]
    return F.array_min(F.array(*scores))["shard"]


def text_size(text: Column) -> Column:
    """UTF-8 bytes and 8; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def number_rows(df: DataFrame, shard: str, slot: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows of ``df`` with a gapless ``slot`` from 0 within each shard.

    The order is that of a digest of all columns, so it depends on the rows'
    contents alone and a lost executor's work comes out the same. Equal rows
    are counted before they meet and take a run of slots. A shard is split
    into digest ranges of about ``bucket_rows`` rows, which are numbered apart
    and shifted by the sizes of the ranges before. An empty table stays empty.
    """
    rest = [c for c in df.columns if c != slot]
    digest = F.md5(F.to_json(F.struct(*(col(c) for c in rest)), {"ignoreNullFields": "false"}))
    rows = df.groupBy(*(col(c) for c in rest)).agg(F.count(F.lit(1)).alias("_n"))
    # Read three times below; written once, so that the input is not scored and digested each time.
    shared_dir(df.sparkSession)
    rows = rows.withColumn("_digest", digest).checkpoint()
    shards, total, most = rows.agg(F.count_distinct(col(shard)), F.sum("_n"), F.max("_n")).first()
    total, most = total or 0, most or 0
    bits = max(0, (total // max(1, shards) // bucket_rows).bit_length())
    bucket = F.conv(F.substring("_digest", 1, 13), 16, 10).cast("long")
    rows = rows.withColumn("_bucket", F.shiftright(bucket, 52 - bits) if bits else F.lit(0).cast("long"))
    sizes = rows.groupBy(col(shard).alias("_shard"), F.col("_bucket").alias("_at")).agg(F.sum("_n").alias("_size"))
    # A row for each range: a few thousandths of the rows.
    before = Window.partitionBy("_shard").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_shard", "_at", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(col(shard), "_bucket").orderBy("_digest", *(col(c) for c in rest))
    upto = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = rows.withColumn("_end", upto).join(
        starts, col(shard).eqNullSafe(F.col("_shard")) & (F.col("_bucket") == F.col("_at"))
    )
    first = F.col("_start") + F.col("_end") - F.col("_n")
    # Runs of bounded length, dealt out where there are several: a row may be repeated any number of times.
    stop = first + F.col("_n") - 1
    runs = numbered.select(*(col(c) for c in rest), stop.alias("_stop"), F.explode(F.sequence(first, stop, F.lit(RUN_ROWS))).alias("_first"))
    if most > RUN_ROWS:
        runs = runs.repartition("_first", *(col(c) for c in rest))
    last = F.least(F.col("_first") + RUN_ROWS - 1, F.col("_stop"))
    return runs.select(*(col(c) for c in rest), F.explode(F.sequence("_first", last)).alias(slot))


def shard_rows(
    df: DataFrame, key: str, weights: Sequence[float], grown: Sequence[float] | None = None, shard: str = "shard"
) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` and, if weights of a later
    layout are given, ``grown_shard``. One narrow projection: nothing moves.

    Only the key and the weights decide, and an empty table stays empty: rows with equal keys share a shard,
    and rows with a null key form one key. Texts don't matter. An input column
    with the name of an output gives way to it.
    """
    (units,) = fresh(df, "_units")
    # Both layouts use the numbers of the shards that they share.
    out = df.withColumn(units, _units(col(key), max(len(weights), len(grown or ()))))
    placed = {shard: rendezvous(col(units), weights).cast("int")}
    if grown is not None:
        placed["grown_shard"] = rendezvous(col(units), grown).cast("int")
    return out.withColumns(placed).drop(units)
