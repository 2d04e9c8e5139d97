"""De-duplication, key checks and row numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subledger.session import shared_dir


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "last") -> DataFrame:
    """One row per key: the first or last in the given order.

    Columns outside the order break ties, so the result is the same on every
    run. Spark limits each key to its first row before the shuffle and again
    after it, so a key holding most of the rows sends one row per input task.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    if len(keys) == len(df.columns):
        return df.distinct()
    ranked = [*order, *(c for c in df.columns if c not in keys and c not in order)]
    direction = F.desc if keep == "last" else F.asc
    in_order = Window.partitionBy(*keys).orderBy(*[direction(c) for c in ranked])
    return df.withColumn("_rank", F.row_number().over(in_order)).where("_rank = 1").drop("_rank")


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first: Sequence[str],
    sums: Sequence[str] = (),
    never_null: Sequence[str] = (),
) -> DataFrame:
    """Per key the first known value of each column, and sums (0 if all null).

    Columns in ``never_null`` come from the first row as a whole, so the order
    columns are carried once for all of them, and once for each other column.
    A null in such a column is an error. Rows with a null key are dropped.
    """
    seen = df.where(_all_known(keys))
    places = [F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]
    whole = [c for c in first if c in set(never_null)]
    picks = [
        F.min(F.when(F.col(c).isNotNull(), F.struct(*places, F.col(c).alias("_v"))))["_v"].alias(c)
        for c in first
        if c not in whole
    ]
    if whole:
        picks.append(F.min(F.struct(*places, *whole)).alias("_first"))
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]
    grouped = seen.groupBy(*keys).agg(*picks, *totals)
    taken = {c: F.coalesce(F.col(f"_first.{c}"), F.raise_error(F.lit(f"{c} is null")).cast(df.schema[c].dataType)) for c in whole}
    return grouped.select(*keys, *(taken[c].alias(c) if c in taken else F.col(c) for c in [*first, *sums]))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that are null or occur more than once, with their row counts."""
    rows = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return rows.where((F.col("rows") > 1) | ~_all_known(keys))


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` itself; raises when the keys are not a primary key."""
    if not key_violations(df, keys).isEmpty():
        raise ValueError(f"{', '.join(keys)} is not a unique, non-null key")
    return df


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """Rows numbered from 0 in a total order, without a single-task sort.

    The rows are range-sorted and written to the checkpoint folder with their
    partition and place; the sizes of the preceding partitions give each
    partition its offset. ``order`` must be total.
    """
    shared_dir(df.sparkSession)
    placed = (
        df.orderBy(*order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))
        .checkpoint()
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"), F.min("_place").alias("_first"))
    # One row per partition of the sort.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    numbered = placed.join(offsets, "_part")
    return numbered.select((F.col("_place") + F.col("_shift")).alias(name), *df.columns)


def _all_known(keys: Sequence[str]):
    test = F.lit(True)
    for key in keys:
        test = test & F.col(key).isNotNull()
    return test
