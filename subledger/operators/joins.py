"""Join shapes. Spark picks the strategy from the sizes it knows or measures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions.dates import Spine


def join_indicator(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str = "matched") -> DataFrame:
    """Left join with a flag that tells whether a partner was found.

    Keys compare null-safe: a null key finds a null key.
    """
    r = right.withColumn(name, F.lit(True)).withColumnsRenamed({k: f"_r_{k}" for k in keys})
    test = F.lit(True)
    for k in keys:
        test = test & left[k].eqNullSafe(r[f"_r_{k}"])
    joined = left.join(r, test, "left").drop(*[f"_r_{k}" for k in keys])
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def without_matches(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` that the indicator would call left only."""
    r = right.select([F.col(k).alias(f"_r_{k}") for k in keys])
    test = F.lit(True)
    for k in keys:
        test = test & left[k].eqNullSafe(r[f"_r_{k}"])
    return left.join(r, test, "left_anti")


def not_in(left: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """``column NOT IN (values)`` with the null rules of SQL.

    A null among the values removes every row and a null column never
    passes, unless there are no values at all. Null and non-null values are
    looked at apart, so the join itself stays an equi-join that distributes.
    """
    v = values.select(F.col(values.columns[0]).alias("_v"))
    known = v.where(F.col("_v").isNotNull()).distinct()
    kept = left.join(known, left[column] == F.col("_v"), "left_anti")
    # Of the values there is one row, with both counts.
    counts = v.agg(F.struct(F.count("*").alias("all"), F.count("_v").alias("known"))).scalar()
    return kept.where((counts["all"] == 0) | ((counts["all"] == counts["known"]) & F.col(column).isNotNull()))


def all_matched(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Distinct keys all of whose rows carry the flag."""
    return df.groupBy(*keys).agg(F.bool_and(flag).alias("_all")).where("_all").drop("_all")


def period_days(periods: DataFrame, name: str, start: str, end: str, spine: Spine, day: str = "report_date") -> DataFrame:
    """Days of the spine with the period that contains them."""
    return spine.expand(periods.select(name, start, end), F.col(start), F.date_add(F.col(end), 1), day)


def unique_period_days(days: DataFrame, name: str, day: str = "report_date") -> DataFrame:
    """Days with their period; a day in two periods raises when it is read."""
    clash = F.raise_error(F.concat(F.lit("date lies in more than one period: "), F.col(day).cast("string")))
    return (
        days.groupBy(day)
        .agg(F.count("*").alias("_n"), F.first(name).alias(name))
        .select(day, F.when(F.col("_n") > 1, clash.cast("string")).otherwise(F.col(name)).alias(name))
    )


@dataclass(frozen=True)
class Dimension:
    """One arm of a star: a table, its role and how the fact points at it.

    ``on`` maps columns of what is joined so far to columns of the table;
    ``columns`` maps columns of the table to their names in the result.
    """

    table: DataFrame
    on: dict[str, str]
    columns: dict[str, str]
    how: str = "left"
    distinct: bool = field(default=False)


def star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Fact with the columns of its dimensions, joined in the order given.

    A table may take part under several roles, and a dimension may hang off
    columns that an earlier one brought in. Rows that point at nothing would
    all meet on the null key of a left join, so there a second key deals them
    by their contents; it is 0 for all others and for the table.
    """
    joined = fact
    for i, dim in enumerate(dimensions):
        keys = {column: f"_k{i}_{n}" for n, column in enumerate(dim.on.values())}
        table = dim.table.select(
            *[F.col(c).alias(alias) for c, alias in keys.items()],
            *[F.col(c).alias(alias) for c, alias in dim.columns.items()],
        )
        if dim.distinct:
            table = table.distinct()
        test: Column = F.lit(True)
        if dim.how == "left":
            lost = F.lit(False)
            for near in dim.on:
                lost = lost | joined[near].isNull()
            spread = F.when(lost, F.xxhash64(*[joined[c] for c in joined.columns])).otherwise(0)
            joined = joined.withColumn(f"_n{i}", spread)
            # Not a literal, which Spark would take out of the join's keys.
            table = table.withColumn(f"_z{i}", F.pmod(F.xxhash64(*keys.values()), F.lit(1)).cast("long"))
            test = joined[f"_n{i}"] == table[f"_z{i}"]
        for near, far in dim.on.items():
            test = test & (joined[near] == table[keys[far]])
        joined = joined.join(table, test, dim.how).drop(*keys.values(), f"_n{i}", f"_z{i}")
    return joined
