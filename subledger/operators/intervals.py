"""Lookup of the interval that holds a value, by equality joins alone.

An interval is the union of few cells of a grid whose cells double in size a
number of times from level to level, so a value lies in it exactly if one of
the value's own cells, one a level, is among the interval's. Any ordered type
that has whole-number positions will do: numbers, dates, timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Each level's cells are 2 to this power of those of the level below.
BITS = 6
LEVELS = -(-64 // BITS)


def position(df: DataFrame, name: str) -> Column:
    """A column's values as whole numbers in the same order."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return value.cast("long")
    raise TypeError(f"{name} is of type {kind.simpleString()}, whose values have no whole-number positions")


def _cover(intervals: DataFrame) -> DataFrame:
    """Cells of each interval ``[_lo, _hi)``: at most twice 2^BITS a level, the largest that fit."""
    levels = intervals.select("*", F.explode(F.array(*(F.lit(i) for i in range(LEVELS)))).alias("_level"))

    def cells(level: Column) -> tuple[Column, Column]:
        """First cell that lies within the interval at a level, and the first after."""
        shift = level * BITS
        first = F.call_function("shiftright", F.col("_lo") - 1, shift) + 1
        after = F.call_function("shiftright", F.col("_hi"), shift)
        return first, after

    here, above = cells(F.col("_level")), cells(F.col("_level") + 1)
    top = F.col("_level") == LEVELS - 1
    wider = ~top & (above[0] < above[1])
    # What the cells of the level above leave over, on either side.
    left = F.when(wider, F.call_function("shiftleft", above[0], F.lit(BITS))).otherwise(here[1])
    right = F.when(wider, F.call_function("shiftleft", above[1], F.lit(BITS))).otherwise(here[1])
    bounds = levels.select("*", here[0].alias("_a"), left.alias("_b"), right.alias("_c"), here[1].alias("_d"))
    none = F.array().cast("array<bigint>")
    listed = F.concat(
        F.when(F.col("_a") < F.col("_b"), F.sequence("_a", F.col("_b") - 1)).otherwise(none),
        F.when(F.col("_c") < F.col("_d"), F.sequence("_c", F.col("_d") - 1)).otherwise(none),
    )
    return bounds.select(*levels.columns, F.explode(listed).alias("_cell"))


def interval_lookup(
    rows: DataFrame, at: str, intervals: DataFrame, start: str, end: str, how: str = "inner", check: bool = True
) -> DataFrame:
    """Rows with the columns of the interval ``[start, end)`` that holds ``at``.

    Each interval is written out as its cells, of which there are a few
    hundred at most whatever its length, and each row once per level that
    these cells use; the rest is one equality join, whose side of intervals
    Spark broadcasts if it is small. Intervals that are null on a side or empty
    hold nothing. Overlapping ones are an error, unless ``check`` is off: then
    a row appears once for each. ``how='left'`` keeps rows in no interval.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    bounded = intervals.withColumns({"_lo": position(intervals, start), "_hi": position(intervals, end)}).where("_lo < _hi")
    if check:
        starts = bounded.select(F.col("_lo").alias("_at"), F.col("_hi").alias("_until"))
        hits = _met(starts, _cover(bounded)).groupBy("_at", "_until").agg(F.count("*").alias("_n"))
        doubled = starts.groupBy("_at", "_until").agg(F.count("*").alias("_same"))
        # A start lies in its own interval and in no other.
        if not hits.join(doubled, ["_at", "_until"]).where("_n > 1 OR _same > 1").isEmpty():
            raise ValueError(f"intervals {start} to {end} overlap")
    placed = rows.withColumn("_at", position(rows, at))
    found = _met(placed, _cover(bounded)).drop("_lo", "_hi")
    if how == "inner":
        return found.drop("_at")
    # A row in no interval has no cell in common with any: it is told by its position.
    outside = placed.join(found.select("_at").distinct(), "_at", "left_anti")
    return found.unionByName(outside, allowMissingColumns=True).drop("_at")


def _met(rows: DataFrame, cover: DataFrame) -> DataFrame:
    """Rows with the intervals that share a cell with their ``_at``."""
    used = sorted(r[0] for r in cover.select("_level").distinct().collect())  # LEVELS at most
    if not used:
        return rows.join(cover.drop("_level", "_cell"), F.lit(False))
    levels = F.explode(F.array(*(F.lit(i) for i in used))).alias("_level")
    spread = rows.select("*", levels).withColumn("_cell", F.call_function("shiftright", F.col("_at"), F.col("_level") * BITS))
    return spread.join(cover, ["_level", "_cell"]).drop("_level", "_cell")
