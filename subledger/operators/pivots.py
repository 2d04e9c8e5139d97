"""Cross tables of counts and sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


OTHER = "other"


def count_pivot(
    df: DataFrame,
    index: str,
    category: str,
    values: Sequence | None = None,
    labels: Sequence[str] | None = None,
    total: str | None = None,
    other: str = OTHER,
) -> DataFrame:
    """Rows counted per index value and category, one column per category.

    Rows without an index value or category are left out. A pair that does
    not occur is null. Without ``values`` every category that occurs has a
    column; Spark looks them up first. With ``values`` those have one each,
    named by ``labels`` if given, and ``other`` counts the rows of all other
    categories. ``total`` adds the row total under that name; it is counted
    from the rows and not from the cells. Spark refuses more categories than
    ``spark.sql.pivotMaxValues``: :func:`count_long` takes any number.
    """
    known = df.where(F.col(index).isNotNull() & F.col(category).isNotNull())
    counts = [F.count(F.lit(1)).alias(total)] if total is not None else []
    if values is None:
        if labels is not None:
            raise ValueError("labels go with values")
        table = known.groupBy(index).pivot(category).agg(F.count(F.lit(1)))
        cells = [c for c in table.columns if c != index]
        # Every category has a column here, so the cells are the rows.
        row = sum((F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in cells), F.lit(0).cast("bigint"))
        return table.withColumn(total, row) if total is not None else table
    names = list(labels) if labels is not None else [str(v) for v in values]
    named = F.col(category).isin(list(values))
    tests = [*((n, F.col(category) == v) for n, v in zip(names, values, strict=True)), (other, ~named)]
    cells = [F.nullif(F.count_if(test), F.lit(0)).alias(name) for name, test in tests]
    return known.groupBy(index).agg(*cells, *counts)


def count_long(df: DataFrame, index: str, category: str, count: str = "row_count", totals: bool = False) -> DataFrame:
    """Rows counted per index value and category, a row for each pair that occurs.

    The cross table for categories without a bound. Rows without an index
    value or category are left out, and an empty table gives no rows. With
    ``totals`` come the row totals, the column totals and the total of all:
    ``all_<index>`` and ``all_<category>`` say over which of the two a row
    sums, and that column is null there. Rows are counted by pair before they
    are written out for the totals, so those cost as much as there are pairs.
    """
    pairs = _known(df, [index, category]).groupBy(index, category).agg(F.count(F.lit(1)).alias(count))
    if not totals:
        return pairs
    marks = [(F.grouping(c) == 1).alias(f"all_{c}") for c in (index, category)]
    return pairs.cube(index, category).agg(*marks, F.sum(count).alias(count))


def with_total_row(table: DataFrame, index: str, label: str = "Total") -> DataFrame:
    """Cross table with a last row that holds the column totals."""
    cells = [c for c in table.columns if c != index]
    totals = table.agg(*[F.sum(c).alias(c) for c in cells]).select(F.lit(label).alias(index), *cells)
    return table.withColumn(index, F.col(index).cast("string")).unionByName(totals)


def grouped_counts(df: DataFrame, index: Sequence[str], counted: str, name: str) -> DataFrame:
    """Non-null values of a column counted per index; null index left out."""
    return _known(df, index).groupBy(*index).agg(F.count(counted).alias(name))


def grouped_sums(df: DataFrame, index: Sequence[str], measure: str, name: str) -> DataFrame:
    return _known(df, index).groupBy(*index).agg(F.coalesce(F.sum(measure), F.lit(0)).alias(name))


def _known(df: DataFrame, index: Sequence[str]) -> DataFrame:
    for c in index:
        df = df.where(F.col(c).isNotNull())
    return df
