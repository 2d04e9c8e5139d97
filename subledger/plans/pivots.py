"""Cross tables mailed with the adds and disconnect extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger.columns import DEFAULT_COLUMNS, SubscriptionColumns
from subledger.operators.cleaning import fill_column
from subledger.operators.pivots import count_long, count_pivot, grouped_counts, grouped_sums

# Fixed values of the term type field.
TERM_TYPES = ("EVERGREEN", "TERMED")

GRAND_TOTAL = "grand_total"


def pivot_term_type(df: DataFrame, cols: SubscriptionColumns = DEFAULT_COLUMNS, day: str = "report_date") -> DataFrame:
    """Counts per term type; types beyond the known ones are counted as ``other``."""
    return count_pivot(df, day, cols.term_type, TERM_TYPES, total=GRAND_TOTAL)


def pivot_renewal_term(
    df: DataFrame,
    terms: Sequence[int] | None = None,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    day: str = "report_date",
) -> DataFrame:
    """Counts per renewal term; a missing term counts as 1. Terms that aren't
    named are counted as ``other``; without names each term has a column."""
    labels = [f"term_{t}" for t in terms] if terms is not None else None
    return count_pivot(fill_column(df, cols.renewal_term, 1), day, cols.renewal_term, terms, labels, GRAND_TOTAL)


def pivot_status(
    df: DataFrame,
    statuses: Sequence[str] | None = None,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    day: str = "report_date",
) -> DataFrame:
    """Counts per status: a column for each one that occurs, or for the named
    ones and one for all others."""
    return count_pivot(df, day, cols.status, statuses, total=GRAND_TOTAL)


def plan_counts(df: DataFrame, cols: SubscriptionColumns = DEFAULT_COLUMNS, day: str = "report_date") -> DataFrame:
    """Rows per rate plan name and day in long form, with all totals; there may be any number of plans."""
    return count_long(df, day, cols.rate_plan, totals=True)


def product_counts(
    df: DataFrame, cols: SubscriptionColumns = DEFAULT_COLUMNS, day: str = "report_date", sub_id: str = "sub_id"
) -> DataFrame:
    return grouped_counts(df, [day, cols.product], sub_id, "subscription_count")


def family_counts(df: DataFrame, cols: SubscriptionColumns = DEFAULT_COLUMNS, day: str = "report_date") -> DataFrame:
    return grouped_counts(df, [day, cols.product, cols.family], cols.product, "product_count")


def product_revenue(
    df: DataFrame,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    day: str = "report_date",
    revenue: str = "total_adds_revenue",
) -> DataFrame:
    return grouped_sums(df, [day, cols.product], revenue, revenue)


def daily_revenue(
    df: DataFrame, day: str = "report_date", sub_id: str = "sub_id", revenue: str = "total_adds_revenue"
) -> DataFrame:
    """Subscriptions and revenue per day."""
    return (
        df.where(F.col(day).isNotNull())
        .groupBy(day)
        .agg(F.count(sub_id).alias("subscription_count"), F.coalesce(F.sum(revenue), F.lit(0)).alias(revenue))
    )


def adds_pivots(
    adds: DataFrame, terms: Sequence[int] | None = None, statuses: Sequence[str] | None = None, cols=DEFAULT_COLUMNS
) -> dict[str, DataFrame]:
    """The sheets that go with the adds extract, by name."""
    return {
        "raw_data": adds,
        "product_counts": product_counts(adds, cols),
        "family_counts": family_counts(adds, cols),
        "term_types": pivot_term_type(adds, cols),
        "renewal_terms": pivot_renewal_term(adds, terms, cols),
        "product_revenue": product_revenue(adds, cols),
        "daily_revenue": daily_revenue(adds),
        "statuses": pivot_status(adds, statuses, cols),
    }


def disconnect_pivots(
    rows: DataFrame, terms: Sequence[int] | None = None, statuses: Sequence[str] | None = None, cols=DEFAULT_COLUMNS
) -> dict[str, DataFrame]:
    """The sheets that go with the disconnect extract, by name."""
    return {
        "raw_data": rows,
        "product_counts": product_counts(rows, cols),
        "term_types": pivot_term_type(rows, cols),
        "renewal_terms": pivot_renewal_term(rows, terms, cols),
        "statuses": pivot_status(rows, statuses, cols),
    }
