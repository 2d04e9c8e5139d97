"""Revenue: additions, period to date, recurring forecast."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subledger.columns import DEFAULT_COLUMNS, SubscriptionColumns
from subledger.functions.dates import Spine, as_date
from subledger.functions.predicates import same_day
from subledger.operators.joins import period_days, unique_period_days
from subledger.operators.keys import first_per_key


def adds_rows(
    items: DataFrame,
    start,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    item_created: str = "item_created",
    currency: str = "USD",
    test_names: dict[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Invoice items of first versions, billed the day the rate plan began.

    ``test_names`` maps columns to LIKE patterns of internal test accounts.
    """
    kept = items.where(
        (F.to_date(cols.rate_plan_created) >= as_date(start))
        & (F.col(cols.currency) == currency)
        & (F.col(cols.version) == 1)
        & same_day(F.col(item_created), F.col(cols.rate_plan_created))
    )
    for name, patterns in (test_names or {}).items():
        for pattern in patterns:
            kept = kept.where(~F.col(name).like(pattern))
    return kept


def adds_extract(
    items: DataFrame,
    start,
    order: Sequence[str],
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    revenue: str = "charge_amount",
    never_null: Sequence[str] = (),
    **rules,
) -> DataFrame:
    """Additions per rate plan: first known attributes, summed measures.

    ``never_null`` names attributes without nulls, see :func:`first_per_key`.
    """
    rows = adds_rows(items, start, cols, **rules).withColumnRenamed(revenue, "total_adds_revenue")
    order = [*order]
    measures = [cols.mrr, cols.tcv, "total_adds_revenue"]
    attributes = [c for c in rows.columns if c not in (cols.rate_plan_id, *measures)]
    grouped = first_per_key(rows, [cols.rate_plan_id], order, attributes, measures, never_null)
    return grouped.withColumn("report_date", F.to_date(cols.rate_plan_created))


def revenue_to_date(
    schedule: DataFrame,
    periods: DataFrame,
    spine: Spine,
    by: Sequence[str] = ("product_name", "region", "currency"),
    period: str = "accounting_period",
    day: str = "revenue_date",
    amount: str = "revenue_amount",
    name: str = "name",
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Revenue of the period containing each report date, up to that date.

    Amounts are summed per day first; a running sum inside the period then
    holds until the next day with revenue. A report date in two periods
    raises, one in no period has no rows.
    """
    days = unique_period_days(period_days(periods, name, start, end, spine), name)
    per_day = schedule.groupBy(period, *by, day).agg(F.sum(amount).alias("_sum"))
    bounds = days.groupBy(name).agg(F.min("report_date").alias("_first"), F.max("report_date").alias("_last"))
    placed = (
        per_day.join(bounds, F.col(period) == F.col(name))
        .withColumn("_at", F.greatest(F.col(day), F.col("_first")))
        .where(F.col(day).isNotNull() & (F.col("_at") <= F.col("_last")))
        .groupBy(period, *by, "_at", "_last")
        .agg(F.sum("_sum").alias("_sum"))
    )
    in_period = Window.partitionBy(period, *by).orderBy("_at")
    running = placed.select(
        period,
        *by,
        "_at",
        F.coalesce(F.lead("_at").over(in_period), F.date_add("_last", 1)).alias("_until"),
        F.sum("_sum").over(in_period.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("_total"),
    )
    return spine.expand(running, F.col("_at"), F.col("_until")).select(
        "report_date", *by, F.coalesce(F.col("_total"), F.lit(0)).alias(amount)
    )


def arr_forecast(
    charges: DataFrame,
    start,
    end,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    status: str = "Active",
    currency: str = "USD",
) -> DataFrame:
    """Charges that run out in the window, with recurring revenue by term type."""
    kind, mrr = F.col(cols.term_type), F.col(cols.mrr)
    rows = charges.where(
        F.col(cols.charged_through).between(as_date(start), as_date(end))
        & (F.col(cols.status) == status)
        & (F.col(cols.currency) == currency)
    ).distinct()
    return rows.withColumns(
        {
            "evergreen_arr": F.when(kind == "EVERGREEN", mrr).otherwise(0),
            "termed_arr": F.when(kind == "TERMED", mrr * F.col(cols.renewal_term)).otherwise(0),
        }
    )
