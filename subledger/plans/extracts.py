"""Wide extracts: a fact with the attributes of everything it points at."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.columns import DEFAULT_COLUMNS, SubscriptionColumns
from subledger.functions.dates import as_date
from subledger.functions.scalars import last_label, to_number
from subledger.operators.cleaning import fill_sentinel, normalise_timestamps
from subledger.operators.joins import Dimension, star_join
from subledger.operators.keys import first_per_key


def incremental_extract(
    fact: DataFrame,
    dimensions: Sequence[Dimension],
    since: Column | None = None,
    timestamps: Sequence[str] = (),
    distinct: bool = False,
) -> DataFrame:
    """Star extract of the fact rows past the mark, timestamps normalised.

    Payments, invoice payments, contacts and rate plan catalogues are all this
    with their own dimensions.
    """
    rows = fact.where(since) if since is not None else fact
    wide = normalise_timestamps(star_join(rows, dimensions), timestamps)
    return wide.distinct() if distinct else wide


def tax_items(
    items: DataFrame,
    dimensions: Sequence[Dimension],
    since: Column,
    postal_codes: Sequence[str],
    origin: Mapping[str, str],
    fill: str = " ",
) -> DataFrame:
    """Tax items with where they were taxed from: text nulls filled, constant
    origin columns added, postal codes numeric where they are numbers."""
    wide = fill_sentinel(star_join(items.where(since), dimensions), fill)
    wide = wide.withColumns({name: F.lit(value) for name, value in origin.items()})
    return wide.withColumns({c: to_number(F.col(c)) for c in postal_codes})


def subscription_fact(
    charges: DataFrame,
    invoice_items: DataFrame,
    start,
    attributes: Sequence[str],
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    item_plan: str = "rp_id",
    charge_amount: str = "charge_amount",
    currency: str = "USD",
    first_version_only: bool = True,
    never_null: Sequence[str] = (),
) -> DataFrame:
    """Rate plans with summed MRR, TCV and the revenue billed for them.

    Charges and invoice items are summed per rate plan on their own before
    they meet, so neither side multiplies the other. Charges are grouped by
    the rate plan alone; each attribute is the first one known, in the order of
    the attributes, null if none is. Those in ``never_null`` come from the first
    charge as a whole, which is narrower; a null in one of them is an error.
    """
    kept = charges.where((F.to_date(cols.rate_plan_created) >= as_date(start)) & (F.col(cols.currency) == currency))
    if first_version_only:
        kept = kept.where(F.col(cols.version) == 1)
    plans = first_per_key(kept, [cols.rate_plan_id], attributes, attributes, [cols.mrr, cols.tcv], never_null)
    billed = invoice_items.groupBy(F.col(item_plan).alias(cols.rate_plan_id)).agg(
        F.sum(charge_amount).alias("total_adds_revenue")
    )
    wide = plans.join(billed, cols.rate_plan_id, "left")
    return wide.withColumn("report_date", F.to_date(cols.rate_plan_created))


def audit_export(audits: DataFrame, dimensions: Sequence[Dimension], created: str, floor) -> DataFrame:
    """Audits after the floor date with opportunity, agent, auditor, lead and
    case; any of them may be missing."""
    rows = audits.where(F.to_date(created) > as_date(floor))
    return star_join(rows, dimensions).withColumn(created, F.to_date(created))


def survey_summary(surveys: DataFrame, dimensions: Sequence[Dimension], created: str, floor) -> DataFrame:
    """Surveys whose case was opened after the floor date. All dimensions but
    the optional ones must be there."""
    return star_join(surveys, dimensions).where(F.to_date(created) > as_date(floor))


def domain_summary(
    subscriptions: DataFrame,
    rate_plans: DataFrame,
    services: DataFrame,
    name: str = "display_name",
) -> DataFrame:
    """Services of the rate plans of a subscription, with its domain ending."""
    plans = rate_plans.select(
        F.col("id").alias("subscription_rateplan_id"),
        F.col("subscription_id").alias("id"),
        "rateplan_id",
    )
    owned = services.select("subscription_rateplan_id", "name", F.col("subscription_id"))
    joined = subscriptions.join(plans, "id").join(owned, "subscription_rateplan_id")
    return joined.withColumn("domain_extension", last_label(F.col(name)))
