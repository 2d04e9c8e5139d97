"""Disconnected rows and accounts that left altogether."""

from __future__ import annotations

import calendar
from collections.abc import Iterable, Sequence
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.columns import DEFAULT_COLUMNS, SubscriptionColumns
from subledger.functions.dates import Spine, as_date, month_start
from subledger.functions.predicates import disconnect_date, disconnect_ok, without_names
from subledger.operators.date_bits import all_words, by_date, mask, positions, words
from subledger.operators.keys import first_per_key
from subledger.operators.snapshot import active_ranges


def disconnect_rows(
    facts: DataFrame,
    spine: Spine,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    null_semantics: str = "sql",
    exclude: Iterable[str] = (),
    exclude_like: Iterable[str] = (),
    created_only: bool = False,
) -> DataFrame:
    """Rows that disconnect, tagged with the ``report_date`` they do so.

    ``created_only`` is the reduced rule that places every row on its rate
    plan's creation date and does not look at the cancellation.
    """
    on = F.to_date(cols.rate_plan_created) if created_only else disconnect_date(cols)
    return (
        facts.where(without_names(F.col(cols.product), exclude, exclude_like))
        .withColumn("report_date", on)
        .where(spine.contains(F.col("report_date")) & disconnect_ok(F.col("report_date"), cols, null_semantics))
    )


def churned_accounts(
    facts: DataFrame,
    snapshots: Spine,
    window: tuple[date, date] | None = None,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    exclude: Iterable[str] = (),
    exclude_like: Iterable[str] = (),
) -> DataFrame:
    """Rate plans of accounts all of whose active subscriptions disconnect.

    Per snapshot date the active rows meet the disconnects of their account
    and subscription; an account stays when every row has one. ``window``
    fixes the dates of the disconnects; without it they run from the snapshot
    date to the end of its month. Equal pairs of active and disconnect rows
    are one row with their number in ``row_count``.

    Everything is worked out on sets of snapshot dates, see
    :mod:`subledger.operators.date_bits`. A subscription's days of disconnects,
    at most one a date, meet its active rows as one list, and dates and days
    are written out last, spread by rate plan: so a subscription that holds
    most rows is written by many tasks.
    """
    plans = [cols.account, cols.sub_name, cols.family, cols.product, cols.rate_plan]
    on = plans[:2]
    ended = _disconnects(facts, snapshots, window, cols, exclude, exclude_like)
    held = _active_words(facts, plans, snapshots, cols, exclude, exclude_like)
    lost = _lost_words(held, ended, snapshots, window, cols)
    days = ended.groupBy(*on).agg(F.collect_list(F.struct("cancel_date", "_ended")).alias("_days"))
    kept = _kept(held, lost, cols).join(days, on)
    dealt = by_date(kept.repartition(*plans), snapshots, "snapshot_date")
    # The days are those of the subscription, whichever row they come with.
    counted = dealt.groupBy("snapshot_date", *plans).agg(F.sum("_active").alias("_active"), F.first("_days").alias("_days"))
    found = F.col("_days")
    if window is None:
        month_end = F.last_day("snapshot_date")
        found = F.filter(found, lambda d: d["cancel_date"].between(F.col("snapshot_date"), month_end))
    pairs = counted.select("snapshot_date", *plans, "_active", F.explode(found).alias("_day"))
    return pairs.select("snapshot_date", *plans, "_day.cancel_date", (F.col("_active") * F.col("_day._ended")).alias("row_count"))


def accounts_cancelled_daily(
    facts: DataFrame,
    snapshots: Spine,
    window: tuple[date, date] | None = None,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    exclude: Iterable[str] = (),
    exclude_like: Iterable[str] = (),
) -> DataFrame:
    """Churned accounts counted per cancellation date."""
    on = [cols.account, cols.sub_name]
    ended = _disconnects(facts, snapshots, window, cols, exclude, exclude_like)
    held = _active_words(facts, on, snapshots, cols, exclude, exclude_like)
    subs = held.groupBy(*on, "_word").agg(F.bit_or("_bits").alias("_bits"))
    kept = _kept(subs, _lost_words(held, ended, snapshots, window, cols), cols)
    if window is not None:
        # Any snapshot will do, so a subscription counts once.
        pairs = kept.select(*on).distinct().join(ended, on)
    else:
        pairs = _of_month(kept.join(ended, on), snapshots)
    pairs = pairs.select(cols.account, "cancel_date").distinct()
    return pairs.groupBy("cancel_date").agg(F.count(F.lit(1)).alias("accounts_cancelled"))


def _active_words(facts, keys, snapshots, cols, exclude, exclude_like) -> DataFrame:
    """Active rows counted per key and range of snapshot dates, a row per word of dates.

    The latest version is looked up among all rows, excluded ones as well.
    """
    active = active_ranges(facts, snapshots, cols).where(without_names(F.col(cols.product), exclude, exclude_like))
    # Said here, as the joins would say it of some uses only and keep them apart. A row
    # without a subscription stays: it has no disconnect, so its account isn't lost.
    active = active.where(F.col(cols.account).isNotNull())
    first, last = positions(snapshots, F.col("_lo"), F.col("_hi"))
    ranges = active.select(*keys, first.alias("_first"), last.alias("_last")).where("_first <= _last")
    counted = ranges.groupBy(*keys, "_first", "_last").agg(F.count("*").alias("_active"))
    # As in _disconnects, for one aggregation in all uses.
    return words(counted.where("_active > 0"), "_first", "_last")


def _disconnects(facts, snapshots, window, cols, exclude, exclude_like) -> DataFrame:
    """Disconnects counted per subscription and day."""
    if window is not None:
        days = Spine(*window)
    else:
        days = replace(snapshots, end=_last_of_month(snapshots.end), step="day")
    rows = disconnect_rows(facts, days, cols, exclude=exclude, exclude_like=exclude_like)
    rows = rows.where(F.col(cols.account).isNotNull() & F.col(cols.sub_name).isNotNull())
    ended = rows.groupBy(cols.account, cols.sub_name, F.col("report_date").alias("cancel_date"))
    # Keeps the count in every use, so that all uses share one aggregation.
    return ended.agg(F.count("*").alias("_ended")).where("_ended > 0")


def _month_positions(snapshots: Spine) -> tuple[Column, Column]:
    """A disconnect belongs to the snapshots of its month up to its day."""
    day = F.col("cancel_date")
    return positions(snapshots, month_start(day), F.date_add(day, 1))


def _of_month(pairs: DataFrame, snapshots: Spine) -> DataFrame:
    """Bits of the snapshots that the pair's disconnect belongs to."""
    first, last = _month_positions(snapshots)
    cut = pairs.withColumns({"_first": first, "_last": last}).where("_first IS NOT NULL")
    bits = F.col("_bits").bitwiseAND(mask(F.col("_first"), F.col("_last"), F.col("_word")))
    return cut.withColumn("_bits", bits).drop("_first", "_last").where("_bits <> 0")


def _kept(held: DataFrame, lost: DataFrame, cols: SubscriptionColumns) -> DataFrame:
    """Bits of the dates on which the account is lost."""
    met = held.join(lost, [cols.account, "_word"])
    return met.withColumn("_bits", F.col("_bits").bitwiseAND(F.col("_lost"))).drop("_lost").where("_bits <> 0")


def _lost_words(
    held: DataFrame, ended: DataFrame, snapshots: Spine, window: tuple[date, date] | None, cols: SubscriptionColumns
) -> DataFrame:
    """Snapshot dates on which all active subscriptions of an account disconnect.

    Those are the dates on which some subscription of it is active, and none
    that is active has no disconnect.
    """
    on = [cols.account, cols.sub_name]
    if window is not None:
        found = all_words(ended.select(*on).distinct(), snapshots)
    else:
        first, last = _month_positions(snapshots)
        found = words(ended.select(*on, first.alias("_first"), last.alias("_last")), "_first", "_last")
    none = F.lit(0).cast("long")
    both = held.select(*on, "_word", F.col("_bits").alias("_a"), none.alias("_d")).unionByName(
        found.select(*on, "_word", none.alias("_a"), F.col("_bits").alias("_d"))
    )
    subs = both.groupBy(*on, "_word").agg(F.bit_or("_a").alias("_a"), F.bit_or("_d").alias("_d"))
    stays = F.col("_a").bitwiseAND(F.bitwise_not("_d"))
    accounts = subs.groupBy(cols.account, "_word").agg(F.bit_or("_a").alias("_any"), F.bit_or(stays).alias("_stays"))
    lost = F.col("_any").bitwiseAND(F.bitwise_not("_stays"))
    return accounts.select(cols.account, "_word", lost.alias("_lost")).where("_lost <> 0")


def _last_of_month(day: date) -> date:
    return day.replace(day=calendar.monthrange(day.year, day.month)[1])


def disconnect_extract(
    facts: DataFrame,
    start,
    end,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    order: Sequence[str] | None = None,
    never_null: Sequence[str] = (),
) -> DataFrame:
    """Rate plans that ended around a window, with their attributes and sums.

    Created from ``start`` on and cancelled by ``end``, or created before and
    cancelled from ``start`` on.
    """
    created, cancelled = F.to_date(cols.rate_plan_created), F.col(cols.cancelled)
    start, end = as_date(start), as_date(end)
    inside = ((created >= start) & (cancelled <= end)) | ((created < start) & (cancelled >= start))
    return _by_rate_plan(facts.where(inside), cols, order, never_null)


def cancel_details(
    facts: DataFrame,
    amended: str,
    start,
    end,
    cols: SubscriptionColumns = DEFAULT_COLUMNS,
    order: Sequence[str] | None = None,
    never_null: Sequence[str] = (),
) -> DataFrame:
    """Rate plans whose amendment was created in the window."""
    day = F.col(amended)
    return _by_rate_plan(facts.where((day >= as_date(start)) & (day <= as_date(end))), cols, order, never_null)


def _by_rate_plan(
    rows: DataFrame, cols: SubscriptionColumns, order: Sequence[str] | None, never_null: Sequence[str]
) -> DataFrame:
    measures = [cols.mrr, cols.tcv]
    attributes = [c for c in rows.columns if c not in (cols.rate_plan_id, *measures)]
    order = order or [cols.rate_plan_created]
    grouped = first_per_key(rows, [cols.rate_plan_id], order, attributes, measures, never_null)
    return grouped.withColumn("report_date", F.to_date(cols.rate_plan_created))
