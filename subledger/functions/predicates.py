"""Predicates shared by the reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from subledger.columns import DEFAULT_COLUMNS, NEW_PRODUCT, REMOVE_PRODUCT, UPDATE_PRODUCT, SubscriptionColumns
from subledger.functions.dates import latest_of


def cancel_ok(on: Column, cols: SubscriptionColumns = DEFAULT_COLUMNS) -> Column:
    """Not yet cancelled on the date."""
    cancelled = F.col(cols.cancelled)
    return cancelled.isNull() | (cancelled > on)


def amend_ok(on: Column, cols: SubscriptionColumns = DEFAULT_COLUMNS) -> Column:
    """The amendment, if any, leaves the rate plan in force on the date."""
    kind, effective = F.col(cols.amend_type), F.col(cols.amend_effective)
    return (
        kind.isNull()
        | ((kind == UPDATE_PRODUCT) & effective.isNotNull())
        | ((kind == NEW_PRODUCT) & (effective <= on))
        | ((kind == REMOVE_PRODUCT) & (effective > on))
    )


def disconnect_ok(
    on: Column, cols: SubscriptionColumns = DEFAULT_COLUMNS, null_semantics: str = "sql"
) -> Column:
    """The rate plan was still in force when the subscription ended.

    With ``null_semantics='sql'`` an unknown comparison under the negation
    drops the row; with ``'pandas'`` a comparison with null counts as false,
    so the row stays.
    """
    if null_semantics not in ("sql", "pandas"):
        raise ValueError("null_semantics must be 'sql' or 'pandas'")

    def known(test: Column) -> Column:
        return F.coalesce(test, F.lit(False)) if null_semantics == "pandas" else test

    kind, effective = F.col(cols.amend_type), F.col(cols.amend_effective)
    gone = known(kind == REMOVE_PRODUCT) & known(effective <= on)
    later = known(kind == NEW_PRODUCT) & known(effective > on)
    not_started = known(F.col(cols.term_start) > on)
    return kind.isNull() | ~(gone | later | not_started)


def disconnect_date(cols: SubscriptionColumns = DEFAULT_COLUMNS) -> Column:
    """The one date on which a cancelled row can count as a disconnect.

    Created on the date and cancelled by then, or created before and cancelled
    on the date: both put it on the later of the two.
    """
    return latest_of(F.to_date(cols.rate_plan_created), F.col(cols.cancelled).cast("date"))


def without_names(name: Column, equal_to: Iterable[str] = (), like: Iterable[str] = ()) -> Column:
    """Name equals none of the values and matches none of the patterns."""
    test = F.lit(True)
    for value in equal_to:
        test = test & (name != value)
    for pattern in like:
        test = test & ~name.like(pattern)
    return test


def type_in(kind: Column, values: Iterable[str]) -> Column:
    return F.coalesce(kind.isin(*values), F.lit(False))


def type_not_in(kind: Column, values: Iterable[str]) -> Column:
    """Type is none of the values; a missing type passes."""
    return ~type_in(kind, values)


def same_day(a: Column, b: Column) -> Column:
    return F.to_date(a) == F.to_date(b)


def within_months(ts: Column, as_of: Column, months: int) -> Column:
    """Not older than the given number of months before ``as_of``."""
    return ts >= F.add_months(as_of, -months)
