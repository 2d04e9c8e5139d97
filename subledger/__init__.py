"""Recurring-revenue analytics expressed as Spark DataFrame operations."""

from subledger.columns import SubscriptionColumns
from subledger.functions.dates import Spine

__all__ = ["SubscriptionColumns", "Spine"]
