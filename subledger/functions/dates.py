"""Report dates, month arithmetic and time coercion."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(value) -> Column:
    """Column or literal as a date; strings are read as ISO dates."""
    if isinstance(value, (dt.date, dt.datetime)):
        return F.lit(value).cast("date")
    if isinstance(value, str):
        return F.to_date(F.lit(value))
    return value.cast("date")


def latest_of(*dates: Column) -> Column:
    """Greatest of the dates, null as soon as one is null."""
    known = dates[0].isNotNull()
    for date in dates[1:]:
        known = known & date.isNotNull()
    return F.when(known, F.greatest(*dates))


@dataclass(frozen=True)
class Spine:
    """Report dates from ``start`` to ``end``, daily or at month starts.

    Reports never join facts with the list of dates. A row is active over one
    range of dates or falls on one date, and the methods here turn such ranges
    into report dates by arithmetic.
    """

    start: dt.date
    end: dt.date
    step: str = "day"

    def __post_init__(self):
        if self.step not in ("day", "month"):
            raise ValueError("step must be 'day' or 'month'")
        if self.end < self.start:
            raise ValueError("end lies before start")

    @classmethod
    def of(cls, start: str, end: str, step: str = "day") -> "Spine":
        return cls(dt.date.fromisoformat(start), dt.date.fromisoformat(end), step)

    @classmethod
    def lookback(cls, as_of: dt.date, first: int, last: int = 1) -> "Spine":
        """Daily dates from ``first`` to ``last`` days before ``as_of``."""
        return cls(as_of - dt.timedelta(days=first), as_of - dt.timedelta(days=last))

    def frame(self, spark: SparkSession, name: str = "report_date") -> DataFrame:
        return self.expand(spark.range(1).select(), F.lit(self.start), name=name)

    def contains(self, date: Column) -> Column:
        inside = date.between(F.lit(self.start), F.lit(self.end))
        return inside & (F.dayofmonth(date) == 1) if self.step == "month" else inside

    def on_or_after(self, date: Column) -> Column:
        """First report date not before ``date``; null when there is none."""
        start = F.lit(self.start)
        if self.step == "month":
            date = date.cast("date")
        floor = F.when(date < start, start).otherwise(date)
        if self.step == "month":
            floor = F.trunc(F.date_sub(F.add_months(floor, 1), 1), "MM")
        # Tested by the date itself, so that its floor is worked out once.
        return F.when(self.reaches(date), floor)

    def reaches(self, date: Column) -> Column:
        """Whether there is a report date on or after ``date``."""
        return date <= F.lit(self._last()) if self.size() else F.lit(False)

    def size(self) -> int:
        """Number of report dates."""
        if self.step == "day":
            return (self.end - self.start).days + 1
        return max(0, self._month(self.end) - self._month(self._first()) + 1)

    def date_list(self) -> list[dt.date]:
        """The report dates, in order."""
        first, n = self._first(), self.size()
        if self.step == "day":
            return [first + dt.timedelta(days=i) for i in range(n)]
        months = range(self._month(first), self._month(first) + n)
        return [dt.date(m // 12, m % 12 + 1, 1) for m in months]

    def _first(self) -> dt.date:
        if self.step == "day" or self.start.day == 1:
            return self.start
        return (self.start.replace(day=1) + dt.timedelta(days=32)).replace(day=1)

    def _last(self) -> dt.date:
        """The last report date, of which there is one at least; a spine without an end has very many."""
        return self.end if self.step == "day" else self.end.replace(day=1)

    @staticmethod
    def _month(date: dt.date) -> int:
        return date.year * 12 + date.month - 1

    def position(self, date: Column) -> Column:
        """Place of a report date among all, from 0."""
        if self.step == "day":
            return F.datediff(date, F.lit(self.start))
        return F.year(date) * 12 + F.month(date) - 1 - self._month(self._first())

    def date_at(self, position: Column) -> Column:
        """The report date at a place."""
        first = F.lit(self._first())
        return F.date_add(first, position) if self.step == "day" else F.add_months(first, position)

    def expand(
        self, df: DataFrame, lo: Column, hi: Column | None = None, name: str = "report_date", text: bool = False
    ) -> DataFrame:
        """Each row once per report date in ``[lo, hi)``; a null ``hi`` is open.

        The places of the dates are listed, as whole numbers are far cheaper to
        list than months. With ``text`` the dates are ISO texts, looked up among
        those of the spine instead of made anew for each row.

        The bounds are columns of their own, and the explode is an outer one:
        otherwise Spark writes the bounds out wherever they are used and tests
        each list of places before it expands it, building the list twice.
        """
        after = F.lit(self.size())
        if hi is not None:
            after = F.coalesce(self.position(self.on_or_after(hi.cast("date"))), after)
        first = self.position(self.on_or_after(lo))
        bounded = df.select("*", first.alias("_first"), (after - 1).alias("_last"))
        places = F.when(F.col("_first") <= F.col("_last"), F.sequence("_first", "_last"))
        placed = bounded.select(*df.columns, F.explode_outer(places).alias("_place")).where("_place IS NOT NULL")
        return placed.select(*df.columns, (self._text_at if text else self.date_at)(F.col("_place")).alias(name))

    def _text_at(self, position: Column) -> Column:
        texts = F.array(*(F.lit(d.isoformat()) for d in self.date_list())).cast("array<string>")
        return F.get(texts, position)


def month_start(date: Column) -> Column:
    return F.trunc(date, "MM").cast("date")


def month_end(date: Column) -> Column:
    return F.last_day(date)


def parse_timestamp(text: Column, strict: bool = False) -> Column:
    """Text to timestamp in the session zone; bad text is null unless strict."""
    return F.to_timestamp(text) if strict else F.try_to_timestamp(text)


def iso_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def iso_instant(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
