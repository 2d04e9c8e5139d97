"""Sets of report dates as bits, 64 dates to a word.

Whether a key is active on a date, and whether something holds on it, are set
operations: ``bit_or`` over a key's rows and bitwise and, or, not between
sets. They need no order, so no window, and combine before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.functions.dates import Spine

WORD = 64


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def mask(first: Column, last: Column, word: Column) -> Column:
    """Bits of the dates from position ``first`` to ``last`` that lie in a word."""
    start = F.greatest(first - word * WORD, F.lit(0))
    stop = F.least(last - word * WORD, F.lit(WORD - 1))
    upper = F.call_function("shiftleft", _long(-1), start)
    lower = F.call_function("shiftrightunsigned", _long(-1), F.lit(WORD - 1) - stop)
    return F.when(start <= stop, upper.bitwiseAND(lower)).otherwise(_long(0))


def positions(spine: Spine, lo: Column, hi: Column) -> tuple[Column, Column]:
    """First and last position of the report dates in ``[lo, hi)``; a null ``hi``
    is open, a null first position means that there is none."""
    first = spine.position(spine.on_or_after(lo))
    last = F.coalesce(spine.position(spine.on_or_after(hi)) - 1, F.lit(spine.size() - 1))
    return first, last


def words(df: DataFrame, first: str, last: str) -> DataFrame:
    """Each row once per word that its positions touch, with its bits: ``_word``, ``_bits``."""
    there = F.when(F.col(first) <= F.col(last), F.sequence(F.expr(f"{first} div {WORD}"), F.expr(f"{last} div {WORD}")))
    spread = df.select("*", F.explode(there).alias("_word")).withColumn("_word", F.col("_word").cast("int"))
    return spread.withColumn("_bits", mask(F.col(first), F.col(last), F.col("_word"))).drop(first, last)


def all_words(df: DataFrame, spine: Spine) -> DataFrame:
    """Each row with all report dates: a row per word, all bits set."""
    count = -(-spine.size() // WORD)
    every = F.array(*(F.lit(i) for i in range(count)))
    return df.select("*", F.explode(every).alias("_word"), _long(-1).alias("_bits"))


def by_date(df: DataFrame, spine: Spine, name: str) -> DataFrame:
    """Each row once per report date of its bits, in place of ``_word`` and ``_bits``."""
    rest = [c for c in df.columns if c not in ("_word", "_bits")]
    places = df.select("*", F.explode(F.array(*(F.lit(i) for i in range(WORD)))).alias("_place"))
    there = places.where(F.getbit("_bits", F.col("_place")) == 1)
    return there.select(spine.date_at(F.col("_word") * WORD + F.col("_place")).alias(name), *rest)
