"""Column helpers which the operators of this subpackage share.

Conventions of every operator: a null text counts as an empty one, rows are
never merged or dropped by equality unless that is the operator's purpose, an
input column with the name of an output column gives way to the output, and
helper columns get names the input doesn't have.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
# Runs of digits, a-z and everything beyond ASCII, in text whose A-Z are lower-cased.
NOT_IN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# What separates words before A-Z are lower-cased.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value which is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def col(name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is. ``lower`` does it for ASCII texts,
    and does it much faster than ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def pieces(text: Column, separators: str) -> Column:
    """What lies between separators, without empty pieces."""
    return F.array_remove(F.split(text, separators), "")


def words(text: Column) -> Column:
    """Words of a text in lower case: digits, a-z, and all beyond ASCII."""
    return pieces(ascii_lower(text), NOT_IN_WORDS)


def n_words(text: Column) -> Column:
    """How many ``words`` a text has, without making them."""
    return F.size(pieces(text, BETWEEN_WORDS))


def indices(count: Column) -> Column:
    """0 to ``count`` - 1, none for a count of 0 or less."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


#: Elements of a block of ``scan``.
BLOCK = 128


def blocks_of(values: Column) -> Column:
    """Places (from 0) at which blocks of ``BLOCK`` elements begin."""
    return F.transform(indices(F.ceil(F.size(values) / BLOCK).cast("int")), lambda b: b * BLOCK)


def scan(values: Column, zero: Column, step: Callable[[Column, Column], Column]) -> Column:
    """What ``step`` has made of ``zero`` and the elements up to each one.

    A growing array is copied with every element put to it; blocks keep the
    copies short: first the state at the start of each block, then the states
    within it.
    """

    def of(values: Column) -> Column:
        part = lambda at: F.slice(values, at + 1, BLOCK)

        def next_block(acc: Column, at: Column) -> Column:
            state = F.aggregate(part(at), F.element_at(acc, -1), step)
            return F.concat(acc, F.array(state))

        def next_value(acc: Column, value: Column) -> Column:
            return F.concat(acc, F.array(step(F.element_at(acc, -1), value)))

        def within(states: Column) -> Column:
            return F.transform(
                blocks_of(values),
                lambda at, b: F.slice(F.aggregate(part(at), F.array(F.get(states, b)), next_value), 2, BLOCK),
            )

        return F.flatten(let(F.aggregate(blocks_of(values), F.array(zero), next_block), within))

    return let(values, of)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """A name like each of these that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less its columns of these names, compared as Spark compares names."""
    gone = {n.lower() for n in names}
    return df.select([col(c) for c in df.columns if c.lower() not in gone])
