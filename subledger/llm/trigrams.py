"""Boolean trigram queries: which trigrams a text must hold to match a regex."""

from __future__ import annotations

from itertools import product
from re import _constants as kind
from re import _parser as parser

#: An OR of ANDs of trigrams in lower case; an empty AND holds for any text.
Query = frozenset[frozenset[str]]

ANY: Query = frozenset([frozenset()])
_MOST = 64  # strings or ANDs followed; beyond it the query gets weaker, never wrong


def _least(ands: set[frozenset[str]]) -> Query:
    """Without ANDs that another one implies."""
    return frozenset(a for a in ands if not any(b < a for b in ands))


def _and(a: Query, b: Query) -> Query:
    both = _least({x | y for x, y in product(a, b)})
    return both if len(both) <= _MOST else a


def _or(queries: list[Query]) -> Query:
    either = _least(set().union(*queries))
    return either if len(either) <= _MOST else ANY


def _holding(strings: set[str]) -> Query:
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _one_of(members: list) -> set[str] | None:
    """The characters of a class, if they are few."""
    out: set[str] = set()
    for op, value in members:
        if op is kind.LITERAL:
            out.add(chr(value).lower())
        elif op is kind.RANGE and value[1] - value[0] < 16:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 16 else None


def _walk(items) -> tuple[set[str] | None, Query]:
    """All strings that a sequence matches, if they are few, and its query."""
    run, query, exact = {""}, ANY, True
    for op, value in items:
        strings, inner = _item(op, value)
        if strings is not None and len(run) * len(strings) <= _MOST:
            run = {a + b for a, b in product(run, strings)}
            continue
        query, exact = _and(query, _holding(run)), False
        run = strings or {""}
        if strings is None:
            query = _and(query, inner)
    return (run, _holding(run)) if exact else (None, _and(query, _holding(run)))


def _item(op, value) -> tuple[set[str] | None, Query]:
    if op is kind.LITERAL:
        return {chr(value).lower()}, ANY
    if op is kind.IN:
        return _one_of(value), ANY
    if op is kind.SUBPATTERN:
        return _walk(value[-1])
    if op is kind.BRANCH:
        ways = [_walk(way) for way in value[1]]
        if all(strings is not None for strings, _ in ways):
            strings = set().union(*(s for s, _ in ways))
            return strings, _holding(strings)
        return None, _or([q for _, q in ways])
    if op in (kind.MAX_REPEAT, kind.MIN_REPEAT, kind.POSSESSIVE_REPEAT):
        least, most, inner = value
        strings, query = _walk(inner)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, ANY
        if strings is not None and least == most and len(strings) ** least <= _MOST:
            return {"".join(x) for x in product(strings, repeat=least)}, ANY
        return None, query if least else ANY
    if op is kind.AT:
        return {""}, ANY
    return None, ANY


def trigram_query(pattern: str) -> Query:
    """The query every text with a match satisfies once it is in lower case.

    ``ANY`` if the pattern has no mandatory trigram.
    """
    return _walk(parser.parse(pattern))[1]
