"""Secret scans: a trigram inverted index names the texts that a rule must read."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.columns import BLOCK, blocks_of, col, fresh, let, scan, text_of, without
from subledger.llm.trigrams import ANY, Query, trigram_query
from subledger.session import shared_dir

# Documents of one segment of the index: bounds every posting list.
SEGMENT_ROWS = 4_096
# Candidate rows (a key and some rule names, under 200 bytes) that may be sent
# to every executor: 20 MB. More of them are joined by shuffle.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of which ``group`` has ``least`` characters or more."""

    name: str
    pattern: str
    group: int = 0
    least: int = 0


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

#: In the order in which spans that start together are listed. The matches of
#: ``[0-9a-f]+`` are whole runs, and those of the access rule start at the
#: first AKIA of a run and end with it, so for both a bound in the pattern
#: finds the same spans as a look at the length afterwards.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", r"gh[opsu]_[A-Za-z0-9]{36,}"),
)


def _key(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit("\x00null"))


def _queries(rules: Sequence[Rule]) -> dict[str, Query]:
    """Of the rules that have mandatory trigrams."""
    return {r.name: q for r in rules if (q := trigram_query(r.pattern)) != ANY}


def inverted_index(df: DataFrame, key: str, text: str, trigrams: Sequence[str]) -> DataFrame:
    """Postings ``(segment, trigram, keys)`` of the texts in lower case.

    Only the trigrams some rule asks for are kept, so the index grows with the
    number of documents and not with their length. A segment is a hash range
    of about ``SEGMENT_ROWS`` keys; no list grows beyond it, however many
    documents hold a trigram.
    """
    segments = max(1, -(-df.count() // SEGMENT_ROWS))
    held = let(
        F.lower(text_of(text)),
        lambda folded: F.array_compact(F.array(*(F.when(F.contains(folded, F.lit(t)), F.lit(t)) for t in trigrams))),
    )
    rows = df.select(_key(key).alias("_key"), F.explode(held).alias("trigram"))
    rows = rows.withColumn("segment", F.pmod(F.xxhash64("_key"), F.lit(segments)))
    return rows.groupBy("segment", "trigram").agg(F.collect_set("_key").alias("keys"))


def _intersected(postings: Column, query: Query) -> Column:
    def of(trigram: str) -> Column:
        return F.coalesce(F.element_at(postings, trigram), F.array().cast("array<string>"))

    either = None
    for conjunction in sorted(map(sorted, query)):
        all_of = of(conjunction[0])
        for trigram in conjunction[1:]:
            all_of = F.array_intersect(all_of, of(trigram))
        either = all_of if either is None else F.array_union(either, all_of)
    return either


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """``(_key, _rules)``: per key the rules whose query its postings satisfy."""
    by_segment = index.groupBy("segment").agg(
        F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("_postings")
    )

    def named(rule: str, query: Query) -> Column:
        keys = _intersected(F.col("_postings"), query)
        return F.transform(keys, lambda k: F.struct(k.alias("k"), F.lit(rule).alias("r")))

    found = [named(rule, query) for rule, query in queries.items()]
    pairs = by_segment.select(F.explode(F.flatten(F.array(*found))).alias("_pair"))
    return pairs.groupBy(F.col("_pair.k").alias("_key")).agg(F.collect_set("_pair.r").alias("_rules"))


_SPAN = "array<struct<start:bigint,end:bigint>>"


def _spans(text: Column, rule: Rule) -> Column:
    """Start and end of every match that counts, in code points."""
    pattern = F.lit(rule.pattern)

    def walk(found: Column, tested: Column, gaps: Column) -> Column:
        sizes = F.transform(
            found,
            lambda f, i: F.struct(
                (F.length(F.get(gaps, i)) + F.length(f)).cast("bigint").alias("step"),
                F.length(f).alias("size"),
                F.length(F.get(tested, i)).alias("tested"),
            ),
        )

        def placed(sizes: Column) -> Column:
            ends = scan(sizes, F.lit(0).cast("bigint"), lambda at, s: at + s["step"])
            every = F.zip_with(
                sizes,
                ends,
                lambda s, end: F.struct((end - s["size"]).alias("start"), end.alias("end"), s["tested"].alias("tested")),
            )
            kept = F.filter(every, lambda s: s["tested"] >= rule.least)
            return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).cast(_SPAN)

        return let(sizes, placed)

    matches = let(
        F.regexp_extract_all(text, pattern, 0),
        lambda found: let(
            F.regexp_extract_all(text, pattern, rule.group) if rule.group else found,
            lambda tested: let(F.split(text, rule.pattern, -1), lambda gaps: walk(found, tested, gaps)),
        ),
    )
    return F.when(text.rlike(rule.pattern), matches).otherwise(F.array().cast(_SPAN))


def find_secrets(df: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """All rows and columns of ``df`` with ``secrets``: structs of ``start``,
    ``order``, ``end`` and ``kind``, by start and then by the rules' order.

    Rules with mandatory trigrams read only the texts that the index names;
    the others read every text. Keys need not be unique or known: all rows of
    a key are candidates together, and each is verified by its own text. Null
    and empty texts have no spans, an empty table stays empty, and an input
    column named ``secrets`` gives way.
    """
    df = without(df, "secrets")
    spark = df.sparkSession
    queries = _queries(rules)
    here, asked = fresh(df, "_key", "_rules")
    rows = df
    if queries:
        shared_dir(spark)
        trigrams = sorted({t for q in queries.values() for c in q for t in c})
        named = candidates(inverted_index(df, key, text, trigrams), queries).checkpoint()
        few = named.count() <= BROADCAST_ROWS
        named = named.select(F.col("_key").alias(here), F.col("_rules").alias(asked))
        rows = rows.withColumn(here, _key(key)).join(F.broadcast(named) if few else named, here, "left").drop(here)

    def found(order: int, rule: Rule) -> Column:
        spans = _spans(text_of(text), rule)
        if rule.name in queries:
            spans = F.when(F.array_contains(col(asked), rule.name), spans).otherwise(F.array().cast(_SPAN))
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(rule.name).alias("kind")
            ),
        )

    every = F.sort_array(F.flatten(F.array(*(found(i, r) for i, r in enumerate(rules)))))
    return rows.withColumn("secrets", every).drop(*([asked] if queries else []))


def listed_spans(secrets: Column, kinds: Sequence[str] | None = None) -> Column:
    """``kind:start:end`` of the spans, comma-joined; of some kinds only, if they are given."""
    kept = secrets if kinds is None else F.filter(secrets, lambda s: s["kind"].isin(list(kinds)))
    parts = F.transform(
        kept, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def count_of(secrets: Column, kind: str) -> Column:
    return F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, secrets: Column, mask: str = "[secret]") -> Column:
    """The text with each span, or run of overlapping spans, behind a mask.
    A null text stays null."""

    def hidden(secrets: Column) -> Column:
        covered = scan(secrets, F.lit(0).cast("bigint"), lambda at, s: F.greatest(at, s["end"]))

        def runs(covered: Column) -> Column:
            # What stands between the masks: before a span that begins beyond all earlier ones, and the rest.
            before = F.transform(
                secrets,
                lambda s, i: F.struct(
                    F.coalesce(F.get(covered, i - 1), F.lit(0)).cast("bigint").alias("start"), s["start"].alias("end")
                ),
            )
            rest = F.struct(F.element_at(covered, -1).alias("start"), F.length(text).cast("bigint").alias("end"))
            return F.concat(F.filter(before, lambda r: r["end"] >= r["start"]), F.array(rest))

        return let(let(covered, runs), lambda kept: _joined(text, kept, mask))

    return F.when(F.size(secrets) > 0, let(secrets, hidden)).otherwise(text)


def _joined(text: Column, runs: Column, mask: str) -> Column:
    """Runs of the text with masks in between. A block of runs is cut out of
    its own part, so the text isn't walked from its start for each of them."""

    def block(at: Column) -> Column:
        part = F.slice(runs, at + 1, BLOCK)

        def cut(part: Column) -> Column:
            first, last = part[0]["start"], F.element_at(part, -1)["end"]
            here = F.substr(text, (first + 1).cast("int"), (last - first).cast("int"))
            return let(
                here,
                lambda own: F.array_join(
                    F.transform(
                        part,
                        lambda r: F.substr(own, (r["start"] - first + 1).cast("int"), (r["end"] - r["start"]).cast("int")),
                    ),
                    mask,
                ),
            )

        return let(part, cut)

    return F.array_join(F.transform(blocks_of(runs), block), mask)
