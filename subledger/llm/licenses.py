"""License scans: canonical digests of entire texts, looked up by a hash join."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.llm.columns import col, fresh, let, text_of, without

#: Spellings that license matching guidelines hold to be equal.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("licence", "license"),
    ("merchantibility", "merchantability"),
    ("modelling", "modeling"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("recognised", "recognized"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
)

_MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC = """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS
OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""

_TEXTS = Path(__file__).parent / "license_texts"

#: License texts, those of the folder by the files' names, and the short notices that stand for a license.
KNOWN = (
    ("MIT", _MIT),
    ("ISC", _ISC),
    *((path.stem, path.read_text("utf-8")) for path in sorted(_TEXTS.glob("*.txt"))),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)

# Known texts that may be sent to every executor, a digest and a name each: 20 MB.
BROADCAST_ROWS = 200_000


def _any_of(names: Sequence[str]) -> str:
    """A pattern of all these words, by first letter, so that most places fail at once."""
    rest: dict[str, list[str]] = {}
    for name in names:
        rest.setdefault(name[0], []).append(name[1:])
    return r"\b(?:" + "|".join(f"{first}(?:{'|'.join(more)})" for first, more in rest.items()) + r")\b"


#: What a copyright statement begins with, and the words that the text after one may begin with.
_PLACEHOLDER = r"(?:<[^>]*>|\[[^\]]*\])"
_MARK = rf"(?:copyright|\(c\)|©)\s*(?:(?:\(c\)|©)\s*)*(?:{_PLACEHOLDER}(?:\s*{_PLACEHOLDER})*|[0-9]{{4}})"
_GRANT = (
    r"((?:permission\s+(?:is|to)|redistribution\s+and|(?:licensed|released)\s+under|everyone\s+is\s+permitted"
    r"|this\s+(?:program|software|library|work|file|code|document|license)|all\s+rights\s+reserved)\b)"
)
#: A statement ends before the text that a license goes on with, however its lines break; else with its line.
STATEMENT = rf"{_MARK}(?:{_PLACEHOLDER}|[^<\[]){{0,200}}?{_GRANT}"
LINE_STATEMENT = rf"{_MARK}[^\n]*"
RESERVED = r"all\s+rights\s+reserved"
#: Names of short licenses that stand before their texts.
TITLE = r"^(?:the )?(?:mit|isc|expat|x11|(?:new |modified |simplified )?bsd(?: [0-4] clause)?) license (?:mit |isc )?"


def canonical(text: Column) -> Column:
    """Lower case, no copyright statements and titles, words only, equal spellings; may be empty.

    A statement is "copyright", "(c)" or © with a year or a placeholder after
    it; the word alone is part of a license's text. It ends where a license's
    text goes on, whatever its lines, or if that isn't near, with its line.
    """
    lower = F.lower(text)
    named = F.contains(lower, F.lit("copyright")) | F.contains(lower, F.lit("(c)")) | F.contains(lower, F.lit("©"))
    lines = F.regexp_replace(F.regexp_replace(lower, STATEMENT, " $1"), LINE_STATEMENT, " ")
    bare = F.when(named, lines).otherwise(lower)
    bare = F.when(F.contains(lower, F.lit("reserved")), F.regexp_replace(bare, RESERVED, " ")).otherwise(bare)

    def spelled(out: Column) -> Column:
        changed = out
        for theirs, ours in SPELLINGS:
            changed = F.regexp_replace(changed, rf"\b{theirs}\b", ours)
        return F.when(out.rlike(_any_of([s for s, _ in SPELLINGS])), changed).otherwise(out)

    return let(F.regexp_replace(F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " ")), TITLE, ""), spelled)


def digest(text: Column) -> Column:
    """Of the canonical text; null if nothing is left of it."""
    return let(canonical(text), lambda c: F.when(c != "", F.sha2(c, 256)))


def known_licenses(spark: SparkSession, texts: Sequence[tuple[str, str]] = KNOWN) -> DataFrame:
    return spark.createDataFrame(list(texts), "license string, text string")


def _lookup(known: DataFrame) -> DataFrame:
    """A row for each digest; of several names for one text, the least."""
    named = known.select(digest(text_of("text")).alias("_digest"), F.col("license").alias("_license"))
    return named.where("_digest IS NOT NULL").groupBy("_digest").agg(F.min("_license").alias("_license"))


def license_scan(df: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with ``text_digest``, ``license`` (of the
    entire text, null if it isn't a known one) and ``notices``: the sorted
    licenses that entire lines of the text name.

    ``known`` has columns ``license`` and ``text``. A text is known only as a
    whole; case, punctuation, white space, copyright statements, titles of
    short licenses and spelling don't matter. Of several names for one text
    the least counts. An empty table gives no rows, and input columns with the
    names of outputs give way. Null and empty texts have no digest and no license. Rows of one
    key that have the same text share their notices; keys may be null.
    """
    df = without(df, "text_digest", "license", "notices")
    here, same, lines = fresh(df, "_digest", "_same", "_lines")
    lookup = _lookup(known)
    if lookup.count() <= BROADCAST_ROWS:
        lookup = F.broadcast(lookup)
    identity = F.struct(col(key).cast("string").alias("k"), F.md5(text_of(text)).alias("t"))
    # Digests are made before the lines become rows: later ones would be made again to test them.
    lines_of = F.array_distinct(F.split(text_of(text), "\n"))
    noted = df.select(identity.alias(same), F.explode(F.transform(lines_of, digest)).alias("_digest"))
    noted = noted.join(lookup, "_digest").groupBy(col(same)).agg(F.sort_array(F.collect_set("_license")).alias(lines))
    rows = df.withColumns({"text_digest": digest(text_of(text)), same: identity})
    rows = rows.join(lookup.select(F.col("_digest").alias(here), F.col("_license").alias("license")), F.col("text_digest") == col(here), "left")
    rows = rows.join(noted, same, "left").drop(here, same)
    empty = F.array().cast("array<string>")
    return rows.withColumn("notices", F.coalesce(col(lines), empty)).drop(lines)
