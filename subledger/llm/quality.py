"""Quality rules: a threshold table compiled into one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.columns import SPACES, col, fresh, indices, let, pieces, text_of, without

# Frequent function words of the corpus' languages.
STOP_WORDS = (
    "the of and to in is that for it as was with on by at be this are or from "
    "der die und das den ein von mit ist zu im auf sich des für nicht "
    "le la les de et un une du en que qui dans pour par est au sur "
    "el los y se del una por con no las lo su"
).split()


@dataclass(frozen=True)
class Threshold:
    """A text fails if ``metric`` lies below ``least`` or above ``most``."""

    metric: str
    least: float | None = None
    most: float | None = None


#: The verdict of the method: every rule has to hold.
THRESHOLDS = (
    Threshold("mean_word_length", 2.0, 12.0),
    Threshold("symbols_per_word", most=0.1),
    Threshold("stop_word_ratio", least=0.05),
    Threshold("letter_word_ratio", least=0.7),
    Threshold("dup_line_ratio", most=0.5),
)

COUNTS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "n_lines": "long", "n_stop_words": "long", "n_letter_words": "long",
}


def _repeated(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Windows are compared by a 64-bit hash: for a text of a million words the
    chance of one wrong match is below one in ten million.
    """
    hashes = F.transform(
        indices(F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )

    def covered(hashed: Column) -> Column:
        ordered = F.sort_array(F.transform(hashed, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def count(rows: Column) -> Column:
            def same(j: Column, k: Column) -> Column:
                return F.coalesce(F.get(rows, j)["h"] == F.get(rows, k)["h"], F.lit(False))

            twice = F.filter(indices(F.size(rows)), lambda j: ((j > 0) & same(j, j - 1)) | same(j, j + 1))
            at = F.transform(twice, lambda j: F.get(rows, j)["i"])
            return F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))

        return F.when(F.size(F.array_distinct(hashed)) == F.size(hashed), F.lit(0)).otherwise(let(ordered, count))

    return let(hashes, covered)


def _counts(text: Column, stop_words: Sequence[str]) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of(words: Column, lines: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(list(stop_words)))).cast("long").alias("n_stop_words"),
            F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).cast("long").alias("n_letter_words"),
        )

    return let(pieces(text, SPACES), lambda w: let(lines, lambda x: of(w, x)))


def _ratio(part: Column, whole: Column) -> Column:
    """0 for a text without the whole."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def _metrics(c: Column) -> dict[str, Column]:
    n = c["n_words"]
    return {
        "mean_word_length": _ratio(c["word_chars"], n),
        "symbols_per_word": _ratio(c["n_symbols"], n),
        "stop_word_ratio": _ratio(c["n_stop_words"], n),
        "letter_word_ratio": _ratio(c["n_letter_words"], n),
        "dup_line_ratio": _ratio(c["n_dup_lines"], c["n_lines"]),
    }


def quality_rules(
    df: DataFrame,
    text: str = "text",
    thresholds: Sequence[Threshold] = THRESHOLDS,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """All rows and columns of ``df`` with the counts, ``base_failed``,
    ``failed_rules`` (comma-joined names, empty if none) and ``kept``.

    Words are runs of other characters than white space. A null, empty or
    blank text has no words: all counts are 0 and it fails. Each row is judged
    alone, so ties and repeated rows get equal verdicts, an empty table stays
    empty, and input columns with the name of an output give way to it. The
    base fails a text of fewer than 50 words, or one of which more than half
    the words lie in repeated 3-word windows.
    """
    outputs = [*COUNTS, "base_failed", "failed_rules", "kept"]
    (c,) = fresh(df, "_counts")
    counted = df.withColumn(c, _counts(text_of(text), stop_words))
    values = _metrics(col(c))

    def broken(rule: Threshold) -> Column:
        tests = [values[rule.metric] < rule.least] if rule.least is not None else []
        tests += [values[rule.metric] > rule.most] if rule.most is not None else []
        out = F.lit(False)
        for test in tests:
            out = out | test
        return F.when(out, F.lit(rule.metric))

    n, repeats = col(c)["n_words"], col(c)["n_repeat_words"]
    base = (n < 50) | (100 * repeats > 50 * n)
    reasons = F.concat_ws(",", *(broken(rule) for rule in thresholds)) if thresholds else F.lit("")
    keep = [col(x) for x in without(df, *outputs).columns]
    judged = counted.select(
        *keep, *(col(c)[k].alias(k) for k in COUNTS), base.alias("base_failed"), reasons.alias("failed_rules")
    )
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("failed_rules") == ""))
