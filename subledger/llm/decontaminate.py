"""Benchmark decontamination: winnowed fingerprints are joined and hits extended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subledger.llm.columns import col, fresh, indices, let, n_words, text_of, without, words
from subledger.session import shared_dir

#: Words that count as a passage.
PASSAGE = 10
#: Words in a fingerprinted gram. With windows of PASSAGE - GRAM + 1 grams every
#: shared passage has a fingerprint that both sides keep.
GRAM = 5
# What may be sent to every executor: items of two million words with their
# fingerprints are under 60 MB, and so many seeds under 20 MB. Larger sides
# are joined by shuffle.
BROADCAST_WORDS = 2_000_000
BROADCAST_SEEDS = 200_000

_PRINT = "array<struct<h:bigint,at:int>>"


def _grams(w: Column, size: int) -> Column:
    """Hash and position of every run of ``size`` words."""
    return F.transform(
        indices(F.size(w) - (size - 1)),
        lambda i: F.struct(F.xxhash64(F.lit(size), F.slice(w, i + 1, size)).alias("h"), i.cast("int").alias("at")),
    )


def winnow(w: Column, passage: int = PASSAGE, gram: int = GRAM) -> Column:
    """The leftmost least gram of every window of ``passage - gram + 1`` grams.

    The leftmost least gram moves only forward, so the same gram taken by
    several windows stands in neighbouring places. A text shorter than a
    passage has none.
    """
    window = passage - gram + 1

    def of(grams: Column) -> Column:
        least = F.transform(indices(F.size(grams) - (window - 1)), lambda j: F.array_min(F.slice(grams, j + 1, window)))
        return let(
            least,
            lambda rows: F.filter(rows, lambda r, i: (i == 0) | (r["at"] != F.get(rows, i - 1)["at"])),
        )

    return let(_grams(w, gram), of).cast(_PRINT)


def _near(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    rows = benchmark.select(col(item).cast("string").alias("_id"), words(text_of(text)).alias("_words"))
    rows = rows.where(F.size("_words") > 0)
    return rows.withColumn("_item", F.md5(F.array_join("_words", " ")))


def _seeds(texts: DataFrame, items: DataFrame, small: bool, passage: int, gram: int) -> DataFrame:
    """Distinct ``(_key, _item, _n, _shift)``: a text and an item of n words
    share a fingerprint, the text's word i + shift being the item's word i.

    Items shorter than a passage are one gram; texts give their grams of the
    few lengths that such items have.
    """
    short = [r[0] for r in items.select(F.size("_words").alias("n")).where(F.col("n") < passage).distinct().collect()]
    whole = F.array().cast(_PRINT)
    for size in sorted(short):
        whole = F.when(F.size("_words") == size, _grams(F.col("_words"), size)).otherwise(whole)
    of_item = F.when(F.size("_words") >= passage, winnow(F.col("_words"), passage, gram)).otherwise(whole)
    item_prints = items.dropDuplicates(["_item"]).select("_item", F.size("_words").alias("_n"), F.explode(of_item).alias("_p"))
    item_prints = item_prints.select("_item", "_n", F.col("_p.h").alias("_h"), F.col("_p.at").alias("_i"))
    of_text = F.concat(winnow(F.col("_words"), passage, gram), *(_grams(F.col("_words"), n) for n in sorted(short)))
    prints = texts.select("_key", words(F.col("_text")).alias("_words")).select("_key", F.explode(of_text).alias("_p"))
    prints = prints.select("_key", F.col("_p.h").alias("_h"), F.col("_p.at").alias("_d"))
    met = prints.join(_near(item_prints, small), "_h")
    return met.select("_key", "_item", "_n", (F.col("_d") - F.col("_i")).alias("_shift")).distinct()


def _hits(texts: DataFrame, items: DataFrame, seeds: DataFrame, few: bool, small: bool, passage: int) -> DataFrame:
    """``(_key, _item, _at)``: places of the text's words inside an item's windows.

    The words of text and item are laid against each other as the seed says,
    and every run of equal words that is long enough is a hit. Texts without a
    seed are not split into words again, and a seed takes along the words that
    lie against its item, not the whole text.
    """
    shifts = seeds.groupBy("_key").agg(F.collect_set(F.struct("_item", "_n", "_shift")).alias("_laid"))

    def against(w: Column) -> Column:
        def part(seed: Column) -> Column:
            first = F.greatest(F.lit(0), seed["_shift"])
            skip = F.greatest(F.lit(0), -seed["_shift"])
            length = F.greatest(F.lit(0), F.least(F.size(w) - first, seed["_n"] - skip))
            return F.struct(
                seed["_item"].alias("_item"),
                first.alias("_from"),
                skip.alias("_skip"),
                F.slice(w, first + 1, length).alias("_ours"),
            )

        return F.transform("_laid", part)

    laid = texts.join(_near(shifts, few), "_key")
    laid = laid.select("_key", F.explode(let(words(F.col("_text")), against)).alias("_l")).select("_key", "_l.*")
    whole = items.dropDuplicates(["_item"]).select("_item", F.col("_words").alias("_theirs"))
    laid = laid.join(_near(whole, small), "_item")
    theirs = F.slice("_theirs", F.col("_skip") + 1, F.size("_ours"))
    same = F.zip_with("_ours", theirs, lambda a, b: a == b)
    window = F.least(F.lit(passage), F.size("_theirs"))

    def inside(equal: Column) -> Column:
        starts = F.filter(
            indices(F.size(equal) - window + 1),
            lambda j: F.forall(F.slice(equal, j + 1, window), lambda e: e),
        )
        return F.array_distinct(F.flatten(F.transform(starts, lambda j: F.sequence(j, j + window - 1))))

    found = laid.select("_key", "_item", "_from", F.explode(let(same, inside)).alias("_in"))
    return found.select("_key", "_item", (F.col("_from") + F.col("_in")).alias("_at"))


def find_contamination(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    passage: int = PASSAGE,
    gram: int = GRAM,
) -> DataFrame:
    """All rows and columns of ``df`` with ``n_words``, ``n_hit`` (words inside
    an occurrence of a window of ``passage`` consecutive item words), ``items``
    (ids of the items found, as sorted strings) and ``contaminated``.

    An item shorter than a passage is one window, one without words none. What
    a row gets depends on its text alone, so copies agree and rows need no key.
    Null and empty texts have no words and no hits; an empty benchmark finds
    nothing; items with a null id hit words but aren't listed; items that share
    an id are listed once. Input columns named as outputs give way.
    """
    if not 1 <= gram <= passage:
        raise ValueError("a gram has at least one word and at most a passage")
    df = without(df, "n_words", "n_hit", "items", "contaminated")
    shared_dir(df.sparkSession)
    (key,) = fresh(df, "_key")
    identity = F.md5(text_of(text))
    items = _items(benchmark, item, item_text).checkpoint()
    small = (items.agg(F.sum(F.size("_words"))).first()[0] or 0) <= BROADCAST_WORDS
    texts = df.select(identity.alias("_key"), text_of(text).alias("_text"))
    seeds = _seeds(texts, items, small, passage, gram).checkpoint()
    few = seeds.count() <= BROADCAST_SEEDS
    hits = _hits(texts, items, seeds, few, small, passage).distinct().checkpoint()
    counts = hits.select("_key", "_at").distinct().groupBy("_key").agg(F.count(F.lit(1)).alias("n_hit"))
    ids = hits.select("_key", "_item").distinct().join(_near(items.select("_item", "_id"), small), "_item")
    listed = ids.groupBy("_key").agg(F.sort_array(F.collect_set("_id")).alias("items"))
    found = counts.join(listed, "_key").withColumnRenamed("_key", key)
    rows = df.withColumn(key, identity).join(_near(found, few), key, "left").drop(key)
    rows = rows.withColumns({
        "n_words": n_words(text_of(text)).cast("long"),
        "n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"),
        "items": F.coalesce("items", F.array().cast("array<string>")),
    })
    return rows.withColumn("contaminated", F.col("n_hit") > 0)
