"""Token counts: the exact count of every prefix, by dynamic programming.

The encoding of each prefix of a piece ends in one token, and it is the one
that may follow the encoding of what is left. So one pass over the matches of
a piece gives the counts of all its prefixes. Questions on budgets and cuts
are then answered from the counts, without encoding again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.llm import bpe
from subledger.llm.columns import text_of

#: The pieces of byte-level pre-tokenization.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Letters of Latin scripts, and the same pieces for texts of these, ASCII digits
#: and marks alone, which the plainer engine finds in half the time.
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
LATIN_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LATIN}]+| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+"
NOT_LATIN = rf"[^\x00-\x1b\x20-\x7e{LATIN}]"
#: Endings of two letters: a text cut after the first letter has two pieces there.
CUT_IN_TWO = ("'re", "'ve", "'ll")


class PrefixCounter:
    """Counts of all prefixes of texts, in code points."""

    def __init__(self, vocabulary: bpe.Vocabulary):
        import regex

        self.vocabulary = vocabulary
        self.matcher, self.latin, self.other = regex.compile(PATTERN), re.compile(LATIN_PATTERN), re.compile(NOT_LATIN)
        self.runs = regex.compile(r"\s\s+(?=\S)")
        self.pieces = bpe.Remembered(self._piece)

    def _prefixes(self, piece: str) -> list[int]:
        """Counts of the prefixes of one piece, from its first character on."""
        if piece.isascii():
            counts = self.vocabulary.prefix_counts(piece)
            del counts[0]
        else:
            in_bytes = self.vocabulary.prefix_counts(bpe.latin(piece))
            counts, end = [], 0
            for c in piece:
                end += 1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4
                counts.append(in_bytes[end])
        if piece in CUT_IN_TWO:
            counts[1] = sum(self.pieces[c][-1] for c in piece[:2])
        return counts

    def _piece(self, piece: str) -> bytes:
        """The same in a byte each, or in four each if the piece is a long one."""
        counts = self._prefixes(piece)
        return bytes(counts) if len(piece) <= bpe.LONGEST_REMEMBERED else np.array(counts, np.int32).tobytes()

    def _plain(self, text: str) -> np.ndarray:
        """Counts of the prefixes of a text without special tokens."""
        names = (self.matcher if self.other.search(text) else self.latin).findall(text)
        out = np.zeros(len(text) + 1, np.int32)
        if not names:
            return out
        lengths = np.fromiter(map(len, names), np.int64, len(names))
        found = list(map(self.pieces.__getitem__, names))
        if lengths.max() <= bpe.LONGEST_REMEMBERED:
            inner = np.frombuffer(b"".join(found), np.uint8)
        else:
            kinds = [np.uint8 if n <= bpe.LONGEST_REMEMBERED else np.int32 for n in lengths]
            inner = np.concatenate([np.frombuffer(x, k) for x, k in zip(found, kinds, strict=True)])
        totals = inner[np.cumsum(lengths) - 1].astype(np.int32)
        starts = np.cumsum(totals, dtype=np.int32) - totals
        np.add(inner, np.repeat(starts, lengths), out=out[1:], casting="unsafe")
        # Cut after its last space, a run of spaces is one piece; before a word it is two.
        for run in self.runs.finditer(text):
            start, stop = run.span()
            out[stop] = out[start] + self._prefixes(run[0])[-1]
        return out

    def counts(self, text: str) -> np.ndarray:
        """Tokens of ``text[:i]`` for i from 0 to the text's length."""
        cuts: list[tuple[int, str]] = []
        at = 0
        while self.vocabulary.specials:
            found = [(i, -len(s), s) for s in self.vocabulary.specials if (i := text.find(s, at)) >= 0]
            if not found:
                break
            i, _, special = min(found)
            cuts.append((i, special))
            at = i + len(special)
        parts, start, base = [np.zeros(1, np.int32)], 0, 0
        for i, special in cuts:
            # Cut within the special token, its characters are ordinary ones.
            inner = self._plain(text[start : i + len(special) - 1])
            parts.append(base + inner[1:])
            base += int(inner[i - start]) + 1
            parts.append(np.array([base], np.int32))
            start = i + len(special)
        parts.append(base + self._plain(text[start:])[1:])
        return np.concatenate(parts).astype(np.int32)


def prefix_counts(
    df: DataFrame, path: str, text: str = "text", counts: str = "prefix_tokens", keep: Sequence[str] | None = None
) -> DataFrame:
    """All rows of ``df``, and its columns or those in ``keep``, with an array of
    the exact token counts of every prefix of each whole text, in code points:
    element i (from 0) is the count of the first i characters, the last one
    that of the text.

    Null and empty texts have the one count 0. The strings of special tokens
    count as one token each, as the library has it by default; a text cut
    inside of one has ordinary tokens there. Repeated rows get equal counts;
    an input column named as the output gives way.
    """
    source = df.sparkSession.sparkContext.broadcast(bpe.read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = bpe.once(("counts", path), lambda: PrefixCounter(bpe.Vocabulary(*source.value)))

        for batch in bpe.small_batches(batches, bpe.text_sizes):
            rows = [counter.counts(t) for t in batch.columns[-1].to_pylist()]
            offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
            values = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32))
            yield bpe.replace_last(batch, pa.ListArray.from_arrays(pa.array(offsets), values))

    return bpe.with_column(df, counts, T.ArrayType(T.IntegerType()), text_of(text), run, keep)


def tokens_of(counts: Column, characters: Column | None = None) -> Column:
    """Tokens of the first characters of a text, or of all of it."""
    found = F.element_at(counts, -1) if characters is None else F.get(counts, F.least(characters, F.size(counts) - 1))
    return found.cast("long")


def longest_within(counts: Column, budget: int) -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    whole = F.size(counts) - 1
    fitting = F.array_max(F.transform(counts, lambda c, i: F.when(c <= budget, i)))
    return F.when(F.element_at(counts, -1) <= budget, whole).otherwise(fitting).cast("long")


def budget_of(counts: Column, budgets: Sequence[int]) -> Column:
    """The smallest of the budgets that the whole text keeps to; null if none."""
    out = F.lit(None).cast("int")
    for budget in sorted(budgets, reverse=True):
        out = F.when(F.element_at(counts, -1) <= budget, F.lit(budget)).otherwise(out)
    return out
