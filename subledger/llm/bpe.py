"""Byte-level BPE: encoding by longest matches with backtracking, and decoding.

Two tokens may stand side by side only if merging their bytes alone gives the
two of them back. A sequence of which all neighbours may is the result of the
merges, and each prefix of a piece has one such sequence. So the encoder takes
the longest token at each place, goes back where no token may follow, and
never tries a place twice: linear time, without running the merges on texts.
"""

from __future__ import annotations

import base64
import json
import os
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from subledger.llm.columns import col, text_of, without

# Bytes of the texts that one result batch comes from; bounds the memory of a task.
BATCH_BYTES = 1 << 20
# Entries that a worker remembers of pieces and of neighbours each.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 60  # characters: under 256 tokens


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in tokenizer files: printable Latin-1
    characters for themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens and merges of a rank file or a tokenizer file, ready for use in a worker."""

    def __init__(self, raw: bytes, kind: str):
        from ahocorasick import Automaton

        self.specials: dict[str, int] = {}
        if kind == "tiktoken":
            lines = (line.split() for line in raw.splitlines() if line.strip())
            self.ids = {base64.b64decode(token).decode("latin-1"): int(rank) for token, rank in lines}
            self.merges = None  # any two tokens that make up a third
        elif kind == "json":
            self._read_json(json.loads(raw))
        else:
            raise ValueError(f"a vocabulary is a .tiktoken or a .json file, not .{kind}")
        self.tokens = {i: token for token, i in self.ids.items()}
        self.automaton = Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, (i, len(token)))
        if missing := [b for b in range(256) if chr(b) not in self.ids]:
            raise ValueError(f"the vocabulary lacks the bytes {missing}")
        self.automaton.make_automaton()
        # Matches are looked for in a stretch of a long piece, as each search costs what its text measures.
        self.reach = max(map(len, self.ids))
        self.stretch = 16 * self.reach
        self._beside: dict[tuple[int, int], bool] = {}
        self._halves: dict[int, tuple[int, int, int] | None] = {}
        self._shorter: dict[int, tuple[int, int] | None] = {}

    def _read_json(self, file: dict) -> None:
        model, letters = file["model"], _byte_letters()
        if model["type"] != "BPE" or model.get("ignore_merges") or file.get("normalizer"):
            raise ValueError("only plain byte-level BPE is read")
        latin = {c: chr(b) for c, b in letters.items()}
        self.specials = {t["content"]: t["id"] for t in file["added_tokens"] if t["special"]}
        self.ids = {"".join(latin[c] for c in t): i for t, i in model["vocab"].items() if t not in self.specials}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {tuple("".join(latin[c] for c in side) for side in pair): i for i, pair in enumerate(pairs)}

    def _merge_of(self, left: str, right: str) -> int | None:
        return self.ids.get(left + right) if self.merges is None else self.merges.get((left, right))

    def _made_of(self, token: int) -> tuple[int, int, int] | None:
        """The two tokens that the last merge of a token joins, and that merge's
        rank; bytes have rank -1, and a token that no merges lead to gives None."""
        if token not in self._halves:
            parts, rank, pair = list(self.tokens[token]), -1, (-1, -1)
            while len(parts) > 1:
                ranks = [self._merge_of(a, b) for a, b in zip(parts, parts[1:])]
                found = [(r, i) for i, r in enumerate(ranks) if r is not None]
                if not found:
                    break
                rank, i = min(found)
                pair = (self.ids[parts[i]], self.ids[parts[i + 1]])
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._halves[token] = (*pair, rank) if len(parts) == 1 else None
        return self._halves[token]

    def _fits(self, left: int, right: int) -> bool:
        """Whether no merge across the border comes before those that made the two.

        Looks at the border back in time: undoes the later of the two merges
        next to it, and asks whether the tokens that then meet would have been
        joined earlier. Of equal merges, the one further left comes first.
        """
        a, b = self._made_of(left) if left >= 0 else (-1, -1, -1), self._made_of(right)
        if a is None or b is None:
            return False
        if left < 0:
            return True
        until = None
        while True:
            rank = self._merge_of(self.tokens[left], self.tokens[right])
            if rank is not None and (until is None or rank < until):
                return False
            if a[2] < 0 and b[2] < 0:
                return True
            if a[2] > b[2]:
                left, until = a[1], a[2]
                a = self._made_of(left)
            else:
                right, until = b[0], b[2] + 0.5
                b = self._made_of(right)

    def beside(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``; -1 on the left is the start of a piece."""
        known = self._beside.get((left, right))
        if known is None:
            if len(self._beside) >= REMEMBERED:
                self._beside.clear()
            known = self._beside[left, right] = self._fits(left, right)
        return known

    def shorter(self, token: int) -> tuple[int, int] | None:
        """The longest token that starts this one, and its length; none for a byte."""
        if token not in self._shorter:
            text, ids = self.tokens[token], self.ids
            lengths = (n for n in range(len(text) - 1, 0, -1) if text[:n] in ids)
            self._shorter[token] = next(((ids[text[:n]], n) for n in lengths), None)
        return self._shorter[token]

    def encode(self, piece: str) -> list[int]:
        """Ids of one piece, given as its UTF-8 bytes in Latin-1."""
        if self.merges is None and piece in self.ids:
            return [self.ids[piece]]
        size, known, matches = len(piece), self._beside, self.automaton.iter_long
        out: list[int] = []
        lengths: list[int] = []
        closed = set()  # places from which the end can't be reached
        at, last = 0, -1
        longest, sure = None, 0  # matches one after another, and up to where the longest token is in sight
        match = None

        def search(place: int) -> None:
            nonlocal longest, sure, match
            longest = matches(piece[place : place + self.stretch])
            sure = size if place + self.stretch >= size else place + self.stretch - self.reach
            match = next(longest)[1]  # each byte is a token

        if size:
            search(0)
        while at < size:
            first = match
            while match is not None:
                token, length = match
                if at + length not in closed:
                    fits = known.get((last, token))
                    if self.beside(last, token) if fits is None else fits:
                        break
                match = self.shorter(token)
            if match is None:
                if not out:
                    raise ValueError("no sequence of tokens fits")
                closed.add(at)
                at -= lengths.pop()
                match, longest = self.shorter(out.pop()), None
                last = out[-1] if out else -1
                continue
            out.append(token)
            lengths.append(length)
            at, last = at + length, token
            if at < size:
                if match is not first or longest is None or at > sure:
                    search(at)
                else:
                    match = next(longest)[1]
        return out

    def prefix_counts(self, piece: str) -> list[int]:
        """Tokens of every prefix of one piece, in bytes, from the empty one on."""
        size, known, beside = len(piece), self._beside, self.beside
        last, counts = [-1] + [None] * size, [0] * (size + 1)
        done = 0  # of the matches with one end only one fits: the others are passed over
        for end, (token, length) in self.automaton.iter(piece):
            if end < done:
                continue
            at = end + 1 - length
            before = last[at]
            fits = known.get((before, token))
            if beside(before, token) if fits is None else fits:
                done = end + 1
                last[done], counts[done] = token, counts[at] + 1
        if None in last:
            raise ValueError("no sequence of tokens fits")
        if self.merges is None:
            counts = [1 if n and piece[:n] in self.ids else c for n, c in enumerate(counts)]
        return counts


class Remembered(dict):
    """Results of a function of short texts, in two generations: when the newer
    one is full, the older one goes, and what is asked for again moves over."""

    def __init__(self, function: Callable, most: int = REMEMBERED):
        super().__init__()
        self.function, self.most, self.older = function, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


_loaded: dict[tuple, object] = {}


def once(key: tuple, make: Callable[[], object]):
    """What a worker builds once and uses for all its batches."""
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = make()
    return _loaded[key]


class Coder:
    """Encodes and decodes columns of a batch."""

    def __init__(self, source: tuple[bytes, str], pattern: str | None = None):
        import regex

        vocabulary = Vocabulary(*source)
        self.matcher = regex.compile(pattern) if pattern is not None else None
        self.pieces = Remembered(lambda p: array("i", vocabulary.encode(latin(p))).tobytes())
        tokens = vocabulary.tokens
        self.place = np.full(max(tokens) + 1, -1)
        self.place[list(tokens)] = np.arange(len(tokens))
        self.tokens = pa.array([t.encode("latin-1") for t in tokens.values()], pa.binary())

    def encoded(self, texts: pa.Array) -> pa.ListArray:
        pieces, matches = self.pieces, self.matcher.findall
        return lists_of([b"".join([pieces[p] for p in matches(t)]) for t in texts.to_pylist()])

    def decoded(self, rows: pa.ListArray) -> pa.Array:
        ids = rows.flatten().to_numpy(zero_copy_only=False)
        if not len(ids):
            return pc.if_else(rows.is_valid(), pa.scalar(b"", pa.binary()), pa.scalar(None, pa.binary()))
        if ids.min() < 0 or ids.max() >= len(self.place) or self.place[ids].min() < 0:
            raise ValueError("an id that the vocabulary lacks")
        # The tokens one after another are the rows one after another.
        pieces = self.tokens.take(pa.array(self.place[ids]))
        at = np.frombuffer(pieces.buffers()[1], np.int32, len(ids) + 1)
        counts = pc.fill_null(pc.list_value_length(rows), 0).to_numpy()
        ends = at[np.concatenate(([0], np.cumsum(counts)))].astype(np.int32)
        found = pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pieces.buffers()[2]])
        return pc.if_else(rows.is_valid(), found, pa.scalar(None, pa.binary()))


def read_vocabulary(path: str) -> tuple[bytes, str]:
    """Contents and kind of a vocabulary file, read on the driver and sent to the tasks."""
    with open(path, "rb") as file:
        return file.read(), os.path.splitext(path)[1].lstrip(".")


def latin(piece: str) -> str:
    return piece.encode("utf-8").decode("latin-1")


def small_batches(
    batches: Iterator[pa.RecordBatch], size_of: Callable, most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``most``, a row at least."""
    for batch in batches:
        start, held = 0, 0
        for i, size in enumerate(size_of(batch)):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size or 1
        if batch.num_rows > start:
            yield batch.slice(start)


def with_column(
    df: DataFrame, name: str, kind: T.DataType, inputs: Column, function: Callable, keep: Sequence[str] | None
) -> DataFrame:
    """Columns of ``df``, or those in ``keep``, and one that ``function`` makes of batches.

    ``inputs`` is the batch's last column, which the new one replaces; what
    isn't kept isn't sent back, and a column that is both is sent once more.
    """
    kept = without(df, name).columns if keep is None else [c for c in keep if c.lower() != name.lower()]
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, kind)])
    return df.select(*(col(c) for c in kept), inputs.alias(name)).mapInArrow(function, schema)


def replace_last(batch: pa.RecordBatch, values: pa.Array) -> pa.RecordBatch:
    columns = [*batch.columns[:-1], values]
    return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def lists_of(rows: list[bytes]) -> pa.ListArray:
    """Lists of the 32-bit numbers that each row's bytes hold."""
    offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def text_sizes(batch: pa.RecordBatch) -> list[int]:
    return pc.binary_length(batch.columns[-1]).to_pylist()


def _list_sizes(batch: pa.RecordBatch) -> list[int]:
    return (4 * pc.fill_null(pc.list_value_length(batch.columns[-1]), 0).to_numpy()).tolist()


def encode(
    df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep: Sequence[str] | None = None
) -> DataFrame:
    """All rows of ``df``, and its columns or those in ``keep``, with the token
    ids of each whole text.

    Each match of ``pattern`` is encoded apart, without special tokens. Null
    and empty texts have no ids; what the pattern doesn't match is left out.
    Each row stands alone, so repeated rows get equal ids; an input column
    named as the output gives way.
    """
    source = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = once(("coder", path, pattern), lambda: Coder(source.value, pattern))
        for batch in small_batches(batches, text_sizes):
            yield replace_last(batch, coder.encoded(batch.columns[-1]))

    return with_column(df, ids, T.ArrayType(T.IntegerType()), text_of(text), run, keep)


def decode(
    df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded", keep: Sequence[str] | None = None
) -> DataFrame:
    """All rows of ``df``, and its columns or those in ``keep``, with the bytes
    that the ids stand for.

    Null ids give null, no ids no bytes, and an id that the vocabulary lacks
    is an error. An input column named as the output gives way.
    """
    source = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = once(("coder", path, None), lambda: Coder(source.value))
        for batch in small_batches(batches, _list_sizes):
            yield replace_last(batch, coder.decoded(batch.columns[-1]))

    return with_column(df, decoded, T.BinaryType(), col(ids).cast("array<int>"), run, keep)


def round_trip(
    df: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """What :func:`encode` and then :func:`decode` give, by one worker a task."""
    source = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = once(("coder", path, pattern), lambda: Coder(source.value, pattern))
        for batch in small_batches(batches, text_sizes):
            found = coder.encoded(batch.columns[-1])
            columns = [*batch.columns[:-1], found, coder.decoded(found)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], ids, decoded])

    kept = without(df, ids, decoded).columns if keep is None else list(keep)
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(ids, T.ArrayType(T.IntegerType()))])
    schema = schema.add(decoded, T.BinaryType())
    return df.select(*(col(c) for c in kept), text_of(text).alias(ids)).mapInArrow(run, schema)
