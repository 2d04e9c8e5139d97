"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

Candidates of one label lie along a Hilbert curve, so that near vectors meet in
a block; a block is one Parquet row with the least and the greatest value of
every dimension. For an anchor, interval arithmetic on these gives bounds of
all inner products with the block. Only blocks of the wanted labels whose
bounds meet the anchor's window, and that may still beat the rows found so
far, are multiplied.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.columns import col
from subledger.llm.hnsw import in_slices, padded, plain_ids
from subledger.session import scratch_path

#: Rows of a block.
BLOCK_ROWS = 512
#: Bits of each dimension in the place on the curve.
BITS = 2
#: Vectors of one slice of anchors in bytes, which is sent to all tasks.
SLICE_BYTES = 16 << 20
#: Requests that are compared with a block at once.
TOGETHER = 512
NO_ID = np.iinfo(np.int64).max
LOW, HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
BLOCK = "label int, n_rows int, width int, ids binary, vectors binary, low binary, high binary"


def usable(vector: Column) -> Column:
    """Whether all components are finite numbers; an empty vector has none that isn't."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of rows of cells of ``bits`` bits, as big-endian bytes."""
    x = cells.astype(np.int64).T.copy()
    top = 1 << (bits - 1)
    # Undo the turns of the curve, from the coarsest cells to the finest.
    q = top
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(set_, p, swap)
            x[i] ^= swap
        q >>= 1
    # Gray code over all dimensions.
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = top
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    planes = [((x >> b) & 1).astype(np.uint8) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def build_blocks(
    df: DataFrame, key: str = "vec_id", vector: str = "vector", label: str = "label", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Blocks of all rows of ``df``, stored as one Parquet row each; vectors are arrays of long.

    Rows without a label or a vector, or with a null component, take no part; a
    shorter vector counts as zero beyond its end. Rows are dealt by ranges of
    label and place on the curve, equal places by id, so neither a frequent
    label nor a frequent vector lands in one task.
    """
    rows = df.select(
        col(label).cast("int").alias("label"), col(vector).alias("vector"), col(key).cast("long").alias("id")
    ).where("label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    size = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.abs(x.cast("double")))
    width, total, count = rows.agg(F.max(F.size("vector")), F.sum(size), F.sum(F.size("vector"))).first()
    width = width or 0
    scale = total / count if count else 0.0

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.searchsorted([-scale, 0.0, scale], padded(batch.column(1), width, np.int64).astype(np.float64), "right")
            place = hilbert(cells, BITS) if width and len(cells) else np.zeros((len(cells), 1), np.uint8)
            column = pa.array([p.tobytes() for p in place], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "place"])

    placed = rows.mapInArrow(places, "label int, vector array<long>, id long, place binary")
    # Equal rows are told apart, so that very many of them don't share a task.
    order = ["label", "place", "id", "row"]
    ranged = placed.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_label, ids, vectors = None, [], []

        def block() -> pa.RecordBatch:
            matrix = np.concatenate(vectors)
            given = np.concatenate(ids)
            reach = int(np.abs(matrix.astype(np.float64)).max()) if matrix.size else 0
            stored = matrix.astype(np.int16 if reach < 1 << 15 else np.int32 if reach < 1 << 31 else np.int64)
            row = {
                "label": held_label, "n_rows": len(given), "width": width, "ids": given.tobytes(), "vectors": stored.tobytes(),
                "low": matrix.min(axis=0).tobytes(), "high": matrix.max(axis=0).tobytes(),
            }
            names = ["label", "n_rows", "width", "ids", "vectors", "low", "high"]
            types = [pa.int32()] * 3 + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays([pa.array([row[n]], t) for n, t in zip(names, types, strict=True)], names)

        for batch in batches:
            labels = batch.column(0).to_numpy()
            matrix, given = padded(batch.column(1), width, np.int64), plain_ids(batch.column(2))
            at = 0
            while at < len(labels):
                if held_label is not None and (labels[at] != held_label or sum(map(len, ids)) == block_rows):
                    yield block()
                    ids, vectors = [], []
                held_label = int(labels[at])
                change = np.flatnonzero(labels[at:] != held_label)
                stop = min(at + block_rows - sum(map(len, ids)), at + int(change[0]) if len(change) else len(labels))
                ids.append(given[at:stop])
                vectors.append(matrix[at:stop])
                at = stop
        if ids:
            yield block()

    path = scratch_path(df.sparkSession, "blocks")
    packed = ranged.sortWithinPartitions(*order).select("label", "vector", "id").mapInArrow(pack, BLOCK)
    packed.withColumn("block", F.monotonically_increasing_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Number, label, ids, vectors and zone map of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            r = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
            size = len(r["vectors"]) // max(1, r["n_rows"] * r["width"])
            kind = {2: np.int16, 4: np.int32}.get(size, np.int64)
            vectors = np.frombuffer(r["vectors"], kind).reshape(r["n_rows"], r["width"])
            zone = np.frombuffer(r["low"], np.int64), np.frombuffer(r["high"], np.int64)
            yield r["block"], r["label"], np.frombuffer(r["ids"], np.int64), vectors, *zone


ANCHOR = "block long, place int, anchor_id long, label int, vector binary"


def anchor_rows(blocks: DataFrame, every: int) -> DataFrame:
    """Rows of the blocks whose id is divisible by ``every``, known by block and place in it."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, label, ids, vectors, _, _ in _blocks(batches):
            places = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
            if len(places):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(places), block)),
                        pa.array(places.astype(np.int32)),
                        pa.array(ids[places]),
                        pa.array(np.full(len(places), label, np.int32)),
                        pa.array([v.astype(np.int64).tobytes() for v in vectors[places]], pa.binary()),
                    ],
                    ["block", "place", "anchor_id", "label", "vector"],
                )

    return blocks.mapInArrow(pick, ANCHOR)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``; by floating point where that is exact."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if reach < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each vector with anything between ``low`` and ``high``.

    In floating point, and widened by more than its rounding.
    """
    a, low, high = vectors.astype(np.float64), low.astype(np.float64), high.astype(np.float64)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    slack = 1 + 1e-9 * (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)))
    return up @ low + down @ high - slack, up @ high + down @ low + slack


class Windows:
    """Requests for the best rows of a window of scores, and what they have found.

    A request asks for rows of its anchor's label or of all others, with scores
    from ``low`` to ``high``; greater scores come first, ties by smaller id.
    """

    def __init__(self, anchors: dict[str, np.ndarray], anchor: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int):
        self.anchors, self.anchor, self.low, self.high, self.same, self.k = anchors, anchor, low, high, same, k
        self.scores = np.full((len(anchor), k), LOW)
        self.ids = np.full((len(anchor), k), NO_ID)
        self.full = np.zeros(len(anchor), bool)
        self.found = np.zeros(len(anchor), np.int64)
        self.read = self.skipped = 0

    def look(self, block: int, label: int, ids: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        a = self.anchors
        least, most = bounds(a["vector"], low, high)
        floor = np.where(self.full, np.maximum(self.low, self.scores[:, -1]), self.low)
        wanted = (a["label"][self.anchor] == label) == self.same
        meets = wanted & (most[self.anchor] >= floor) & (least[self.anchor] <= self.high)
        asked = np.flatnonzero(meets)
        self.read += len(asked)
        self.skipped += len(wanted) - len(asked)
        for at in range(0, len(asked), TOGETHER):
            self._compare(asked[at : at + TOGETHER], floor, block, ids, vectors)

    def _compare(self, asked: np.ndarray, floor: np.ndarray, block: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        a = self.anchors
        own, row = np.unique(self.anchor[asked], return_inverse=True)
        scores = products(a["vector"][own], vectors)[row]
        fits = (scores >= floor[asked][:, None]) & (scores <= self.high[asked][:, None])
        if self.same:
            mine = np.flatnonzero(a["block"][self.anchor[asked]] == block)
            fits[mine, a["place"][self.anchor[asked[mine]]]] = False
        if len(ids) > self.k:
            # Rows that k others of the block beat can't be among the best.
            shown = np.where(fits, scores, LOW)
            least = np.partition(shown, len(ids) - self.k, axis=1)[:, len(ids) - self.k]
            fits &= scores >= least[:, None]
        request, place = np.nonzero(fits)
        if not len(request):
            return
        touched = asked[np.unique(request)]
        held = np.arange(self.k) < self.found[touched][:, None]
        old_request, old_rank = np.nonzero(held)
        request = np.concatenate((asked[request], touched[old_request]))
        found = np.concatenate((scores[fits], self.scores[touched][held]))
        named = np.concatenate((ids[place], self.ids[touched][held]))
        order = np.lexsort((named, -found, request))
        request, found, named = request[order], found[order], named[order]
        rank = np.arange(len(request)) - np.searchsorted(request, request)
        best = rank < self.k
        self.scores[request[best], rank[best]] = found[best]
        self.ids[request[best], rank[best]] = named[best]
        np.maximum.at(self.found, request[best], rank[best] + 1)
        self.full = self.found == self.k


FOUND = "block long, place int, anchor_id long, asked int, score long, id long"


def search_slice(
    blocks: DataFrame, anchors: dict[str, np.ndarray], requests: dict[str, np.ndarray], same: bool, k: int
) -> tuple[DataFrame, Broadcast]:
    """Each task's best rows for all requests of a slice, over the blocks it reads, and the slice as sent.

    Vectors of a slice are bounded by :data:`SLICE_BYTES`, and its requests by a
    few for each, so they may be sent to all tasks.
    """
    sent = blocks.sparkSession.sparkContext.broadcast((anchors, requests))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, r = sent.value
        if not len(r["anchor"]):
            return
        windows = Windows(a, r["anchor"], r["low"], r["high"], same, k)
        for found in _blocks(batches):
            windows.look(*found)
        request, rank = np.nonzero(np.arange(k) < windows.found[:, None])
        anchor = r["anchor"][request]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(a["block"][anchor]), pa.array(a["place"][anchor]), pa.array(a["anchor_id"][anchor]),
                pa.array(r["asked"][request]), pa.array(windows.scores[request, rank]), pa.array(windows.ids[request, rank]),
            ],
            ["block", "place", "anchor_id", "asked", "score", "id"],
        )

    return blocks.mapInArrow(run, FOUND), sent


def _numpy(rows: pa.Table) -> dict[str, np.ndarray]:
    out = {c: rows.column(c).to_numpy() for c in rows.column_names if c != "vector"}
    if "vector" in rows.column_names:
        raw = rows.column("vector").to_pylist()
        width = len(raw[0]) // 8 if raw else 0
        out["vector"] = np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), width)
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    own = Window.partitionBy("block", "place", "asked").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def hard_negatives(
    df: DataFrame, every: int, positives: int, negatives: int, low: int, high: int,
    key: str = "vec_id", vector: str = "vector", label: str = "label",
    block_rows: int = BLOCK_ROWS, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Hard negatives of every anchor, the rows whose id is divisible by ``every``.

    An anchor's positives are the ``positives`` other rows of its label with the
    greatest inner products; for each of them, the first ``negatives`` rows of
    other labels whose score is from ``low`` to ``high`` hundredths of the
    positive's. Vectors are arrays of long; :func:`build_blocks` says which
    rows take part. Greater scores come first, ties by the smaller id. Repeated
    rows are rows of their own, and a row is never its own positive; a null id
    is no anchor's and loses ties. Scores are exact as long as they fit a long.
    An anchor without positives, and a positive without negatives, give no row,
    an empty table none at all. Other columns don't matter.

    ``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.
    """
    spark = df.sparkSession
    blocks = build_blocks(df, key, vector, label, block_rows)
    path = scratch_path(spark, "anchors")
    anchor_rows(blocks, every).write.parquet(path)
    anchors = spark.read.parquet(path)
    count, size = anchors.agg(F.count("*"), F.max(F.octet_length("vector"))).first()
    slices = max(1, math.ceil(count * (size or 0) / slice_bytes))
    part = F.pmod(F.xxhash64("block", "place"), F.lit(slices))
    own = ["block", "place"]

    def slice_of(i: int) -> dict[str, np.ndarray]:
        return _numpy(anchors.where(part == i).orderBy(*own).toArrow())

    def for_positives(i: int) -> tuple[DataFrame, Broadcast]:
        a = slice_of(i)
        n = len(a["place"])
        requests = {
            "anchor": np.arange(n), "asked": np.zeros(n, np.int32), "low": np.full(n, LOW), "high": np.full(n, HIGH)
        }
        return search_slice(blocks, a, requests, True, positives)

    path = scratch_path(spark, "positives")
    _best(in_slices(slices, for_positives, scratch_path(spark, "scored")), positives).write.parquet(path)
    found = spark.read.parquet(path).select(
        *own, "anchor_id", F.col("rank").alias("asked"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
    )

    def for_negatives(i: int) -> tuple[DataFrame, Broadcast]:
        a = slice_of(i)
        # A slice's positives are a few for each of its anchors.
        p = _numpy(found.where(part == i).select(*own, "asked", "positive_score").toArrow())
        place = {at: n for n, at in enumerate(zip(a["block"].tolist(), a["place"].tolist(), strict=True))}
        anchor = np.array([place[at] for at in zip(p["block"].tolist(), p["place"].tolist(), strict=True)], np.int64)
        score = p["positive_score"].astype(object)  # of any size
        requests = {
            "anchor": anchor,
            "asked": p["asked"].astype(np.int32),
            "low": np.array([-(-low * s // 100) for s in score], np.int64),
            "high": np.array([high * s // 100 for s in score], np.int64),
        }
        return search_slice(blocks, a, requests, False, negatives)

    mined = _best(in_slices(slices, for_negatives, scratch_path(spark, "mined")), negatives)

    def named(column: str) -> Column:
        return F.when(F.col(column) != F.lit(int(NO_ID)), F.col(column))

    return mined.join(found.drop("anchor_id"), [*own, "asked"]).select(
        "anchor_id",
        named("positive_id").alias("positive_id"),
        "rank",
        named("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
