"""Nearest neighbours by hierarchical navigable small-world graphs, one a shard.

Rows are dealt evenly into shards of bounded size. Each shard is a graph of
layers over its distinct vectors, stored as flat neighbour arrays in one
Parquet row. A search starts at the top layer, walks greedily down, and keeps
a beam on the lowest; all queries of a slice walk in step, so a task works on
matrices. What shards find is merged by exact cosine.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subledger.llm.columns import col
from subledger.session import scratch_path

#: Rows of a shard.
SHARD_ROWS = 8192
#: Links of a node on each upper layer; the lowest has twice as many.
LINKS = 16
#: Nearest nodes among which a node's links are chosen.
CANDIDATES = 48
#: Nodes that a search keeps on the lowest layer.
BEAM = 96
#: Nodes of the beam that one step of the search looks behind.
STEP = 4
#: Vectors of one slice of queries in bytes, which is sent to all tasks.
SLICE_BYTES = 16 << 20
#: Queries that walk in step.
TOGETHER = 512
SEED = 7


def valid(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, and not all zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that no square overflows."""
    scaled = vectors.astype(np.float64)
    scaled /= np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def chosen_links(units: np.ndarray, near: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of each node's candidates, nearest first, those nearer to it than to any chosen one.

    What is left of ``most`` is filled with the nearest others; -1 where there is none.
    """
    n, width = near.shape
    out = np.full((n, most), -1, np.int32)
    for at in range(0, n, 1024):
        ids, own = near[at : at + 1024], sims[at : at + 1024]
        there = ids >= 0
        found = units[ids]
        between = np.matmul(found, found.transpose(0, 2, 1))
        taken = np.zeros(ids.shape, bool)
        for i in range(width):
            hidden = (taken[:, :i] & (between[:, i, :i] >= own[:, i, None])).any(axis=1)
            taken[:, i] = there[:, i] & ~hidden & (taken.sum(axis=1) < most)
        # Chosen ones first, then the nearest others.
        rank = np.where(taken, 0, np.where(there, width, 2 * width)) + np.arange(width)
        order = np.argsort(rank, axis=1)[:, :most]
        out[at : at + 1024, : order.shape[1]] = np.take_along_axis(np.where(there, ids, -1), order, axis=1)
    return out


def nearest_of(units: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest other nodes of each node, and their similarity, by products of blocks."""
    n = len(units)
    width = min(width, n - 1)
    ids, sims = np.empty((n, width), np.int32), np.empty((n, width), np.float32)
    for at in range(0, n, 1024):
        rows = units[at : at + 1024] @ units.T
        rows[np.arange(len(rows)), np.arange(at, at + len(rows))] = -9
        found = np.argpartition(-rows, width - 1, axis=1)[:, :width] if width < n - 1 else np.argsort(-rows, axis=1)[:, :width]
        near = np.take_along_axis(rows, found, axis=1)
        order = np.argsort(-near, axis=1, kind="stable")
        ids[at : at + 1024] = np.take_along_axis(found, order, axis=1)
        sims[at : at + 1024] = np.take_along_axis(near, order, axis=1)
    return ids, sims


def layer_links(units: np.ndarray, most: int) -> np.ndarray:
    """Links of one layer: chosen ones of each node and those of nodes that chose it.

    A ring through all nodes is part of it, so that each can be reached.
    """
    n = len(units)
    if n == 1:
        return np.full((1, most), -1, np.int32)
    half = chosen_links(units, *nearest_of(units, CANDIDATES), max(1, most // 2))
    a = np.repeat(np.arange(n, dtype=np.int32), half.shape[1])
    b = half.ravel()
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate((a, b)), np.concatenate((b, a))
    pairs = np.unique(a.astype(np.int64) * n + b)
    a, b = (pairs // n).astype(np.int32), (pairs % n).astype(np.int32)
    sims = np.einsum("ij,ij->i", units[a], units[b])
    order = np.lexsort((-sims, a))
    a, b, sims = a[order], b[order], sims[order]
    starts = np.searchsorted(a, np.arange(n))
    place = np.arange(len(a)) - starts[a]
    width = max(1, min(int(place.max()) + 1, 3 * most))  # the nearest of very many that chose a node
    near, own = np.full((n, width), -1, np.int32), np.full((n, width), -9, np.float32)
    kept = place < width
    near[a[kept], place[kept]], own[a[kept], place[kept]] = b[kept], sims[kept]
    links = chosen_links(units, near, own, most - 1)
    ring = np.random.default_rng(SEED).permutation(n).astype(np.int32)
    after = np.empty(n, np.int32)
    after[ring] = np.roll(ring, -1)
    return np.column_stack((links, after))


@dataclass
class Graph:
    """Distinct vectors of a shard, the ids of their rows, and layers of links."""

    vectors: np.ndarray  # as given
    ids: np.ndarray  # of all rows, ascending within a node
    starts: np.ndarray  # of the nodes' ids, and their end
    levels: np.ndarray  # nodes on each layer; nodes are ordered so that upper ones come first
    links: np.ndarray  # the layers' neighbour arrays one after another, lowest first

    def __post_init__(self):
        self.units = unit(self.vectors).astype(np.float32)
        self.layers, at = [], 0
        for i, n in enumerate(self.levels):
            width = LINKS if i else 2 * LINKS
            self.layers.append(self.links[at : at + n * width].reshape(n, width))
            at += n * width

    @classmethod
    def built(cls, ids: np.ndarray, vectors: np.ndarray) -> Graph:
        raw = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
        _, first, node = np.unique(raw, return_index=True, return_inverse=True)
        # Levels fall off geometrically; the order of nodes is a shuffle, so a layer is a prefix.
        n = len(first)
        shuffled = np.random.default_rng(SEED).permutation(n)
        place = np.empty(n, np.int64)
        place[shuffled] = np.arange(n)
        order = np.lexsort((ids, place[node]))
        starts = np.searchsorted(place[node][order], np.arange(n + 1))
        distinct = vectors[first[shuffled]]
        levels = [n]
        while levels[-1] > LINKS:
            levels.append(math.ceil(levels[-1] / LINKS))
        units = unit(distinct).astype(np.float32)
        links = [layer_links(units[:m], LINKS if i else 2 * LINKS).ravel() for i, m in enumerate(levels)]
        return cls(distinct, ids[order], starts, np.array(levels), np.concatenate(links))

    def search(self, queries: np.ndarray, beam: int = BEAM) -> np.ndarray:
        """Nodes near each query of length 1, nearest first, -1 where there are fewer."""
        out = np.full((len(queries), beam), -1, np.int64)
        for at in range(0, len(queries), TOGETHER):
            some = queries[at : at + TOGETHER]
            entry = np.zeros(len(some), np.int64)
            for links in self.layers[:0:-1]:
                entry = self._walk(some, entry, links, 1)[:, 0]
            out[at : at + TOGETHER] = self._walk(some, entry, self.layers[0], beam)
        return out

    def _walk(self, queries: np.ndarray, entry: np.ndarray, links: np.ndarray, beam: int) -> np.ndarray:
        """The best nodes of a layer found from ``entry``: the beam's best nodes are
        looked behind until none is left, and what is found better stays."""
        count, rows = len(queries), np.arange(len(queries))
        seen = np.zeros((count, len(links) + 1), bool)  # the last column is that of no node
        seen[:, -1] = True
        seen[rows, entry] = True
        ids = np.full((count, beam), -1, np.int64)
        sims = np.full((count, beam), -9, np.float32)
        fresh = np.zeros((count, beam), bool)
        ids[:, 0], fresh[:, 0] = entry, True
        sims[:, 0] = np.einsum("ij,ij->i", queries, self.units[entry])
        step = min(STEP, beam)
        active = rows
        while len(active):
            best = np.argsort(np.where(fresh[active], -sims[active], 9), axis=1, kind="stable")[:, :step]
            open_ = np.take_along_axis(fresh[active], best, axis=1)
            nodes = np.take_along_axis(ids[active], best, axis=1)
            fresh[active[:, None], best] = False
            near = np.where(open_[:, :, None], links[nodes], -1).reshape(len(active), -1)
            # A node that two of the step's nodes link to counts once.
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[active[:, None], near]] = -1
            seen[active[:, None], near] = True
            found = np.matmul(self.units[near], queries[active][:, :, None])[:, :, 0]
            found[near < 0] = -9
            all_sims = np.concatenate((sims[active], found), axis=1)
            all_ids = np.concatenate((ids[active], near), axis=1)
            all_fresh = np.concatenate((fresh[active], near >= 0), axis=1)
            top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            sims[active] = np.take_along_axis(all_sims, top, axis=1)
            ids[active] = np.take_along_axis(all_ids, top, axis=1)
            fresh[active] = np.take_along_axis(all_fresh, top, axis=1)
            active = active[fresh[active].any(axis=1)]
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, axis=1)


def padded(column: pa.ListArray, width: int, kind: type) -> np.ndarray:
    """Vectors as a matrix; a shorter one ends in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    out = np.zeros((len(column), width), kind)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def plain_ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers; a null one is the greatest, so that it loses ties."""
    return column.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


INDEX = "shard long, width int, n_rows int, ids binary, starts binary, vectors binary, kind string, levels binary, links binary"


def build_index(df: DataFrame, key: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> str:
    """Path of a stored index of all rows of ``df``: one Parquet row for each shard.

    Vectors that are null, empty, all zero, or that hold a null or an infinite
    or undefined component take no part; a shorter vector counts as zero beyond
    its end. Rows with equal vectors share a node. An empty table gives an
    index without rows. Other columns don't matter.
    """
    given = col(vector)
    rows = df.select(col(key).cast("long").alias("id"), given.alias("vector")).where(valid(given))
    n, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    kind = "float32" if df.schema[vector].dataType.elementType.simpleString() == "float" else "float64"
    shards = max(1, math.ceil(n / shard_rows))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = [(plain_ids(b.column(0)), padded(b.column(1), width, kind)) for b in batches if b.num_rows]
        if not parts:
            return
        ids, vectors = (np.concatenate(p) for p in zip(*parts, strict=True))
        graph = Graph.built(ids, vectors + 0)  # a negative zero is zero
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "shard": TaskContext.get().partitionId(),
                    "width": width,
                    "n_rows": len(ids),
                    "ids": graph.ids.astype(np.int64).tobytes(),
                    "starts": graph.starts.astype(np.int32).tobytes(),
                    "vectors": graph.vectors.tobytes(),
                    "kind": kind,
                    "levels": graph.levels.astype(np.int32).tobytes(),
                    "links": graph.links.astype(np.int32).tobytes(),
                }
            ],
            pa.schema(
                [
                    ("shard", pa.int64()), ("width", pa.int32()), ("n_rows", pa.int32()), ("ids", pa.binary()),
                    ("starts", pa.binary()), ("vectors", pa.binary()), ("kind", pa.string()), ("levels", pa.binary()),
                    ("links", pa.binary()),
                ]
            ),
        )

    path = scratch_path(df.sparkSession, "hnsw")
    rows.repartition(shards).mapInArrow(build, INDEX).write.parquet(path)
    return path


def graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Graph]]:
    """The shards of a task's part of the index, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            r = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
            vectors = np.frombuffer(r["vectors"], r["kind"]).reshape(-1, r["width"])
            yield (
                r["shard"],
                Graph(
                    vectors,
                    np.frombuffer(r["ids"], np.int64),
                    np.frombuffer(r["starts"], np.int32),
                    np.frombuffer(r["levels"], np.int32),
                    np.frombuffer(r["links"], np.int32),
                ),
            )


def query_rows(index: DataFrame, every: int) -> DataFrame:
    """Rows of the index whose id is divisible by ``every``: their shard, place and vector."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, graph in graphs(batches):
            places = np.flatnonzero((graph.ids % every == 0) & (graph.ids != np.iinfo(np.int64).max))
            nodes = np.searchsorted(graph.starts, places, "right") - 1
            for at in range(0, len(places), 1024):
                some = slice(at, at + 1024)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(places[some]), shard)),
                        pa.array(places[some].astype(np.int32)),
                        pa.array(graph.ids[places[some]]),
                        pa.array([v.astype(np.float64).tobytes() for v in graph.vectors[nodes[some]]], pa.binary()),
                    ],
                    ["shard", "place", "query_id", "vector"],
                )

    return index.mapInArrow(pick, "shard long, place int, query_id long, vector binary")


class Found:
    """The best rows found for each query so far, by score and then by id."""

    def __init__(self, count: int, k: int):
        self.k = k
        self.scores, self.ids = np.full((count, k), -np.inf), np.full((count, k), np.iinfo(np.int64).max)

    def add(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        kept = np.isfinite(self.scores)
        query = np.concatenate((query, np.nonzero(kept)[0]))
        scores = np.concatenate((scores, self.scores[kept]))
        ids = np.concatenate((ids, self.ids[kept]))
        order = np.lexsort((ids, -scores, query))
        query, scores, ids = query[order], scores[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        best = rank < self.k
        self.scores[query[best], rank[best]], self.ids[query[best], rank[best]] = scores[best], ids[best]


def in_slices(slices: int, search: Callable[[int], tuple[DataFrame, Broadcast]], path: str) -> DataFrame:
    """What the searches of all slices find, written one after another.

    A slice's broadcast goes before the next one is made, so the driver and
    the executors hold one slice, however many there are.
    """
    for i in range(slices):
        found, sent = search(i)
        found.write.mode("append").parquet(path)
        sent.destroy()
    return found.sparkSession.read.parquet(path)


def search_slice(index: DataFrame, queries: pa.Table, k: int, beam: int) -> tuple[DataFrame, Broadcast]:
    """Each task's best rows for every query of a slice, over the shards it reads, and the slice as sent.

    The slice holds :data:`SLICE_BYTES` of vectors at most, so it may be sent to all tasks.
    """
    sent = index.sparkSession.sparkContext.broadcast(
        tuple(queries.column(c).to_pylist() if c == "vector" else queries.column(c).to_numpy() for c in queries.column_names)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, places, query_ids, raw = sent.value
        if not raw:
            return
        vectors = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
        exact = unit(vectors)
        units = exact.astype(np.float32)
        found = Found(len(raw), k)
        for shard, graph in graphs(batches):
            nodes = graph.search(units, beam)
            query, slot = np.nonzero(nodes >= 0)
            node = nodes[query, slot]
            scores = np.einsum("ij,ij->i", exact[query], unit(graph.vectors)[node])
            # Of equal vectors the least ids come first; one more than asked for, as one may be the query's row.
            for i in range(k + 1):
                place = graph.starts[node] + i
                more = (place < graph.starts[node + 1]) & ~((shards[query] == shard) & (places[query] == place))
                found.add(query[more], scores[more], graph.ids[place[more]])
        query, rank = np.nonzero(np.isfinite(found.scores))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(shards[query]),
                pa.array(places[query]),
                pa.array(query_ids[query]),
                pa.array(found.ids[query, rank]),
                pa.array(found.scores[query, rank]),
            ],
            ["shard", "place", "query_id", "vec_id", "score"],
        )

    return index.mapInArrow(run, "shard long, place int, query_id long, vec_id long, score double"), sent


def nearest_rows(
    df: DataFrame, every: int, k: int, key: str = "vec_id", vector: str = "embedding",
    shard_rows: int = SHARD_ROWS, beam: int = BEAM, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """For every row whose id is divisible by ``every``, the ``k`` nearest other rows found.

    ``(query_id, rank, vec_id, score)``: the score is the cosine of the vectors
    as given, in double precision; the nearest come first, ties by the smaller
    id. :func:`build_index` says which rows take part. Repeated rows are rows
    of their own, and a row is never its own neighbour; a null id is no query's
    and loses ties. A table with fewer rows gives all of them.
    """
    spark = df.sparkSession
    index = spark.read.parquet(build_index(df, key, vector, shard_rows))
    path = scratch_path(spark, "queries")
    query_rows(index, every).write.parquet(path)
    queries = spark.read.parquet(path)
    count, size = queries.agg(F.count("*"), F.max(F.octet_length("vector"))).first()
    slices = max(1, math.ceil(count * (size or 0) / slice_bytes))
    part = F.pmod(F.xxhash64("shard", "place"), F.lit(slices))

    def search(i: int) -> tuple[DataFrame, Broadcast]:
        return search_slice(index, queries.where(part == i).toArrow(), k, beam)

    found = in_slices(slices, search, scratch_path(spark, "neighbours"))
    own = Window.partitionBy("shard", "place").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
    vec_id = F.when(F.col("vec_id") != F.lit(int(np.iinfo(np.int64).max)), F.col("vec_id"))
    return ranked.select("query_id", "rank", vec_id.alias("vec_id"), "score")
