"""Near-duplicates: DartMinHash signatures, banded joining, exact verification.

Texts with the same words are one node from the start, so copies never meet.
Nodes that share a band form buckets; buckets that share nodes form families.
In families of any size two texts are linked if they share a band and are
similar enough. A family of bounded size is compared in one group. In a larger
one members are first held against the most central member of each of their
buckets; parts that this links need no comparison within themselves, and the
rest of each bucket is compared in blocks of bounded size. All links found are
exact; classes are their connected components.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.llm.bpe import Remembered, once, small_batches
from subledger.llm.columns import col, text_of
from subledger.llm.components import components
from subledger.llm.dart_minhash import band_keys, dart_minhash, mixed
from subledger.session import shared_dir

SHINGLE = 5
SIMILARITY = 0.8
#: 192 coordinates: a pair of similarity 0.8 shares no band in 6 of 100,000 cases.
BANDS, BAND_ROWS = 32, 6
# A family or block that one task compares, in nodes and in shingles.
GROUP_NODES, GROUP_SHINGLES = 4_096, 2_000_000
# Rows of 80 bytes that may be sent to every executor, 16 MB; more are joined by shuffle.
BROADCAST_ROWS = 200_000
# The same for rows with bands, of 340 bytes.
BROADCAST_SETS = 50_000
# The same for rows of 8 bytes.
BROADCAST_BANDS = 500_000

_U = np.uint64
_WORD = re.compile(r"\w+")


def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def shingles(names: list[str], size: int, hashes: dict[str, int]) -> np.ndarray:
    """Sorted hashes of all runs of ``size`` words, with repeats; fewer words are one run."""
    h = np.array([hashes[w] for w in names], _U)
    if len(h) < size:
        h = np.concatenate((h, np.zeros(size - len(h), _U)))
    runs = np.zeros(len(h) - size + 1, _U)
    for i in range(size):
        runs = mixed(runs + h[i : len(h) - size + 1 + i])
    return np.sort(runs)


def _counted(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(runs, return_counts=True)


def _expanded(runs: np.ndarray) -> np.ndarray:
    """Each repeat of a run as an element of its own, so that plain sets have
    the weighted similarity of the counts."""
    first = np.concatenate(([True], runs[1:] != runs[:-1]))
    place = np.arange(len(runs)) - np.maximum.accumulate(np.where(first, np.arange(len(runs)), 0))
    return np.where(place == 0, runs, mixed(runs + place.astype(_U) * _U(0x9E3779B97F4A7C15)))


def _nodes(names: list[str]) -> bytes | None:
    """128 bits that stand for a sequence of words; none for no words."""
    return hashlib.md5(" ".join(names).encode("utf-8", "surrogatepass")).digest() if names else None


def _words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


# Bytes of the texts that are signed at once, and words whose hashes a worker remembers.
SIGNED_BYTES, WORDS = 1 << 18, 200_000


def _sizes(batch: pa.RecordBatch) -> list[int]:
    """Bytes, or what as many darts weigh: a short text gets as many as a long one."""
    return np.maximum(pc.binary_length(batch.columns[-1]).to_numpy(), 4_000).tolist()


def _hashes() -> dict[str, int]:
    return once(("words",), lambda: Remembered(_word_hash, WORDS))


def _signed(df: DataFrame, key: str, text: str, size: int, bands: int, rows: int) -> DataFrame:
    """``(_key, _hash, _node, _n, _bands)`` of every row of ``df``; ``_n`` runs of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes()
        for batch in small_batches(batches, _sizes, SIGNED_BYTES):
            names = [_words_of(t) for t in batch.columns[-1].to_pylist()]
            sets = [_counted(shingles(n, size, hashes)) if n else (np.zeros(0, _U), np.zeros(0)) for n in names]
            owners = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
            elements, weights = (np.concatenate(x) for x in zip(*sets, strict=True))
            keys = band_keys(dart_minhash(elements, weights.astype(float), owners, len(sets), bands * rows), bands)
            listed = [k if n else None for k, n in zip(keys, names, strict=True)]
            nodes, runs = pa.array([_nodes(n) for n in names], pa.binary()), [max(1, len(n) - size + 1) for n in names]
            columns = [*batch.columns[:2], nodes, pa.array(runs, pa.int64()), pa.array(listed, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "_hash", "_node", "_n", "_bands"])

    kind = df.select(col(key)).schema[0].dataType
    schema = T.StructType([
        T.StructField("_key", kind), T.StructField("_hash", T.LongType()), T.StructField("_node", T.BinaryType()),
        T.StructField("_n", T.LongType()), T.StructField("_bands", T.ArrayType(T.LongType())),
    ])
    return _texts(df, key, text).mapInArrow(run, schema)


def _texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(_key, _hash, _text)`` of every row; the hash tells rows of one key apart."""
    return df.select(col(key).alias("_key"), F.xxhash64(text_of(text)).alias("_hash"), text_of(text).alias("_text"))


def _sets(texts: DataFrame, size: int) -> DataFrame:
    """``(_node, _family, _bands, _set)`` of ``(_node, _family, _bands, _text)``, of rows whose text is that node's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes()
        for batch in small_batches(batches, _sizes, SIGNED_BYTES):
            nodes, names = batch.column(0).to_pylist(), [_words_of(t) for t in batch.columns[-1].to_pylist()]
            here = [i for i, n in enumerate(names) if _nodes(n) == nodes[i]]
            sets = [_expanded(shingles(names[i], size, hashes)).view(np.int64) for i in here]
            kept = [c.take(pa.array(here, pa.int64())) for c in batch.columns[:3]]
            columns = [*kept, pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["_node", "_family", "_bands", "_set"])

    return texts.mapInArrow(run, "_node binary, _family binary, _bands array<bigint>, _set array<bigint>")


def _linked(
    sets: list[np.ndarray], parts: list, similarity: float, left: np.ndarray, bands: np.ndarray | None = None
) -> tuple[list, np.ndarray]:
    """Pairs that link parts not linked before, a forest and never all pairs,
    and a number for each member that those it is linked with share.

    ``left`` marks the members that are held against all others; members of
    one part are linked already. With ``bands`` only members that share one
    are linked; without, all do.
    """
    sizes = np.array([len(s) for s in sets])
    elements, codes = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(codes, kind="stable")
    holders, starts = owners[order], np.searchsorted(codes[order], np.arange(len(elements) + 1))
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    _, root = np.unique(np.array(parts), return_inverse=True)
    pairs = []
    # The member that shares most goes first. What it links needs no turn of
    # its own: whoever is not linked to it is held against all of them.
    shares = np.add.reduceat(np.diff(starts)[codes], bounds[:-1]) / sizes
    turns = sorted(np.flatnonzero(left).tolist(), key=lambda i: -shares[i])
    whole = bool(left.all())
    for turn, i in enumerate(turns):
        if whole and turn and root[i] == root[turns[0]]:
            continue
        mine = codes[bounds[i] : bounds[i + 1]]
        counts = starts[mine + 1] - starts[mine]
        at = np.repeat(starts[mine] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        shared = np.bincount(holders[at], minlength=len(sets))
        similar = (shared >= similarity * (sizes + sizes[i] - shared) - 1e-9) & (root != root[i])
        if bands is not None:
            found = np.flatnonzero(similar)
            similar = found[(bands[found] == bands[i]).any(axis=1)]
        else:
            similar = np.flatnonzero(similar)
        for j in similar:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                pairs.append((int(i), int(j)))
    return pairs, root


def _members(table: pa.Table) -> tuple[list[bytes], list[np.ndarray]]:
    return table["_node"].to_pylist(), [x.values.to_numpy(zero_copy_only=False) for x in table["_set"]]


def _linking(similarity: float) -> Callable[[pa.Table], pa.Table]:
    """Links between the parts of a pair of blocks."""

    def run(table: pa.Table) -> pa.Table:
        nodes, sets = _members(table)
        pairs, _ = _linked(sets, table["_part"].to_pylist(), similarity, np.array(table["_left"].to_pylist(), bool))
        ends = ([nodes[i] for i, _ in pairs], [nodes[j] for _, j in pairs])
        return pa.table({"a": pa.array(ends[0], pa.binary()), "b": pa.array(ends[1], pa.binary())})

    return run


def _classing(similarity: float) -> Callable[[pa.Table], pa.Table]:
    """Classes of a family: all its links are between its members."""

    def run(table: pa.Table) -> pa.Table:
        nodes, sets = _members(table)
        bands = np.array(table["_bands"].to_pylist(), np.int64)
        _, root = _linked(sets, list(range(len(nodes))), similarity, np.ones(len(nodes), bool), bands)
        least: dict[int, bytes] = {}
        for node, r in zip(nodes, root.tolist(), strict=True):
            least[r] = min(node, least.get(r, node))
        labels = [least[r] for r in root.tolist()]
        return pa.table({"node": pa.array(nodes, pa.binary()), "label": pa.array(labels, pa.binary())})

    return run


_EDGES = "a binary, b binary"


def _near(df: DataFrame, few: bool) -> DataFrame:
    return F.broadcast(df) if few else df


def _blocks(told: DataFrame, nodes: int) -> DataFrame:
    """``(_group, _part, _own, _blocks)`` of ``(_group, _node, _n, _part)``: the
    number of blocks that a part has of its own or that all smaller ones share.
    Groups of one part are linked already and have none."""
    # Its share of a block in nodes or in runs, whichever is more.
    share = F.greatest(F.count(F.lit(1)) / F.lit(nodes // 2), F.sum("_n") / F.lit(GROUP_SHINGLES // 2))
    parts = told.groupBy("_group", "_part").agg(share.alias("_share")).checkpoint()
    own = F.col("_share") >= 1
    open_ = parts.groupBy("_group").agg(F.count(F.lit(1)).alias("_parts"), F.sum(F.when(~own, F.col("_share"))).alias("_rest"))
    open_ = open_.where("_parts > 1").select("_group", F.coalesce("_rest", F.lit(0)).alias("_rest"))
    return parts.join(open_, "_group").select(
        "_group", "_part", F.when(own, F.col("_part")).otherwise(F.lit(b"")).alias("_own"),
        F.ceil(F.when(own, F.col("_share")).otherwise(F.col("_rest"))).alias("_blocks"),
    )


def _large_links(members: DataFrame, sets: DataFrame, similarity: float, nodes: int) -> DataFrame:
    """Links of families too large for one group.

    ``members`` are ``(_band, _node, _n)``. Two blocks that meet hold about
    ``nodes`` nodes and ``GROUP_SHINGLES`` runs at most.
    """
    degrees = members.groupBy("_node").agg(F.count(F.lit(1)).alias("_degree"))
    central = F.max_by("_node", F.struct("_degree", "_node")).alias("_hub")
    hubs = members.join(degrees, "_node").groupBy("_band").agg(central)
    pairs = members.join(hubs, "_band").where("_node <> _hub").select("_node", "_hub").distinct()
    held = pairs.join(sets, "_node").join(
        sets.select(F.col("_node").alias("_hub"), F.col("_set").alias("_hubs")), "_hub"
    )
    shared = F.size(F.array_intersect("_set", "_hubs"))
    whole = F.size("_set") + F.size("_hubs") - shared
    star = held.where(shared >= F.lit(similarity) * whole - 1e-9)
    star = star.select(F.col("_node").alias("a"), F.col("_hub").alias("b")).checkpoint()
    labels = components(star)
    told = members.select(F.col("_band").alias("_group"), "_node", "_n").distinct().join(labels, F.col("_node") == F.col("node"), "left")
    told = told.select("_group", "_node", "_n", F.coalesce("label", "_node").alias("_part"))
    # Groups in several parts: large parts have blocks of their own, the others share blocks.
    parts = _blocks(told, nodes)
    placed = told.join(parts, ["_group", "_part"]).select(
        "_group", "_node", "_part", "_own", F.pmod(F.xxhash64("_node", F.lit(7)), F.col("_blocks")).alias("_block")
    )
    placed = placed.checkpoint()
    blocks = placed.select("_group", "_own", "_block").distinct()
    other = blocks.select("_group", F.col("_own").alias("_own2"), F.col("_block").alias("_block2"))
    apart = (F.col("_own") != F.col("_own2")) | (F.col("_own") == F.lit(b""))
    met = blocks.join(other, "_group").where(apart & (F.struct("_own", "_block") <= F.struct("_own2", "_block2")))
    pair = F.xxhash64("_group", "_own", "_block", "_own2", "_block2").alias("_pair")
    same = (F.col("_own") == F.col("_own2")) & (F.col("_block") == F.col("_block2"))
    second = met.where(~same).select(
        "_group", F.col("_own2").alias("_own"), F.col("_block2").alias("_block"), pair, F.lit(False).alias("_left")
    )
    sides = met.select("_group", "_own", "_block", pair, F.lit(True).alias("_left")).unionByName(second)
    rows = placed.join(sides, ["_group", "_own", "_block"])
    rows = rows.select("_pair", "_node", F.hex("_part").alias("_part"), "_left")
    blocks = rows.join(sets, "_node").select("_pair", "_node", "_part", "_left", "_set")
    return star.unionByName(blocks.groupBy("_pair").applyInArrow(_linking(similarity), _EDGES))


def _candidates(held: DataFrame, families: DataFrame, nodes: int) -> DataFrame:
    """A row for each node of a family: ``_key`` and ``_hash`` of one of its rows,
    ``_again`` if such a row is repeated, its bands, and whether the family is small."""
    rows = held.join(families.select(F.col("node").alias("_node"), F.col("label").alias("_family")), "_node")
    # A node's rows have the same words, so the same bands.
    rows = rows.groupBy("_node", "_family", "_n", "_key", "_hash").agg(F.count(F.lit(1)).alias("_c"), F.first("_bands").alias("_b"))
    picked = rows.groupBy("_node", "_family", "_n").agg(F.min(F.struct("_c", "_key", "_hash", "_b")).alias("_p"))
    sizes = picked.groupBy("_family").agg(F.count(F.lit(1)).alias("_nodes"), F.sum("_n").alias("_all"))
    return picked.join(sizes, "_family").select(
        "_node", "_n", "_family", F.col("_p._key").alias("_k"), F.col("_p._hash").alias("_h"), F.col("_p._b").alias("_bands"),
        (F.col("_p._c") > 1).alias("_again"), ((F.col("_nodes") <= nodes) & (F.col("_all") <= GROUP_SHINGLES)).alias("_small"),
    )


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
    group_nodes: int = GROUP_NODES,
) -> DataFrame:
    """One row ``(key, class_id, class_size)`` for each row of ``df``.

    Two texts are linked if they share a band of their signatures and the
    weighted Jaccard similarity of the counts of their runs of ``size``
    lower-cased words is ``similarity`` or more; whether a pair is linked
    depends on its two texts alone. At a similarity of 0.8 a pair shares no
    band in 6 of 100,000 cases, above it in fewer. A class
    is what links connect, its id the least key that isn't null. Texts with
    the same words are linked; a text of fewer words is one run. A text without
    a word (null, empty, punctuation) is alone in its class, with its own key
    as the id. Keys may repeat and may be null; other columns don't matter. An
    empty table has no classes. Families of more than ``group_nodes`` are
    compared in blocks, which doesn't change what is found.
    """
    shared_dir(df.sparkSession)
    signed = _signed(df, key, text, size, bands, rows).checkpoint()
    held = signed.where("_node IS NOT NULL")
    marks = held.select(F.explode("_bands").alias("_band"), "_node")
    # Two nodes of a band differ in a 64-bit hash, which is counted faster than they are.
    hashed = held.select(F.explode("_bands").alias("_band"), F.xxhash64("_node").alias("_h"))
    shared = hashed.groupBy("_band").agg(F.min("_h").alias("_a"), F.max("_h").alias("_b")).where("_a <> _b")
    shared = shared.select("_band").checkpoint()
    members = marks.join(_near(shared, shared.count() <= BROADCAST_BANDS), "_band").distinct().checkpoint()
    least = members.groupBy("_band").agg(F.min("_node").alias("_least"))
    families = components(members.join(least, "_band").select(F.col("_node").alias("a"), F.col("_least").alias("b")))
    found = _candidates(held, families, group_nodes).checkpoint()
    texts = _texts(df, key, text)

    def sets_of(part: DataFrame) -> DataFrame:
        near = _near(part.select("_node", "_family", "_bands", "_k", "_h"), part.count() <= BROADCAST_SETS)
        # By the hash too: a row meets its own node only, however many rows share its key.
        own = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h"))
        rows = texts.join(near, own).select("_node", "_family", "_bands", "_text")
        sets = _sets(rows, size)
        return sets if part.where("_again").isEmpty() else sets.dropDuplicates(["_node"])

    small, large = found.where("_small"), found.where("not _small")
    labels = sets_of(small).groupBy("_family").applyInArrow(_classing(similarity), "node binary, label binary")
    if not large.isEmpty():
        split = members.join(large.select("_node", "_n"), "_node").select("_band", "_node", "_n").checkpoint()
        links = _large_links(split, sets_of(large).select("_node", "_set").checkpoint(), similarity, group_nodes)
        labels = labels.unionByName(components(links))
    labels = labels.checkpoint()
    labels = _near(labels, labels.count() <= BROADCAST_ROWS)
    classed = held.join(labels, F.col("_node") == F.col("node"), "left").select(
        "_key", F.coalesce("label", "_node").alias("_class")
    ).checkpoint()
    # A text that is alone looks up nothing; copies and classes are few beside them.
    classes = classed.groupBy("_class").agg(F.min("_key").alias("_least"), F.count(F.lit(1)).alias("_size"))
    classes = classes.where("_size > 1").checkpoint()
    found = classed.join(_near(classes, classes.count() <= BROADCAST_ROWS), "_class", "left").select("_key", "_least", "_size")
    none = signed.where("_node IS NULL").select("_key", F.lit(None).cast("long").alias("_size"))
    rows = found.unionByName(none, allowMissingColumns=True)
    alone = F.col("_size").isNull()
    return rows.select(
        F.col("_key").alias(key),
        F.when(alone, F.col("_key")).otherwise(F.col("_least")).alias("class_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("class_size"),
    )
