"""Hard negatives, nearest neighbours and the prefix trie against brute force, and their odd cases."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from subledger.llm import hard_negatives, hnsw, prefix_trie
from subledger.llm.queries import QUERIES
from tests.conftest import DATA

NAN, INF = float("nan"), float("inf")


def mined(rows, every, positives, negatives, low, high):
    """Of ``(id, label, vector of int)``: the multiset of result rows, by sorting all of them."""
    out = Counter()
    place = lambda x: (-x[0], x[1] is None, x[1] or 0)
    for i, (anchor, label, vector) in enumerate(rows):
        if anchor is None or anchor % every:
            continue
        scored = [
            (sum(a * b for a, b in zip(vector, v)), n, other == label) for j, (n, other, v) in enumerate(rows) if j != i
        ]
        mine = sorted((x for x in scored if x[2]), key=place)[:positives]
        others = sorted((x for x in scored if not x[2]), key=place)
        for p, positive, _ in mine:
            fitting = [x for x in others if low * p <= 100 * x[0] <= high * p][:negatives]
            out.update((anchor, positive, r, n, p, s) for r, (s, n, _) in enumerate(fitting, 1))
    return out


def nearest(rows, every, k):
    """Of ``(id, vector)``: ``{query: [(id, score)]}`` by sorting all of them."""
    out = defaultdict(list)
    for i, (query, v) in enumerate(rows):
        if query is None or query % every:
            continue
        norm = math.sqrt(math.fsum(x * x for x in v))
        scored = []
        for j, (n, w) in enumerate(rows):
            if i != j:
                score = math.fsum(a * b for a, b in zip(v, w)) / norm / math.sqrt(math.fsum(x * x for x in w))
                scored.append((score, n))
        out[query].append(sorted(scored, key=lambda x: (-round(x[0], 12), x[1] is None, x[1] or 0))[:k])
    return out


@pytest.fixture(scope="module")
def embeddings(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]


def test_registered_hard_negatives(spark, embeddings):
    rows = [(i, (k + 1) % 10 if i % 7 == 0 else k, [math.floor(256 * x) for x in v]) for i, k, v in embeddings]
    got = QUERIES["op11_hard_negatives"](spark, DATA)
    expected = mined(rows, 100, 5, 10, 30, 90)
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert Counter(map(tuple, got.select(columns).collect())) == expected and expected


VECTORS = [
    (0, 1, [3, 4]), (0, 1, [3, 4]), (1, 1, [3, 4]), (2, 1, [1]), (3, 2, [3, 3]), (4, 2, [3, 3]), (4, 2, [3, 3]),
    (5, 3, [1, 1]), (6, 3, []), (7, 3, [-5, 2]), (None, 2, [3, 2]), (None, 1, [9, 9]), (20, 4, [2, 2]), (30, 3, [0, 0]),
    (40, 3, [1 << 40, 3]), (50, 2, [-(1 << 20), 1 << 20]),
]
LEFT_OUT = [(60, None, [1, 1]), (70, 2, None), (80, 2, [1, None]), (None, None, None)]


@pytest.mark.parametrize(("block_rows", "slice_bytes"), [(512, 16 << 20), (2, 32)])
def test_hard_negatives_of_odd_rows(spark, block_rows, slice_bytes):
    df = spark.createDataFrame(VECTORS + LEFT_OUT, "vec_id long, label int, vector array<long>")
    df = df.select("*", *(F.lit(1).alias(c) for c in ("block", "place", "row", "id", "score", "anchor_id")))
    got = hard_negatives.hard_negatives(df, 10, 3, 4, 30, 90, block_rows=block_rows, slice_bytes=slice_bytes)
    assert Counter(map(tuple, got.collect())) == mined(VECTORS, 10, 3, 4, 30, 90)
    assert hard_negatives.hard_negatives(df.where("false"), 10, 3, 4, 30, 90).count() == 0
    assert hard_negatives.hard_negatives(df.where("vec_id = 0 AND label = 1"), 10, 3, 4, 30, 90).count() == 0


def test_hilbert_order_and_bounds():
    """Neighbours on the curve differ by one step in one dimension; bounds hold all products."""
    side, dims = 4, 3
    cells = np.array(np.meshgrid(*[range(side)] * dims)).reshape(dims, -1).T
    order = sorted(range(len(cells)), key=lambda i: hard_negatives.hilbert(cells, 2)[i].tobytes())
    steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
    assert (steps == 1).all()
    rng = np.random.default_rng(1)
    rows, anchors = rng.integers(-300, 300, (50, 6)), rng.integers(-300, 300, (20, 6))
    low, high = hard_negatives.bounds(anchors, rows.min(axis=0), rows.max(axis=0))
    scores = hard_negatives.products(anchors, rows)
    assert (scores == anchors @ rows.T).all() and (scores >= low[:, None]).all() and (scores <= high[:, None]).all()


def test_zone_maps_spare_blocks():
    """Of blocks of far-off groups only those are multiplied whose bounds meet the window."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-2000, 2000, (40, 8))
    anchors = {"label": np.zeros(1, np.int32), "vector": centres[:1], "block": np.array([-1]), "place": np.array([0])}
    windows = hard_negatives.Windows(anchors, np.array([0]), np.array([hard_negatives.LOW]), np.array([hard_negatives.HIGH]), False, 3)
    rows = [c + rng.integers(-5, 5, (10, 8)) for c in centres]
    for i, r in enumerate(rows):
        windows.look(i, 1, np.arange(10) + 10 * i, r, r.min(axis=0), r.max(axis=0))
    assert windows.skipped > 30
    scores = np.concatenate(rows) @ centres[0]
    best = sorted(zip(-scores, range(400)))[:3]
    assert [(-s, i) for s, i in best] == list(zip(windows.scores[0], windows.ids[0]))


def test_recall(spark, embeddings):
    rows = [(i, v) for i, _, v in embeddings]
    expected = nearest(rows, 50, 5)
    got = defaultdict(list)
    for r in QUERIES["op12_nearest_neighbours"](spark, DATA).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    assert got.keys() == expected.keys()
    hits = sum(len({n for _, n in got[q]} & {n for _, n in e[0]}) for q, e in expected.items())
    assert hits >= 0.9 * 5 * len(expected)
    exact = {(q, n): s for q, e in expected.items() for s, n in e[0]}
    assert all(abs(exact.get((q, n), s) - s) < 1e-12 for q, found in got.items() for s, n in found)


def test_recall_over_several_shards():
    """Uniform vectors and a large group of near copies, five shards: the graph alone, without Spark."""
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(5000, 48)).astype(np.float32)
    vectors[::3] = vectors[0] + 0.05 * rng.normal(size=(1667, 48)).astype(np.float32)
    graph = hnsw.Graph.built(np.arange(5000), vectors)
    units = hnsw.unit(vectors[:300]).astype(np.float32)
    got = graph.search(units)[:, :6]
    every = units @ graph.units.T
    best = np.argsort(-every, axis=1)[:, :6]
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(got, best)]) >= 0.9


def test_nearest_of_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [2.0, 4.0]), (2, [1.0]), (3, [-1.0, -2.0]), (None, [1.0, 2.0]), (50, [3.0, 3.0]),
        (4, [1e300, 1e300]), (5, [1.0, 2.0]), (100, [-0.0, 5.0]), (6, [0.0, 5.0]),
    ]
    odd = [(7, None), (8, []), (9, [0.0, 0.0]), (150, [1.0, None]), (200, [NAN, 1.0]), (250, [INF, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    df = df.select("*", *(F.lit(1).alias(c) for c in ("id", "vector", "shard", "place", "score", "rank", "query_id")))
    for shard_rows, slice_bytes in ((8192, 1 << 20), (3, 16)):
        got = defaultdict(list)
        for r in hnsw.nearest_rows(df, 50, 4, shard_rows=shard_rows, slice_bytes=slice_bytes).collect():
            got[r.query_id].append((r["rank"], r.vec_id, round(r.score, 9)))
        # Numbers as large as 1e300 are scaled down for the plain version, which would overflow.
        small = [(i, [x / 1e300 for x in v] if v[0] > 1e200 else v) for i, v in rows]
        expected = {
            q: sorted((n, i, round(s, 9)) for found in lists for n, (s, i) in enumerate(found, 1))
            for q, lists in nearest(small, 50, 4).items()
        }
        assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in expected.items()}
    assert hnsw.nearest_rows(df.where("false"), 50, 4).count() == 0
    assert hnsw.nearest_rows(df.where("vec_id = 50"), 50, 4).count() == 0


def trie(conversations):
    """Of ``{id: [(role, text)]}``: the result rows, by all prefixes."""
    members, sums = defaultdict(list), {}
    for c, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    for path in sorted(members, key=len, reverse=True):
        leaves, saved = sums.get(path, (0, 0))
        leaves += not children[path]
        saved += (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        sums[path] = leaves, saved
        if path:
            up = sums.get(path[:-1], (0, 0))
            sums[path[:-1]] = up[0] + leaves, up[1] + saved
    return Counter(
        (
            ids[0], len(p), members[p[:-1]][0] if p else None, len(ids), children[p], *sums[p],
            hashlib.sha256(",".join(str(c) for c in ids if len(conversations[c]) == len(p)).encode()).hexdigest(),
        )
        for p, ids in members.items()
    )


def rebuilt(rows, family=100, most=6):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % most
        out[c] = turns.get(c - int(math.fmod(c, family)), [])[:h] + own[h:]
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_registered_trie(spark):
    rows = spark.read.parquet(f"{DATA}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = QUERIES["op13_prefix_trie"](spark, DATA)
    assert Counter(map(tuple, got.select(COLUMNS).collect())) == trie(rebuilt(rows))


def test_trie_of_odd_rows(spark, monkeypatch):
    """Nulls, ties, repeated rows, conversations far longer than a block, equal ones, and ones without turns."""
    long = [(300 + c, i, "user", f"turn {i if i < 45 or c < 2 else (i, c)}") for c in range(4) for i in range(70)]
    rows = [
        (100, None, "user", "first"), (100, 2, None, "second"), (100, 2, "a", None), (100, 2, "a", None), (101, 1, "user", "x"),
        (102, 0, "user", "x"), (None, 1, "user", "left out"), (205, 1, "user", ""), (206, 1, "user", "é😀"), (-7, 1, "b", "y"),
        *((900 + c, t, "user", f"same {t}") for c in range(40) for t in range(3)), *long,
    ]
    monkeypatch.setattr(prefix_trie, "CHUNK_BLOCKS", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    df = df.select("*", *(F.lit(1).alias(c) for c in ("row", "position", "block", "turns", "node_a", "chars", "place")))

    def found(df):
        turns = prefix_trie.numbered_turns(df)
        return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns, 100, 6)).select(COLUMNS)

    expected = trie(rebuilt(rows))
    assert Counter(map(tuple, found(df).collect())) == expected
    assert found(df.where("false")).count() == 0


def test_a_conversation_over_many_partitions(spark):
    """One conversation holds most rows; its turns are numbered over several partitions."""
    df = spark.range(0, 3000, 1, 6).selectExpr("IF(id % 10 = 0, id, 5) AS conv_id", "id % 1000 AS turn", "'u' AS role", "'t' AS text")
    got = prefix_trie.numbered_turns(df).where("conv_id = 5").select("position").collect()
    assert sorted(r.position for r in got) == list(range(1, 2701))
