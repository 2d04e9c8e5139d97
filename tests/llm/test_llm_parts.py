"""Parts of the operators by their own rules."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from subledger.llm import bpe, decontaminate, near_dup, secrets, sharding, token_counts, trigrams, urls
from subledger.llm.components import components
from subledger.llm.dart_minhash import band_keys, dart_minhash, mixed


def holds(query, text):
    return any(all(t in text.lower() for t in conjunction) for conjunction in query)


@pytest.mark.parametrize(
    ("pattern", "expected"),
    [
        ("abcd", [{"abc", "bcd"}]),
        ("ab?cd", [{"abc", "bcd"}, {"acd"}]),
        ("(abc|xyz)+q*def", [{"abc", "def"}, {"def", "xyz"}]),
        ("(?:abc|x+)def", [{"abc", "def"}, {"def"}]),
        ("[0-9a-f]+", [set()]),
        ("ab.cd", [set()]),
        ("A[bc]D", [{"abd"}, {"acd"}]),
        ("a{3}b*", [{"aaa"}]),
    ],
)
def test_trigram_queries(pattern, expected):
    got = trigrams.trigram_query(pattern)
    least = {frozenset(e) for e in expected if not any(o < e for o in expected)}
    assert set(got) == least


def test_queries_hold_for_matches():
    texts = ["PassWord = abcdefghijklmnop", "api_key:'0123456789abcdef'", "apikey=Zz0123456789abc", "AKIA" + "Z" * 20]
    texts += ["-----BEGIN EC PRIVATE KEY-----", "ghp_" + "a" * 40, "gho_" + "B" * 40]
    for rule in secrets.RULES:
        for text in texts:
            if re.search(rule.pattern, text):
                assert holds(trigrams.trigram_query(rule.pattern), text)


def vocabulary(name):
    return bpe.Vocabulary(*bpe.read_vocabulary(public_tokenizers.path(name)))


def by_merging(vocabulary, text):
    parts = list(text)
    while len(parts) > 1:
        ranks = [vocabulary._merge_of(a, b) for a, b in zip(parts, parts[1:])]
        found = [(r, i) for i, r in enumerate(ranks) if r is not None]
        if not found:
            break
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [vocabulary.ids[p] for p in parts]


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json"])
def test_encoding_is_what_merges_give(name):
    words, rng = vocabulary(name), random.Random(4)
    alphabets = ["ab", "aeinrst ", "\xc3\xa9\xa8\xb1", "0123 ", "the and of ing"]
    for _ in range(400):
        piece = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 40)))
        expected = by_merging(words, piece)
        assert words.encode(piece) == expected
        counts = words.prefix_counts(piece)
        assert counts == [len(by_merging(words, piece[:i])) if i else 0 for i in range(len(piece) + 1)]


def test_long_pieces_take_linear_time():
    words = vocabulary("byte_bpe_multi_50k.tiktoken")
    for piece in ("a" * 200_000, " " * 200_000, "abc" * 60_000, "\xc3\xa9" * 100_000):
        ids = words.encode(piece)
        assert "".join(words.tokens[i] for i in ids) == piece


def test_counts_of_every_prefix():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    counter = token_counts.PrefixCounter(vocabulary("byte_bpe_50k.json"))
    texts = [
        "", "We're here, they'll go; I've seen it's", "a   b \n\n c\t \td  ", "x<|endoftext|>  <|endoftext|> y<|endo",
        "  <|endoftext|>", "日本 é😀 'll 're've", "don't 'S 12 345,67\u00a0\u00a0z", "   ", "e" * 90 + " " + "é" * 70,
    ]
    for text in texts:
        expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert counter.counts(text).tolist() == expected


def test_budgets(spark):
    df = spark.createDataFrame([([0, 1, 2, 1, 2, 3],), ([0],)], "c array<int>")
    got = df.select(
        token_counts.tokens_of(F.col("c")), token_counts.longest_within(F.col("c"), 1),
        token_counts.tokens_of(F.col("c"), F.lit(2)), token_counts.budget_of(F.col("c"), [2, 4]),
    )
    assert [tuple(r) for r in got.collect()] == [(3, 3, 2, 4), (0, 0, 0, 2)]


def test_pattern_is_the_library_s():
    assert token_counts.PATTERN == public_tokenizers.PATTERN
    assert regex.compile(token_counts.PATTERN).findall("it's  so") == ["it", "'s", " ", " so"]


def test_signatures_estimate_weighted_similarity():
    rng, k, sets = np.random.default_rng(3), 64, 200
    elements = mixed(np.arange(50, dtype=np.uint64))
    pairs = [(rng.integers(0, 4, 50) * rng.choice([0.5, 1.0], 50), rng.integers(0, 4, 50).astype(float)) for _ in range(sets)]
    agreed, expected = [], []
    for a, b in pairs:
        weights = np.concatenate([a[a > 0], b[b > 0]])
        owners = np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()])
        found = dart_minhash(np.concatenate([elements[a > 0], elements[b > 0]]), weights, owners, 2, k)
        agreed.append((found[0] == found[1]).mean())
        expected.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(agreed) - np.mean(expected)) < 0.01
    assert np.corrcoef(agreed, expected)[0, 1] > 0.5


def test_signatures_depend_on_the_set_alone():
    elements = mixed(np.arange(30, dtype=np.uint64))
    alone = dart_minhash(elements[:10], np.ones(10), np.zeros(10, int), 1, 192)
    owners = np.repeat([0, 1], [20, 10])
    among = dart_minhash(np.concatenate([elements[10:], elements[:10]]), np.ones(30), owners, 3, 192)
    assert (alone[0] == among[1]).all() and np.isinf(among[2]).all()
    assert (band_keys(alone, 32)[0] == band_keys(among, 32)[1]).all()
    tiny = dart_minhash(elements[:1], np.array([0.001]), np.zeros(1, int), 1, 192)
    assert np.isfinite(tiny).all()


def test_links_join_all_similar_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 100)
    sets = []
    for _ in range(60):
        s = base.copy()
        n = rng.integers(0, 25)
        s[rng.choice(100, n, replace=False)] = rng.integers(0, 1 << 60, n)
        sets.append(np.sort(s))
    up = list(range(60))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(60):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if n >= 0.8 * (200 - n):
                up[root(i)] = root(j)
    links, numbers = near_dup._linked(sets, list(range(60)), 0.8, np.ones(60, bool))
    assert len(links) == 60 - len({root(i) for i in range(60)}) == 60 - len(set(numbers.tolist()))
    assert all(root(i) == root(j) for i, j in links)


def test_components(spark):
    rng, edges = random.Random(2), [(i, i + 1) for i in range(200, 260)]
    edges += [(rng.randrange(100), rng.randrange(100)) for _ in range(60)] + [(None, 3), (5, 5), (1, 2), (2, 1)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for _ in label:
        for a, b in edges:
            if a is not None and a != b:
                label[a] = label[b] = min(label[a], label[b])
    least = {}
    for node, name in got.items():
        assert label[node] == label[name]
        least.setdefault(label[node], name)
        assert least[label[node]] == name
    assert got.keys() == label.keys()


def test_winnowing_keeps_a_gram_of_every_shared_passage(spark):
    rng = random.Random(7)
    rows = []
    for i in range(60):
        shared = [f"w{rng.randrange(40)}" for _ in range(10)]
        for side in range(2):
            rows.append((i, side, [f"x{rng.random()}" for _ in range(rng.randrange(6))] + shared + ["y"] * rng.randrange(6)))
    df = spark.createDataFrame(rows, "i long, side long, w array<string>")
    prints = {(r.i, r.side): {p.h for p in r.p} for r in df.select("i", "side", decontaminate.winnow(F.col("w")).alias("p")).collect()}
    assert all(prints[i, 0] & prints[i, 1] for i in range(60))


def test_filter_has_every_key_and_is_sparse(spark):
    keys = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("k"))
    blocks, n = urls.bloom_filter(keys, "k")
    assert n == -(-3000 * urls.BITS_PER_URL // 512) and blocks.count() <= n
    probe = spark.range(20_000).select(F.concat(F.lit("u"), "id").alias("k"))
    bits = urls._bits(F.col("k"))
    hit = F.lit(True)
    for i, bit in enumerate(bits):
        hit = hit & (F.col(f"_w{i}").bitwiseAND(bit) != 0)
    met = probe.withColumn("_block", urls._block(F.col("k"), n)).join(blocks, "_block").where(hit)
    found = {int(r.k[1:]) for r in met.collect()}
    assert set(range(3000)) <= found and len(found) < 3000 + 17_000 * 0.02


def test_shards_follow_weights_and_move_little(spark):
    rows = spark.range(20_000)
    got = sharding.shard_rows(rows, "id", [1.0, 1.0, 2.0], [1.0, 1.0, 2.0, 1.0]).collect()
    share = Counter(r.shard for r in got)
    assert abs(share[2] / 20_000 - 0.5) < 0.02 and abs(share[0] / 20_000 - 0.25) < 0.02
    assert all(r.grown_shard in (r.shard, 3) for r in got)
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [1.0, 0.0])
