"""Registered queries over whole sample tables, against SQL, libraries and plain versions."""

import base64
import glob
import os
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import corpus_pipeline
from subledger.llm import near_dup, quality, urls
from subledger.llm.queries import LISTED_SITES, ORACLE, QUERIES, URL_RULES
from tests.conftest import DATA
from tests.llm import plain


@pytest.fixture(scope="module")
def documents(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def benchmark_items(spark):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]


def rows(spark, name):
    return {r[0]: r for r in QUERIES[name](spark, DATA).collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    expected = connection.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    got = sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
    assert got == sorted(tuple(map(str, r)) for r in expected.fetchall())


def test_secrets(spark, documents):
    got = rows(spark, "op1_secret_scan")
    assert {i: tuple(got[i][1:5]) for i in got} == {i: plain.secrets(t) for i, t in documents}


def test_token_counts(spark, documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = rows(spark, "op3_token_counts")
    for i, text in documents:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert tuple(got[i][:4]) == (i, len((text or "").encode()), n, n > 512)
        cut = got[i].chars_within_limit
        assert len(library.encode((text or "")[:cut], add_special_tokens=False).ids) <= 512


def test_quality(spark, documents):
    got = rows(spark, "op4_quality_rules")
    assert {i: tuple(got[i][1:7]) for i in got} == {i: plain.quality(t) for i, t in documents}
    assert not any(r.kept and r.base_failed for r in got.values())


def test_quality_agrees_with_labels(spark):
    """Every document labelled as bad is rejected, and no good one that passes the base is."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    got = rows(spark, "op4_quality_rules")
    assert not any(got[i].kept for i, q in labels.items() if q == 0)
    assert all(got[i].kept or got[i].base_failed for i, q in labels.items() if q == 1)


def test_urls(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url").collect()
    got = rows(spark, "op5_url_filter")
    for i, url in pages:
        host, path = plain.url(url)
        fitting = [
            (len(h + p), h + p, kind)
            for kind, h, p in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        listed = any(site in host.split(".") for site in LISTED_SITES)
        rule = max(fitting, default=(0, None, "block" if listed else "allow"))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule[1], rule[2])


def test_byte_bpe(spark, documents):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, "op6_byte_bpe")
    for i, text in documents:
        ids = library.encode_ordinary(text or "")
        assert tuple(got[i]) == (i, len(ids), plain.sha(",".join(map(str, ids))), plain.sha(text or ""))


def test_near_duplicates(spark, documents):
    got = rows(spark, "op8_near_duplicates")
    assert {i: tuple(got[i][1:]) for i in got} == plain.classes(documents)


def test_shards(spark, documents):
    got = rows(spark, "op9_rendezvous_shards")
    slots = defaultdict(list)
    for i, text in documents:
        r, data = got[i], (text or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_decontamination(spark, documents, benchmark_items):
    got = rows(spark, "op10_decontaminate")
    for i, n_words, n_hit, items in plain.contamination(documents, benchmark_items):
        expected = (i, n_words, n_hit, len(items), plain.sha(",".join(items)), n_hit > 0)
        r = got[i]
        assert (r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == expected


def test_pipeline(spark, documents, benchmark_items):
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, DATA).collect()}
    judged = {r.doc_id: r.kept for r in quality.quality_rules(spark.read.parquet(f"{DATA}/documents.parquet")).collect()}
    good = [(i, t) for i, t in documents if judged[i]]
    members = defaultdict(list)
    for i, (least, _) in plain.classes(good).items():
        members[least].append(i)
    texts = dict(documents)
    clean = {i for i, _, n, _ in plain.contamination(good, benchmark_items) if not n}
    assert len(got) == sum(1 for m in members.values() if any(i in got for i in m))
    assert all(sum(i in got for i in m) == 1 for m in members.values() if all(i in clean for i in m))
    assert got.keys() <= clean and all(r.decodes for r in got.values())
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, r in got.items():
        back = library.decode(r.ids)
        assert plain.secrets(back)[:3] == (0, 0, 0)
        if plain.secrets(texts[i])[:3] == (0, 0, 0):
            assert back == texts[i]


def test_list_is_joined_exactly(spark):
    """With a filter of two bits a URL nearly everything is a possible hit; verdicts don't change."""
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url")
    targets = pages.where("page_id % 7 = 0")
    found = urls.on_list(pages, "url", targets, "url", bits_per_url=2).where("listed")
    assert sorted(r.page_id for r in found.collect()) == sorted(r.page_id for r in targets.collect())


def test_families_in_blocks(spark, documents):
    """Families split into buckets and blocks have the classes of families compared whole."""
    df = spark.createDataFrame(documents, "doc_id long, text string")
    got = near_dup.near_duplicates(df, group_nodes=4).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == plain.classes(documents)
