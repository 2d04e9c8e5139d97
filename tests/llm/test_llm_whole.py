"""Whole jobs: what earlier versions cut, refused or left to the size of the input."""

from subledger.llm import near_dup
from subledger.llm.queries import QUERIES
from tests.llm import plain

PAGES = "/root/testdata/sf0.01"
JUNK = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def test_pages_of_all_junk_sites_are_listed(spark):
    got = QUERIES["op5_url_filter"](spark, PAGES).collect()
    junk = [r for r in got if any(site in r.host.split(".") for site in JUNK)]
    assert {site for site in JUNK if any(site in r.host for r in junk)} == set(JUNK)
    assert all(r.listed for r in junk)
    assert all(r.verdict == "block" for r in junk if r.rule is None)
    assert sum(r.verdict == "allow" for r in junk) == 2


def test_rows_of_one_key_meet_only_their_own_node(spark, monkeypatch):
    """All rows share the null key; each text goes once to the comparison, not once for every node."""
    texts = [" ".join(f"w{pair}x{i}" for i in range(40)) + f" end{side}" for pair in range(20) for side in range(2)]
    seen, sets = [], near_dup._sets

    def counted(rows, size):
        seen.append(rows.count())
        return sets(rows, size)

    monkeypatch.setattr(near_dup, "_sets", counted)
    df = spark.createDataFrame([(None, t) for t in [*texts, texts[0]]], "doc_id long, text string")
    got = sorted(r.class_size for r in near_dup.near_duplicates(df).collect())
    assert got == [2] * 38 + [3] * 3
    assert sum(seen) <= len(texts) + 1


def test_blocks_are_bounded_in_runs(spark, monkeypatch):
    """Few nodes with many runs of words get as many blocks as their runs fill."""
    monkeypatch.setattr(near_dup, "GROUP_SHINGLES", 1_000)
    told = [(1, bytes([i]), 100, bytes([i])) for i in range(40)] + [(1, bytes([50 + i]), 300, b"p") for i in range(10)]
    told += [(2, bytes([i]), 1, bytes([i])) for i in range(6)] + [(3, b"a", 9_000, b"a"), (3, b"b", 9_000, b"a")]
    df = spark.createDataFrame(told, "_group long, _node binary, _n long, _part binary")
    found = {(r._group, bytes(r._own), r._blocks) for r in near_dup._blocks(df, 8).collect()}
    assert found == {(1, b"", 10), (1, b"p", 6), (2, b"", 2)}
