"""Keys, merges, joins, pivots, cleaning, dates."""

import datetime as dt
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from subledger import Spine
from subledger.functions import dates, scalars
from subledger.operators import cleaning, joins, keys, merge, pivots
from subledger.plans.pivots import pivot_renewal_term


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_dedupe_takes_first_and_last_with_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, 10, "a"), (1, 20, "b"), (1, 20, "c"), (2, None, "d"), (None, 1, "e"), (None, 2, "f")],
        "k int, t int, v string",
    )
    assert tuples(keys.dedupe(df, ["k"], ["t"], "last")) == [(1, 20, "c"), (2, None, "d"), (None, 2, "f")]
    assert tuples(keys.dedupe(df, ["k"], ["t"], "first")) == [(1, 10, "a"), (2, None, "d"), (None, 1, "e")]


def test_first_per_key_skips_nulls_per_column(spark):
    df = spark.createDataFrame(
        [("a", 2, "x", None, 1.0), ("a", 1, None, 7, None), ("b", 1, None, None, None), (None, 1, "z", 1, 1.0)],
        "k string, o int, x string, y int, m double",
    )
    got = keys.first_per_key(df, ["k"], ["o"], ["x", "y"], ["m"])
    assert tuples(got) == [("a", "x", 7, 1.0), ("b", None, None, 0.0)]


def test_key_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    assert tuples(keys.key_violations(df, ["k"])) == [(1, 2), (None, 1)]
    with pytest.raises(ValueError):
        keys.assert_unique(df, ["k"])
    assert keys.assert_unique(df.where("k = 2"), ["k"]).count() == 1


def test_row_index_is_gapless_over_partitions(spark):
    df = spark.range(0, 1000, numPartitions=7).select((F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    got = keys.with_row_index(df, ["a", "b"]).orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(1000))
    assert [(r["a"], r["b"]) for r in got] == sorted((i % 3, i) for i in range(1000))


TARGET = "k int, a string, b int"


def test_upsert_all_columns_last_update_wins(spark):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], TARGET)
    updates = spark.createDataFrame([(2, "old", 5, 1), (2, "new", 6, 2), (3, "z", 7, 1)], TARGET + ", t int")
    got = merge.upsert(target, updates, ["k"], order=["t"]).select("k", "a", "b")
    assert tuples(got) == [(1, "x", 1), (2, "new", 6), (3, "z", 7)]


def test_upsert_partial_columns_and_absent_key(spark):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], TARGET)
    updates = spark.createDataFrame([(2, None), (3, 9)], "k int, b int")
    assert tuples(merge.upsert(target, updates, ["k"], update_cols=["b"])) == [(1, "x", 1), (2, "y", None), (3, None, 9)]


def test_upsert_ignore(spark):
    target = spark.createDataFrame([(1, "x", 1)], TARGET)
    updates = spark.createDataFrame([(1, "n", 9), (2, "m", 9)], TARGET)
    assert tuples(merge.upsert(target, updates, ["k"], mode="ignore")) == [(1, "x", 1), (2, "m", 9)]


def test_upsert_partial_adds_a_new_column(spark):
    target = spark.createDataFrame([(1, "x", 1)], TARGET)
    updates = spark.createDataFrame([(1, 5.0), (2, 6.0)], "k int, c double")
    got = merge.upsert(target, updates, ["k"], update_cols=["c"])
    assert got.columns == ["k", "a", "b", "c"]
    assert tuples(got) == [(1, "x", 1, 5.0), (2, None, None, 6.0)]


ROWS = st.lists(st.tuples(st.integers(0, 5), st.sampled_from("abc"), st.integers(0, 3)), max_size=12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=ROWS, updates=ROWS)
def test_upsert_is_idempotent_and_keyed(spark, target, updates):
    unique = {r[0]: r for r in target}
    t = spark.createDataFrame(list(unique.values()), TARGET)
    u = spark.createDataFrame(updates, TARGET)
    once = merge.upsert(t, u, ["k"], order=["b"])
    assert tuples(merge.upsert(once, u, ["k"], order=["b"])) == tuples(once)
    best = {}
    for k, a, b in updates:
        best[k] = max(best.get(k, (k, "", -1)), (k, a, b), key=lambda r: (r[2], r[1]))
    assert tuples(once) == sorted(({**unique, **best}).values(), key=str)


def test_evolve_and_delete(spark):
    target = spark.createDataFrame([(1, "x")], "k int, a string")
    batch = spark.createDataFrame([(2, True)], "k int, flag boolean")
    assert tuples(merge.append(target, batch)) == [(1, "x", None), (2, None, True)]
    assert tuples(merge.delete_keys(target, batch.select((F.col("k") - 1).alias("k")), ["k"])) == []


def test_join_indicator_matches_null_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n")], "k int, v string")
    assert tuples(joins.join_indicator(left, right, ["k"])) == [
        (1, "a", True), (1, "b", True), (2, None, False), (None, "n", True),
    ]
    assert tuples(joins.without_matches(left, right, ["k"])) == [(2,)]


@pytest.mark.parametrize("values,expected", [([1], [(2,)]), ([1, None], []), ([], [(1,), (2,), (None,)]), ([None], [])])
def test_not_in_follows_sql(spark, values, expected):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(v,) for v in values], "v int")
    assert tuples(joins.not_in(left, "k", right)) == expected
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    assert tuples(spark.sql("select k from l where k not in (select v from r)")) == expected


def test_all_matched(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("b", False)], "g string, f boolean")
    assert tuples(joins.all_matched(df, ["g"], "f")) == [("a",)]


def test_star_join_roles_and_misses(spark):
    fact = spark.createDataFrame([(1, 10, 20), (2, 10, None)], "id int, agent int, auditor int")
    user = spark.createDataFrame([(10, "ann"), (20, "bob")], "uid int, name string")
    wide = joins.star_join(
        fact,
        [
            joins.Dimension(user, {"agent": "uid"}, {"name": "agent_name"}),
            joins.Dimension(user, {"auditor": "uid"}, {"name": "auditor_name"}),
        ],
    )
    assert tuples(wide.select("id", "agent_name", "auditor_name")) == [(1, "ann", "bob"), (2, "ann", None)]


def test_pivot_leaves_nulls_out_and_totals(spark):
    rows = [("d1", "x"), ("d1", "x"), ("d1", None), (None, "x"), ("d2", "y"), ("d3", None)]
    df = spark.createDataFrame(rows, "d string, c string")
    table = pivots.count_pivot(df, "d", "c", ["x", "y"], total="all")
    assert tuples(table) == [("d1", 2, None, None, 2), ("d2", None, 1, None, 1)]
    assert tuples(pivots.count_pivot(df, "d", "c")) == [("d1", 2, None), ("d2", None, 1)]
    assert ("Total", 2, 1, None, 3) in tuples(pivots.with_total_row(table, "d"))
    sums = spark.createDataFrame([("d1", None), ("d2", 1.5), (None, 9.0)], "d string, m double")
    assert tuples(pivots.grouped_sums(sums, ["d"], "m", "m")) == [("d1", 0.0), ("d2", 1.5)]


def test_cleaning(spark):
    df = spark.createDataFrame([(1, "a\x00b", None), (None, None, 2.0)], "i int, s string, x double")
    assert tuples(cleaning.clean_strings(df)) == [(1, "ab", None), (None, None, 2.0)]
    assert tuples(cleaning.fill_sentinel(df, "###")) == [(1, "a\x00b", None), (None, "###", 2.0)]
    assert tuples(cleaning.fill_sentinel(df, "-", as_string=True)) == [("-", "-", "2.0"), ("1", "a\x00b", "-")]
    bad = spark.sql("select cast(x'61ff62' as string) as s")
    assert cleaning.clean_strings(bad).head()["s"] == "a�b"


def test_scalars(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("abc",), (" ",), (None,)], "s string")
    assert [r[0] for r in df.select(scalars.to_number(F.col("s"))).collect()] == [1.5, 2.0, None, None, None]
    df = spark.createDataFrame([("a.b.com",), ("host",), ("",), (None,)], "d string")
    got = df.select(scalars.last_label(F.col("d")), scalars.domain_extension(F.col("d"))).collect()
    assert [tuple(r) for r in got] == [("com", ".com"), ("host", ".host"), ("", ""), (None, "")]
    df = spark.createDataFrame([("true",), ("false",), ("x",), (None,)], "f string")
    assert [r[0] for r in df.select(scalars.to_flag(F.col("f"))).collect()] == [True, False, None, None]


def test_normalise_only_present_columns(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05Z", "bad", 1)], "created string, updated string, n int")
    got = cleaning.normalise_timestamps(df, ["created", "updated", "absent"]).head()
    assert got["created"] == dt.datetime(2024, 1, 2, 3, 4, 5) and got["updated"] is None


def test_rename_labels(spark):
    df = spark.createDataFrame([(1, 2)], "`Rate Plan: ID` int, other int")
    assert cleaning.rename_labels(df, {"Rate Plan: ID": "rp_id", "x": "y"}).columns == ["rp_id", "other"]


def test_spines(spark):
    days = [str(r[0]) for r in Spine.of("2024-02-27", "2024-03-02").frame(spark).collect()]
    assert days == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01", "2024-03-02"]
    months = [str(r[0]) for r in Spine.of("2024-01-02", "2024-04-01", "month").frame(spark).collect()]
    assert months == ["2024-02-01", "2024-03-01", "2024-04-01"]
    assert Spine.of("2024-01-02", "2024-01-20", "month").frame(spark).count() == 0
    back = Spine.lookback(dt.date(2024, 3, 10), 2)
    assert (back.start, back.end) == (dt.date(2024, 3, 8), dt.date(2024, 3, 9))
    with pytest.raises(ValueError):
        Spine.of("2024-01-02", "2024-01-01")


@pytest.mark.parametrize("step", ["day", "month"])
def test_first_report_date_by_brute_force(spark, step):
    spine = Spine.of("2023-12-15", "2024-06-20", step)
    listed = sorted(r[0] for r in spine.frame(spark).collect())
    days = spark.range(-40, 260).select(F.date_add(F.lit("2023-12-15").cast("date"), F.col("id").cast("int")).alias("d"))
    for r in days.select("d", spine.on_or_after(F.col("d")).alias("f"), spine.contains(F.col("d")).alias("c")).collect():
        assert r.f == next((x for x in listed if x >= r.d), None)
        assert r.c == (r.d in listed)
    assert spark.range(1).select(spine.on_or_after(F.lit(None).cast("date"))).head()[0] is None


@pytest.mark.parametrize("step", ["day", "month"])
def test_ranges_written_out_by_brute_force(spark, step):
    spine = Spine.of("2023-12-15", "2024-03-20", step)
    listed = sorted(r[0] for r in spine.frame(spark).collect())
    assert listed == spine.date_list()
    ends = [None, *(dt.date(2023, 12, 1) + dt.timedelta(days=d) for d in (0, 13, 14, 15, 31, 32, 62, 91, 110, 111, 140))]
    pairs = [(i, lo, hi) for i, (lo, hi) in enumerate((lo, hi) for lo in ends for hi in ends)]
    df = spark.createDataFrame(pairs, "i int, lo date, hi date")
    want = sorted((i, d) for i, lo, hi in pairs for d in listed if lo is not None and lo <= d and (hi is None or d < hi))
    got = spine.expand(df, F.col("lo"), F.col("hi"))
    assert sorted((r.i, r.report_date) for r in got.collect()) == want
    text = spine.expand(df, F.col("lo"), F.col("hi"), name="on", text=True)
    assert sorted((r.i, r.on) for r in text.collect()) == [(i, d.isoformat()) for i, d in want]
    assert text.columns == ["i", "lo", "hi", "on"] and dict(text.dtypes)["on"] == "string"
    none = Spine.of("2024-01-02", "2024-01-20", "month")
    assert none.expand(df, F.col("lo"), F.col("hi"), text=True).count() == 0


def test_latest_of_needs_every_date(spark):
    df = spark.sql("select date'2024-01-01' a, date'2024-01-02' b, cast(null as date) c")
    got = df.select(dates.latest_of(F.col("a"), F.col("b")), dates.latest_of(F.col("a"), F.col("c"))).head()
    assert (str(got[0]), got[1]) == ("2024-01-02", None)


def test_upsert_keeps_columns_the_batch_lacks(spark):
    target = spark.createDataFrame([(1, "p", 10), (2, "q", 20)], "k int, a string, b int")
    batch = spark.createDataFrame([(2, "x"), (3, "y")], "k int, a string")
    got = sorted(tuple(r) for r in merge.upsert(target, batch, ["k"]).collect())
    assert got == [(1, "p", 10), (2, "x", 20), (3, "y", None)]


def test_letters_do_not_make_numbers(spark):
    texts = ["12F", "5d", "12", " 1e3 ", "-.5", "1.", "abc", "", None, "0x1", "1e", "٣"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(scalars.to_number(F.col("t"))).collect()]
    assert got == [None, None, 12.0, 1000.0, -0.5, 1.0, None, None, None, None, None, None]


def test_long_pivot_of_many_categories(spark):
    """More categories than columns may be made of, a third of all rows in one pair."""
    from collections import Counter

    rows = [("d1", f"c{i}") for i in range(12_000)] + [("d2", "c7")] * 6_000 + [("d2", None), (None, "c1")]
    df = spark.createDataFrame(rows, "d string, c string")
    known = Counter(r for r in rows if None not in r)
    got = pivots.count_long(df, "d", "c", totals=True).collect()
    pairs = {(r["d"], r["c"]): r["row_count"] for r in got if not r["all_d"] and not r["all_c"]}
    assert pairs == known
    assert {r["d"]: r["row_count"] for r in got if r["all_c"] and not r["all_d"]} == {"d1": 12_000, "d2": 6_000}
    assert {r["c"]: r["row_count"] for r in got if r["all_d"] and not r["all_c"]} == Counter(c for _, c in known.elements())
    assert [tuple(r) for r in got if r["all_d"] and r["all_c"]] == [(None, None, True, True, 18_000)]
    assert pivots.count_long(df, "d", "c", "n").columns == ["d", "c", "n"]
    assert pivots.count_long(df.where("false"), "d", "c", totals=True).count() == 0


def test_pivots_count_every_row(spark):
    rows = [("d", "A"), ("d", "B"), ("d", "OTHER"), ("e", "OTHER"), ("d", None), (None, "A")]
    df = spark.createDataFrame(rows, "d string, c string")
    got = pivots.count_pivot(df, "d", "c", ["A", "B", "C"], total="all")
    assert got.columns == ["d", "A", "B", "C", "other", "all"]
    assert tuples(got) == [("d", 1, 1, None, 1, 3), ("e", None, None, None, 1, 1)]
    found = pivots.count_pivot(df, "d", "c", total="all")
    assert tuples(found.select("d", "A", "B", "OTHER", "all")) == [("d", 1, 1, 1, 3), ("e", None, None, 1, 1)]
    terms = spark.createDataFrame([("d", t) for t in (1, 12, 24, None)], "report_date string, renewal_term int")
    assert tuples(pivot_renewal_term(terms, [12, 24])) == [("d", 1, 1, 2, 4)]


def test_rows_that_point_at_nothing_are_dealt_out(spark):
    """A fact of which most keys are null is not gathered in one partition."""
    fact = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("k"))
    table = spark.range(0, 1000, 20).select(F.col("id").alias("key"), F.lit("x").alias("v"))
    joined = joins.star_join(fact, [joins.Dimension(table.hint("merge"), {"k": "key"}, {"v": "v"})])
    assert joined.columns == ["id", "k", "v"] and joined.count() == 1000 and joined.where("v = 'x'").count() == 50
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [" in plan and re.search(r"hashpartitioning\(_n0#\d+L, k#\d+L|hashpartitioning\(k#\d+L, _n0#\d+L", plan)
