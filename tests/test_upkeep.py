"""Sets of dates, stored reports, lookups by interval and time, rejects and the stream with state."""

import datetime as dt
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from subledger import Spine
from subledger.operators import date_bits, merge
from subledger.operators.asof import as_of_join
from subledger.operators.intervals import interval_lookup
from subledger.operators.rejects import REASONS, checked, load_with_rejects
from subledger.plans import daily
from subledger.plans.daily_store import DailyStore
from subledger.session import scratch_path, scratch_table
from subledger.sources import tables
from subledger.streaming.newest import run_newest_stream
from subledger.streaming.stream import stream_parquet
from workload import inputs
from workload.reports import FACT_KEY


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("spine", [Spine.of("2024-01-10", "2024-06-20"), Spine.of("2023-11-15", "2030-02-01", "month")])
def test_date_sets_hold_the_dates_of_a_range(spark, spine):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    rows = [(i, day(a), None if b is None else day(b)) for i, (a, b) in enumerate([(-90, 5), (9, 10), (0, None), (70, 900), (400, 30), (3000, None)])]
    df = spark.createDataFrame(rows, "k int, lo date, hi date")
    first, last = date_bits.positions(spine, F.col("lo"), F.col("hi"))
    ranged = df.select("k", first.alias("f"), last.alias("l"))
    found = date_bits.by_date(date_bits.words(ranged, "f", "l"), spine, "d")
    every = [r.d for r in spine.frame(spark, "d").collect()]
    assert spine.size() == len(every)
    assert tuples(found.select("k", "d")) == sorted(((k, d) for k, lo, hi in rows for d in every if lo <= d and (hi is None or d < hi)), key=str)


def test_stored_report_follows_batches(spark, data):
    """Repeated, late and corrected batches; a subscription whose rows no longer count anything."""
    z = inputs.facts(spark, data).where("account_id IN ('A1', 'A2', 'A3', 'A4', 'A5', 'A6', 'A7')")
    store = DailyStore(*(scratch_table(spark, n) for n in ("f", "s", "t")), FACT_KEY, inputs.DAYS.start, buckets=4)
    wrong = z.withColumn("mrr", F.lit(1).cast("decimal(18,2)")).withColumn("cancelled", F.date_add("term_start", 3))
    store.load(wrong.where("sub_name <> 'S5'"))
    before = {f for f in tables.read_table(spark, store.steps).inputFiles()}
    store.load(z.where("sub_name = 'S1'"))
    after = {f for f in tables.read_table(spark, store.steps).inputFiles()}
    touched = spark.range(1).select(tables.bucket_of([F.lit("S1")], 4)).first()[0]
    mark = f"{tables.BUCKET}={touched}/"
    assert {f for f in before if mark not in f} == {f for f in after if mark not in f}
    for _ in range(2):
        store.load(z)
    store.load(z.where("false"))
    expected = daily.daily_report(z, inputs.DAYS)
    got = store.report(spark, inputs.DAYS.end)
    columns = expected.columns
    assert sorted(got.columns) == sorted(columns)
    plain = lambda df: Counter(tuple(None if v is None else str(float(v)) if c[:3] in ("mrr", "tcv") else str(v) for c, v in zip(columns, r)) for r in df.select(columns).collect())
    assert plain(got) == plain(expected)
    early = Spine(inputs.DAYS.start, dt.date(1997, 6, 30))
    assert plain(store.report(spark, early.end)) == plain(daily.daily_report(z, early))
    # Rows that never count leave their bucket without steps.
    store.load(z.withColumns({"term_start": F.lit(None).cast("date"), "rp_created": F.lit(None).cast("timestamp")}))
    assert store.report(spark, inputs.DAYS.end).count() == 0


def test_interval_lookup(spark, capsys):
    random.seed(3)
    cuts = sorted(random.sample(range(-5000, 5000), 60))
    spans = [(a, b) for a, b in zip(cuts[::2], cuts[1::2])] + [(1 << 40, 1 << 61), (-(1 << 62), -(1 << 50))]
    points = [*range(-5100, 5100, 7), 1 << 40, (1 << 61) - 1, 1 << 61, -(1 << 62), -(1 << 62) - 1, -(1 << 50), None]
    points += [x + d for span in spans[:30] for x in span for d in (-1, 0)]
    rows = spark.createDataFrame([(p,) for p in points], "p long")
    intervals = spark.createDataFrame([(f"{a}", a, b) for a, b in spans] + [("empty", 7, 7), ("open", 8, None)], "n string, a long, b long")
    expected = [(p, n) for p in points for n in [next((f"{a}" for a, b in spans if p is not None and a <= p < b), None)]]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = interval_lookup(rows, "p", intervals, "a", "b", how="left")
        assert tuples(found.select("p", "n")) == sorted(expected, key=str)
        found.explain("simple")
        assert "NestedLoop" not in capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    inner = interval_lookup(rows, "p", intervals, "a", "b")
    assert tuples(inner.select("p", "n")) == sorted((x for x in expected if x[1]), key=str)
    for extra in ((-6000, 5000), spans[3], (spans[4][0] + 1, spans[4][0] + 2)):
        with pytest.raises(ValueError, match="overlap"):
            interval_lookup(rows, "p", intervals.union(spark.createDataFrame([("x", *extra)], "n string, a long, b long")), "a", "b")
    days = spark.createDataFrame([(dt.date(2024, 1, 5),), (dt.date(2024, 2, 1),)], "d date")
    months = spark.createDataFrame([("jan", dt.date(2024, 1, 1), dt.date(2024, 2, 1))], "m string, a date, b date")
    assert tuples(interval_lookup(days, "d", months, "a", "b").select("d", "m")) == [(dt.date(2024, 1, 5), "jan")]


def test_as_of_join_with_a_hot_key(spark):
    """A third of all rows and versions is of one key, some tie, some are null."""
    random.seed(4)
    keys = [0] * 700 + [random.randrange(1, 200) for _ in range(1400)] + [None] * 10
    rows = [(k, random.choice([None, *range(60)]), i) for i, k in enumerate(keys)]
    versions = [(random.choice([0, 0, 0, *range(1, 200), None]), random.choice([None, *range(60)]), i, random.choice(["x", None])) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, at int, i int").repartition(6)
    vs = spark.createDataFrame(versions, "k int, since int, v int, w string").repartition(6)
    expected = []
    for k, at, i in rows:
        fitting = [(since, v, w) for vk, since, v, w in versions if None not in (k, at, vk, since) and vk == k and since <= at]
        best = max(fitting, key=lambda x: x[:2], default=(None, None, None))
        expected.append((k, at, i, best[1], best[2]))
    got = as_of_join(df, vs, ["k"], "at", "since", ["v", "w"], tie=["v"])
    assert got.columns == ["k", "at", "i", "v", "w"]
    assert tuples(got) == sorted(expected, key=str)


SCHEMA = "k long not null, n int, d date"


def test_rejects_have_their_reasons(spark):
    df = spark.createDataFrame(
        [("1", "5", "2024-01-01"), ("x", "5", None), (None, "no", "2024-13-01"), ("2", "-1", None), ("1", "4", None), ("1", "x", None)],
        "k string, n string, d string",
    )
    got = checked(df, SCHEMA, {"n not negative": F.col("n") >= 0}, ["k"], ["n"])
    reasons = {(r._row.k, r._row.n): r[REASONS] for r in got.collect()}
    assert reasons == {
        ("1", "4"): [],
        ("1", "5"): ["k occurs before"],
        ("x", "5"): ["k is no bigint"],
        (None, "no"): ["n is no int", "d is no date", "k is null"],
        ("2", "-1"): ["n not negative"],
        ("1", "x"): ["n is no int"],
    }
    good = got.where(F.size(REASONS) == 0).select("_typed.*")
    assert tuples(good) == [(1, 4, None)]


def test_load_with_rejects_is_whole_and_can_be_repeated(spark):
    df = spark.range(300).selectExpr("IF(id % 3 = 0, 'bad', CAST(id % 50 AS STRING)) AS k", "CAST(id AS STRING) AS n", "'2024-01-01' AS d")
    name, rejects = scratch_table(spark, "t"), scratch_table(spark, "r")
    for _ in range(2):
        load_with_rejects(df, name, rejects, SCHEMA, "b1", key=["k"], order=["n"])
        good, bad = tables.read_table(spark, name), tables.read_table(spark, rejects)
        assert good.count() + bad.count() == 300 and good.count() == 50
    load_with_rejects(df.where("k <> 'bad'"), name, rejects, SCHEMA, "b2", key=["k"], order=["n"])
    assert bad.where("batch_id = 'b1'").count() == 250
    plain = scratch_table(spark, "t")
    load_with_rejects(df.where("k = 'bad'"), plain, rejects, SCHEMA, "b3")
    assert not tables.table_exists(spark, plain)


def test_newest_versions_survive_a_restart(spark):
    random.seed(5)
    rows = [(random.randrange(30), random.choice([None, *range(100)]), i, random.choice(["x", None])) for i in range(600)]
    landed, name, progress = scratch_path(spark, "in"), scratch_table(spark, "newest"), scratch_path(spark, "progress")
    schema = "k long, t int, i int, v string"
    for part in range(3):
        some = spark.createDataFrame(rows[part * 200 : (part + 1) * 200], schema)
        some.repartition(3).write.mode("append").parquet(landed)
        run_newest_stream(stream_parquet(spark, landed, schema, files_per_batch=1), name, progress, ["k"], ["t", "i"], buckets=4)
        newest = {}
        for r in rows[: (part + 1) * 200]:
            if r[0] not in newest or (r[1] is not None, r[1] or 0, r[2]) > (newest[r[0]][1] is not None, newest[r[0]][1] or 0, newest[r[0]][2]):
                newest[r[0]] = r
        assert tuples(tables.read_table(spark, name).drop(tables.BUCKET)) == sorted(newest.values(), key=str)


def test_upsert_inserts_whole_rows_and_refuses_null_keys(spark):
    target = spark.createDataFrame([(1, "x", 1)], "k int, a string, b int")
    updates = spark.createDataFrame([(1, "y", 5, 7), (2, "z", 6, 8)], "k int, a string, b int, c int")
    got = merge.upsert(target, updates, ["k"], update_cols=["b"]).select("k", "a", "b", "c")
    assert tuples(got) == [(1, "x", 5, None), (2, "z", 6, 8)]
    with pytest.raises(Exception, match="null in the key k"):
        merge.upsert(target, target.withColumn("k", F.lit(None).cast("int")), ["k"]).collect()


def test_a_stored_batch_is_written_once(spark, monkeypatch):
    from subledger.plans import daily_store

    made = []
    staged = tables.staged
    for module in (tables, daily_store):
        monkeypatch.setattr(module, "staged", lambda df: made.append(df.columns) or staged(df))
    z = inputs.facts(spark, "/root/testdata/sf0.001").where("account_id = 'A1'")
    store = DailyStore(*(scratch_table(spark, n) for n in ("f", "s", "t")), FACT_KEY, inputs.DAYS.start, buckets=2)
    store.load(z)
    assert len(made) == 1


@pytest.mark.parametrize("rows_at_once, most", [(1, 1), (400, 3)])
def test_a_load_takes_few_buckets_at_once_and_leaves_no_shuffle_files(spark, data, monkeypatch, rows_at_once, most):
    from subledger.plans import daily_store

    taken = []
    monkeypatch.setattr(daily_store, "overwrite_partitions", lambda df, *a: taken.append(df.select(tables.BUCKET).distinct().count()) or tables.overwrite_partitions(df, *a))
    z = inputs.facts(spark, data).where("substr(account_id, 2) % 10 = 1")
    wrong = z.withColumn("mrr", F.lit(1).cast("decimal(18,2)"))
    store = DailyStore(*(scratch_table(spark, n) for n in ("f", "s", "t")), FACT_KEY, inputs.DAYS.start, buckets=4, rows_at_once=rows_at_once)

    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(",")
        return {b.split("_")[1] for b in blocks.split(",") if b.startswith("shuffle_")}

    before, free = shuffles(), spark.conf.get(tables._FREE)
    store.load(wrong.where("sub_name <> 'S5'"))
    store.load(z)
    assert spark.conf.get(tables._FREE) == free
    until = time.time() + 10  # files go on another thread
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert taken and max(taken) <= most
    expected, got = daily.daily_report(z, inputs.DAYS), store.report(spark, inputs.DAYS.end)
    columns = expected.columns
    plain = lambda df: Counter(tuple(None if v is None else str(float(v)) if c[:3] in ("mrr", "tcv") else str(v) for c, v in zip(columns, r)) for r in df.select(columns).collect())
    assert plain(got) == plain(expected)


def test_a_spine_without_end_lists_no_dates(spark, monkeypatch):
    far = dt.date(9999, 12, 31)
    found = [Spine(dt.date(2024, 1, 2), end, step) for end in (dt.date(2024, 3, 5), far) for step in ("day", "month")]
    last = [spine.date_list()[-1] for spine in found]
    monkeypatch.setattr(Spine, "date_list", lambda self: pytest.fail("dates are listed"))
    for spine, date in zip(found, last):
        days = spark.createDataFrame([(date,), (min(date, far - dt.timedelta(1)) + dt.timedelta(1),)], "d date")
        assert [r[0] for r in days.select(spine.reaches(F.col("d"))).collect()] == [True, date == far]


def test_a_null_key_changes_no_bucket(spark, data):
    z = inputs.facts(spark, data).where("account_id IN ('A1', 'A2', 'A3', 'A4')")
    store = DailyStore(*(scratch_table(spark, n) for n in ("f", "s", "t")), FACT_KEY, inputs.DAYS.start, buckets=4, rows_at_once=1)
    with pytest.raises(Exception, match="null in the key"):
        store.load(z.withColumn("rp_id", F.when(F.xxhash64("sub_id") % 7 != 0, F.col("rp_id"))))
    assert not any(tables.table_exists(spark, t) for t in (store.facts, store.steps, store.totals))
