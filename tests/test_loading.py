"""Tables, readers, incremental loads and the stream, on a scratch folder."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from subledger.session import scratch_path, scratch_table, shared_dir, shuffle_partitions
from subledger.sources import readers, tables
from subledger.streaming import incremental, stream


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test")


@pytest.fixture
def name(spark):
    return scratch_table(spark, "test")


def test_shared_dir_is_the_configured_one(spark):
    folder = shared_dir(spark)
    assert spark.conf.get("spark.checkpoint.dir") == folder == shared_dir(spark)


def test_shuffle_partitions_follow_the_size():
    assert shuffle_partitions(1) == 8
    assert shuffle_partitions(1 << 40) == 4096


def test_replace_reads_its_own_table(spark, name):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.replace_table(df, name)
    tables.replace_table(tables.read_table(spark, name).where("k = 2"), name)
    assert tuples(tables.read_table(spark, name)) == [(2, "b")]


def test_replaced_table_has_the_new_columns_only(spark, name):
    tables.replace_table(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    tables.replace_table(spark.createDataFrame([(2, 3)], "k int, n int"), name)
    assert tuples(tables.read_table(spark, name)) == [(2, 3)]


def test_a_load_that_fails_leaves_the_table(spark, name):
    tables.replace_table(spark.createDataFrame([(1,), (2,)], "k int"), name)
    broken = tables.read_table(spark, name).withColumn("k", F.when(F.col("k") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("k")).cast("int"))
    with pytest.raises(Exception, match="no"):
        tables.replace_table(broken, name)
    assert tuples(tables.read_table(spark, name)) == [(1,), (2,)]
    tables.replace_table(spark.createDataFrame([(3,)], "k int"), name)
    assert tuples(tables.read_table(spark, name)) == [(3,)]


def test_bucketed_storage_needs_no_shuffle_of_the_table(spark, name, capsys):
    rows = spark.range(1000).selectExpr("id AS k", "id * 2 AS v")
    tables.upsert_table(rows, name, ["k"], buckets=4)
    tables.upsert_table(spark.createDataFrame([(5, 0), (1000, 1)], "k long, v long"), name, ["k"], buckets=4)
    got = tables.read_table(spark, name)
    assert got.count() == 1001 and got.where("k IN (5, 1000)").agg(F.sum("v")).first()[0] == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got.join(got.groupBy("k").count(), "k").explain("simple")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in capsys.readouterr().out


def test_bucketed_upsert_reads_and_writes_touched_buckets_only(spark, name):
    def files():
        return {r.f for r in tables.read_table(spark, name).select(F.input_file_name().alias("f")).collect()}

    tables.upsert_bucketed(spark.range(500).selectExpr("id AS k", "'old' AS v"), name, ["k"], 8)
    before = files()
    batch = spark.createDataFrame([(7, "new")], "k long, v string")
    touched = [r[0] for r in batch.select(tables.bucket_of(["k"], 8)).collect()]
    target = tables.in_partitions(spark, name, tables.BUCKET, touched)
    assert {f.split(f"{tables.BUCKET}=")[1].split("/")[0] for f in target.inputFiles()} == {str(touched[0])}
    tables.upsert_bucketed(batch, name, ["k"], 8)
    assert {f for f in before if f"{tables.BUCKET}={touched[0]}/" not in f} == {f for f in files() if f"{tables.BUCKET}={touched[0]}/" not in f}
    got = tables.read_table(spark, name)
    assert got.count() == 500 and tuples(got.where("v = 'new'").select("k")) == [(7,)]
    tables.upsert_bucketed(batch.withColumn("w", F.lit(1)).drop("v"), name, ["k"], 8)
    assert tuples(tables.read_table(spark, name).where("k = 7").select("k", "v", "w")) == [(7, "new", 1)]


def test_columns_survive_loads_without_them(spark, name):
    tables.append_table(spark.createDataFrame([(1,)], "k int"), name)
    tables.append_table(spark.createDataFrame([(2, "keep")], "k int, v string"), name)
    tables.upsert_table(spark.createDataFrame([(2,), (3,)], "k int"), name, ["k"])
    assert tuples(tables.read_table(spark, name)) == [(1, None), (2, "keep"), (3, None)]
    tables.delete_from_table(spark.createDataFrame([(1,)], "k int"), name, ["k"])
    assert tuples(tables.read_table(spark, name)) == [(2, "keep"), (3, None)]


def test_partition_keeps_columns_and_refuses_null(spark, name):
    load = lambda rows, kind: tables.upsert_partitions(spark.createDataFrame(rows, kind), name, ["p", "k"], "p")
    load([("a", 1, "x"), ("b", 2, "x")], "p string, k int, v string")
    load([("b", 2, "keep")], "p string, k int, y string")
    load([("b", 3, "z")], "p string, k int, v string")
    got = tables.read_table(spark, name).select("p", "k", "v", "y")
    assert tuples(got) == [("a", 1, "x", None), ("b", 2, "x", "keep"), ("b", 3, "z", None)]
    with pytest.raises(ValueError):
        load([(None, 4, "n")], "p string, k int, v string")
    assert tuples(tables.read_table(spark, name)) == tuples(got.select("k", "v", "y", "p").select(*tables.read_table(spark, name).columns))


def test_upsert_creates_then_merges_and_skips_empty(spark, name):
    schema = "k int, v string"
    tables.upsert_table(spark.createDataFrame([], schema), name, ["k"])
    assert not tables.table_exists(spark, name)
    tables.upsert_table(spark.createDataFrame([(1, "a"), (2, "b")], schema), name, ["k"])
    tables.upsert_table(spark.createDataFrame([(2, "c"), (3, "d")], schema), name, ["k"])
    assert tuples(tables.read_table(spark, name)) == [(1, "a"), (2, "c"), (3, "d")]
    tables.delete_from_table(spark.createDataFrame([(1,)], "k int"), name, ["k"])
    assert tuples(tables.read_table(spark, name)) == [(2, "c"), (3, "d")]


def test_append_with_a_new_column(spark, name):
    tables.append_table(spark.createDataFrame([(1,)], "k int"), name)
    tables.append_table(spark.createDataFrame([(2, "x")], "k int, v string"), name)
    assert tuples(tables.read_table(spark, name)) == [(1, None), (2, "x")]


def test_partition_upsert_leaves_other_partitions_alone(spark, name):
    schema = "d date, p string, active int, gone int"
    day = lambda n: dt.date(2024, 1, n)
    key = ["d", "p"]
    first = spark.createDataFrame([(day(1), "a", 1, None), (day(2), "a", 2, None)], schema)
    tables.upsert_partitions(first, name, key, "d")
    files = {r.f for r in tables.read_table(spark, name).select(F.input_file_name().alias("f")).collect()}
    update = spark.createDataFrame([(day(2), "a", 7), (day(2), "b", 8), (day(3), "c", 9)], "d date, p string, gone int")
    tables.upsert_partitions(update, name, key, "d", update_cols=["gone"])
    got = tables.read_table(spark, name).select("d", "p", "active", "gone")
    assert tuples(got) == [(day(1), "a", 1, None), (day(2), "a", 2, 7), (day(2), "b", None, 8), (day(3), "c", None, 9)]
    kept = {r.f for r in tables.read_table(spark, name).select(F.input_file_name().alias("f")).collect()}
    assert {f for f in files if "d=2024-01-01" in f} <= kept
    with pytest.raises(ValueError):
        tables.upsert_partitions(update, name, ["p"], "d")


def test_partition_upsert_reads_touched_partitions_only(spark, name):
    df = spark.createDataFrame([(dt.date(2024, 1, n), n) for n in range(1, 6)], "d date, v int")
    tables.upsert_partitions(df, name, ["d"], "d")
    touched = tables.in_partitions(spark, name, "d", [dt.date(2024, 1, 2), dt.date(2024, 2, 1)])
    assert [f for f in touched.inputFiles() if "d=2024-01-02" not in f] == []
    assert tuples(touched.select("v")) == [(2,)]


def test_csv_round_trip_keeps_every_text(spark, path):
    texts = ["a\nb", "", None, 'say "hi", x', "a\\\"b", " outer ", "cr\r\nlf\rx", "\\", "\\N", "null"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, v string")
    tables.write_csv(df, path)
    assert tuples(readers.read_export(spark, path, "k int, v string")) == tuples(df)


def test_bad_rows_fail_or_are_kept(spark, path):
    spark.createDataFrame([('k,v',), ('1,"a"',), ("x,b",), ("2,c,d",)], "value string").coalesce(1).write.text(path)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        readers.read_export(spark, path, "k int, v string").collect()
    kept = readers.read_export(spark, path, "k int, v string", bad_rows="keep").collect()
    assert sorted(r[readers.BAD_ROW] for r in kept if r[readers.BAD_ROW]) == ["2,c,d", "x,b"]


def test_csv_bundle_and_records(spark, path):
    df = spark.createDataFrame([(1, 'say "hi", x'), (2, None)], "k int, v string")
    tables.write_report_bundle(df, lambda stored: {"a": stored, "b": stored.where("k = 1")}, path)
    assert tuples(readers.read_export(spark, f"{path}/a", "k int, v string")) == tuples(df)
    assert tuples(readers.read_export(spark, f"{path}/b")) == [("1", 'say "hi", x')]
    lines = [json.dumps({"records": [{"Id": 1, "Owner": {"Name": "n"}}, {"Id": 2}]}), json.dumps({"records": []})]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{path}/json")
    got = readers.read_records(spark, f"{path}/json", "Id int, Owner struct<Name: string>")
    assert [(r.Id, r.Owner and r.Owner.Name) for r in got.orderBy("Id").collect()] == [(1, "n"), (2, None)]


def test_columns_are_read_by_name(spark, path):
    """Files with other column orders, with more columns, and with fewer."""

    def land(name, *lines):
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(f"{path}/{name}")

    land("a b", "id,name", "1,a")
    land("c", "name,id,more", '"b\n1",2,x', "c,3,y")
    kept = "id int, name string"
    assert tuples(readers.read_export(spark, f"{path}/*", kept)) == [(1, "a"), (2, "b\n1"), (3, "c")]
    everything = readers.read_export(spark, f"{path}/*").select("id", "name", "more")
    assert tuples(everything) == [("1", "a", None), ("2", "b\n1", "x"), ("3", "c", "y")]
    land("d", "id", "4")
    with pytest.raises(ValueError, match="lacks the columns name"):
        readers.read_export(spark, f"{path}/*", kept)
    land("e", "name,id", "x,none")
    found = readers.read_export(spark, f"{path}/[ace]*", kept, bad_rows="keep")
    assert [r[readers.BAD_ROW] for r in found.collect() if r[readers.BAD_ROW]] == ["x,none"]


def test_records_that_cannot_be_read(spark, path):
    lines = [
        '{"records": [{"id": 1, "o": {"n": "a"}}, "none", {"id": "x", "o": {"n": "b"}}, {"id": 2, "o": "c"}]}',
        '{"records": [{"id": 3}', '{"records": {"id": 4}}', "", "  ", '{"other": 1}', '[{"id": 5}]', '{"records": []}',
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    record = "id long, o struct<n: string>"
    kept = readers.read_records(spark, path, record, bad_records="keep").collect()
    assert sorted((r.id is None, r.id or 0, r.o and r.o.n) for r in kept) == [(False, 1, "a"), (False, 2, None), (True, 0, "b")]
    bad = sorted((r.level, r.text) for r in readers.unread_records(spark, path, record).collect())
    assert [level for level, _ in bad] == ["document"] * 4 + ["record"] * 3
    assert {t for level, t in bad if level == "record"} == {"none", '{"id":"x","o":{"n":"b"}}', '{"id":2,"o":"c"}'}
    with pytest.raises(Exception, match="can't read as records"):
        readers.read_records(spark, path, record).collect()


def test_read_since_variants(spark):
    rows = [(i, dt.datetime(2024, 1, 1, 12) + dt.timedelta(hours=12 * i)) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, t timestamp")
    mark = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert [r.k for r in readers.read_since(df, "t", mark).orderBy("k").collect()] == [1, 2, 3, 4]
    assert [r.k for r in readers.read_since(df, "t", mark, inclusive=False).orderBy("k").collect()] == [2, 3, 4]
    assert [r.k for r in readers.read_since(df, "t", "2024-01-02", by_day=True).orderBy("k").collect()] == [1, 2, 3, 4]
    later = readers.read_since(df, "t", "2024-01-02", inclusive=False, by_day=True)
    assert [r.k for r in later.orderBy("k").collect()] == [3, 4]
    assert [r.k for r in readers.read_since(df, "t", mark, limit=2, tie=["k"]).collect()] == [1, 2]


def test_pages_cover_equal_marks_once(spark):
    df = spark.createDataFrame([(k, k // 4) for k in range(10)], "k int, t int")
    pages, last = [], None
    while True:
        page = df.orderBy("t", "k").limit(3) if last is None else readers.read_after(df, ["t", "k"], last, 3)
        rows = [(r.t, r.k) for r in page.collect()]
        if not rows:
            break
        pages.append(rows)
        last = rows[-1]
    assert [len(p) for p in pages] == [3, 3, 3, 1]
    assert [k for p in pages for _, k in p] == list(range(10))


@pytest.mark.parametrize("inclusive", [True, False])
def test_incremental_halves_equal_the_whole(spark, name, inclusive):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i // 2), f"v{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "k int, t timestamp, v string")
    control = f"{name}_control"

    def load(source, target):
        return incremental.incremental_load(spark, source, target, control, target, "t", ["k"], "1970-01-01", inclusive)

    load(df, f"{name}_whole")
    first = load(df.where("k < 10"), f"{name}_parts")
    assert first == "2024-01-01 04:00:00"
    last = load(df, f"{name}_parts")
    assert load(df, f"{name}_parts") == last
    assert tuples(tables.read_table(spark, f"{name}_parts")) == tuples(tables.read_table(spark, f"{name}_whole"))
    assert incremental.read_mark(spark, control, "other", "none") == "none"


@pytest.mark.parametrize("inclusive", [True, False])
def test_appends_that_are_repeated_add_nothing(spark, name, inclusive):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i // 2)) for i in range(9)]
    df = spark.createDataFrame(rows, "k int, t timestamp")
    for source in (df.where("k < 5"), df, df, df):
        incremental.incremental_load(
            spark, source, f"{name}_t", f"{name}_c", "x", "t", ["k"], "1970-01-01", inclusive, mode="append"
        )
    got = [r.k for r in tables.read_table(spark, f"{name}_t").collect()]
    # Row 5 has the mark of row 4: only a load that includes its mark finds it.
    assert sorted(got) == [k for k in range(9) if inclusive or k != 5]
    with pytest.raises(ValueError):
        incremental.incremental_load(spark, df, f"{name}_t", f"{name}_c", "x", "t", [], "1970-01-01", mode="append")


def test_incremental_load_into_partitions(spark, name):
    rows = [(i, dt.datetime(2024, 1, 1 + i // 3), f"d{i // 3}") for i in range(9)]
    df = spark.createDataFrame(rows, "k int, t timestamp, p string")

    def load(source):
        return incremental.incremental_load(
            spark, source, f"{name}_t", f"{name}_c", "x", "t", ["k", "p"], "1970-01-01", partition="p"
        )

    load(df.where("k < 7"))
    before = {r.f for r in tables.read_table(spark, f"{name}_t").select(F.input_file_name().alias("f")).collect()}
    load(df)
    after = {r.f for r in tables.read_table(spark, f"{name}_t").select(F.input_file_name().alias("f")).collect()}
    assert {f for f in before if "p=d2" not in f} <= after
    assert sorted(r.k for r in tables.read_table(spark, f"{name}_t").collect()) == list(range(9))


def test_incremental_without_new_rows_keeps_the_mark(spark, name):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "k int, t timestamp")
    mark = incremental.incremental_load(
        spark, df, f"{name}_t", f"{name}_c", "x", "t", ["k"], "2025-01-01 00:00:00"
    )
    assert mark == "2025-01-01 00:00:00" and not tables.table_exists(spark, f"{name}_t")


def test_stream_upserts_new_files_once(spark, path, name):
    schema = "k int, t timestamp, v string"

    def land(name, rows):
        spark.createDataFrame([(k, dt.datetime(2024, 1, d), v) for k, d, v in rows], schema).coalesce(1).write.parquet(
            f"{path}/in/{name}"
        )

    def run():
        source = stream.stream_parquet(spark, f"{path}/in/*", schema)
        source = source.withColumn("day", F.date_format("t", "yyyy-MM-dd"))
        stream.run_upsert_stream(source, name, f"{path}/progress", ["k", "day"], ["t", "v"], partition="day")
        return tuples(tables.read_table(spark, name).select("k", "v", "day"))

    land("a", [(1, 1, "x"), (2, 2, "y"), (2, 2, "z")])
    assert run() == [(1, "x", "2024-01-01"), (2, "z", "2024-01-02")]
    land("b", [(2, 2, "zz"), (3, 3, "n")])
    assert run() == [(1, "x", "2024-01-01"), (2, "zz", "2024-01-02"), (3, "n", "2024-01-03")]
    land("c", [(5, 30, "late day")])
    land("d", [(4, 1, "no row is too late")])
    expected = [(1, "x", "2024-01-01"), (2, "zz", "2024-01-02"), (3, "n", "2024-01-03")]
    expected += [(4, "no row is too late", "2024-01-01"), (5, "late day", "2024-01-30")]
    assert run() == expected
    assert run() == expected


def test_sheets_of_a_bundle_are_read_back_by_their_names(spark):
    from subledger.plans.pivots import disconnect_pivots
    from workload.reports import TERMS, _sheets

    rows = [("2024-01-01", "EVERGREEN", None, "Mail", "i1", "Active"), ("2024-01-01", "ROLLING", 5, "Mail", "i2", "Active")]
    df = spark.createDataFrame(
        rows, "report_date string, term_type string, renewal_term int, product_name string, sub_id string, sub_status string"
    )
    path = scratch_path(spark, "bundle")
    tables.write_report_bundle(df, lambda stored: disconnect_pivots(stored, TERMS), path)
    (row,) = _sheets(spark, path).collect()
    assert (row.EVERGREEN, row.TERMED, row.other_types) == (1, None, 1)
    assert (row.term_1, row.term_2, row.other_terms, row.rows) == (1, None, 1, 2)
