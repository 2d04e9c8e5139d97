"""Cleaning, keys, merges, sources, sinks and incremental loads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from subledger import Spine
from subledger.functions.dates import iso_instant, parse_timestamp
from subledger.functions.scalars import to_number
from subledger.operators import cleaning, keys, merge
from subledger.operators.asof import as_of_join
from subledger.operators.intervals import interval_lookup
from subledger.operators.rejects import load_with_rejects
from subledger.session import scratch_path, scratch_table
from subledger.sources import readers, tables
from subledger.streaming.incremental import incremental_load
from subledger.streaming.newest import run_newest_stream
from subledger.streaming.stream import run_upsert_stream, stream_parquet
from workload import inputs
from workload.registry import query

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def _lines(spark, sf_dir):
    return inputs.load(spark, sf_dir, "lineitem").select(*LINE_COLUMNS, "l_shipdate")


def _dedupe_sql(direction: str) -> str:
    rest = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    order = ", ".join(f"{c} {direction}" for c in rest)
    return f"""SELECT {', '.join(LINE_COLUMNS)}, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem)
  WHERE rn = 1"""


@query("dedupe_last", _dedupe_sql("DESC"), ints=("l_linenumber",))
def dedupe_last(spark, sf_dir):
    return keys.dedupe(_lines(spark, sf_dir), LINE_KEY, ["l_shipdate"], keep="last")


@query("dedupe_first", _dedupe_sql("ASC"), ints=("l_linenumber",))
def dedupe_first(spark, sf_dir):
    return keys.dedupe(_lines(spark, sf_dir), LINE_KEY, ["l_shipdate"], keep="first")


@query("dedupe_last_turn", """SELECT conv_id, arg_max(turn, turn) AS turn, arg_max(role, turn) AS role,
  arg_max(text, turn) AS text FROM conversations GROUP BY conv_id""")
def dedupe_last_turn(spark, sf_dir):
    return keys.dedupe(inputs.load(spark, sf_dir, "conversations"), ["conv_id"], ["turn"])


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem", ints=("l_linenumber",))
def distinct_rows(spark, sf_dir):
    lines = inputs.load(spark, sf_dir, "lineitem")
    return lines.select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey").distinct()


@query(
    "first_per_key",
    """SELECT l_orderkey, arg_min(l_shipmode, (l_linenumber, l_partkey, l_suppkey, l_price)) FILTER (l_shipmode IS NOT NULL) AS l_shipmode,
    arg_min(l_partkey, (l_linenumber, l_partkey, l_suppkey, l_price)) AS l_partkey, CAST(sum(l_price) AS DOUBLE) AS l_price
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS l_price,
    CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS l_shipmode FROM lineitem) GROUP BY l_orderkey""",
)
def first_per_key(spark, sf_dir):
    rows = inputs.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", inputs.money("l_extendedprice").alias("l_price"),
        F.nullif("l_returnflag", F.lit("N")).alias("l_shipmode"),
    )
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_price"]
    return keys.first_per_key(rows, ["l_orderkey"], order, ["l_shipmode", "l_partkey"], ["l_price"], ["l_partkey"])


@query(
    "assert_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    ints=("l_linenumber",),
)
def key_violations(spark, sf_dir):
    orders = inputs.load(spark, sf_dir, "orders")
    keys.assert_unique(orders, ["o_orderkey"])
    return keys.key_violations(inputs.load(spark, sf_dir, "lineitem"), LINE_KEY)


@query(
    "with_row_index",
    """SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS "index", o_orderkey FROM orders""",
)
def with_row_index(spark, sf_dir):
    orders = inputs.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return keys.with_row_index(orders, ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "fill_sentinel",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type ELSE '###' END AS kind, value FROM events""",
)
def fill_sentinel(spark, sf_dir):
    rows = inputs.load(spark, sf_dir, "events").select(
        "event_id", F.nullif("event_type", F.lit("error")).alias("kind"), "value"
    )
    return cleaning.fill_sentinel(rows, "###")


@query(
    "fill_sentinel_text",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) ELSE ' ' END AS user_id
  FROM events""",
)
def fill_sentinel_text(spark, sf_dir):
    rows = inputs.load(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id")
    )
    return cleaning.fill_sentinel(rows, " ", as_string=True)


@query(
    "fill_and_replace",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'N' THEN 1 ELSE l_linenumber END AS filled,
  nullif(CASE WHEN l_returnflag = 'N' THEN 1 ELSE l_linenumber END, 1) AS replaced FROM lineitem""",
    ints=("l_linenumber", "filled", "replaced"),
)
def fill_and_replace(spark, sf_dir):
    rows = inputs.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_linenumber")).alias("filled"),
    )
    rows = cleaning.fill_column(rows, "filled", 1).withColumn("replaced", F.col("filled"))
    return cleaning.value_to_null(rows, "replaced", 1)


@query("clean_strings", "SELECT doc_id, text, length(text) AS n, lang FROM documents")
def clean_strings(spark, sf_dir):
    dirty = inputs.load(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("\x00"), "text", F.lit("\x00")).alias("text"), "lang"
    )
    return cleaning.clean_strings(dirty).withColumn("n", F.length("text"))


@query(
    "coerce_numeric",
    """SELECT page_id, try_cast(regexp_extract(url, '/([^/?]*)([?].*)?$', 1) AS DOUBLE) AS tail,
  try_cast(html AS DOUBLE) AS html, CASE WHEN page_id % 2 = 0 THEN page_id::DOUBLE END AS code FROM pages""",
)
def coerce_numeric(spark, sf_dir):
    pages = inputs.load(spark, sf_dir, "pages")
    tail = F.regexp_extract("url", r"/([^/?]*)([?].*)?$", 1)
    suffix = F.when(F.col("page_id") % 2 == 0, "").otherwise("F")
    code = F.concat(F.col("page_id").cast("string"), suffix)
    rows = pages.select("page_id", tail.alias("tail"), "html", code.alias("code"))
    return cleaning.coerce_numbers(rows, ["tail", "html", "code", "absent"])


@query(
    "normalise_timestamps",
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS created,
  strftime(ts, '%Y-%m-%d') AS created_day, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS instant FROM events""",
)
def normalise_timestamps(spark, sf_dir):
    iso = iso_instant(F.col("ts"))
    rows = inputs.load(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", iso).otherwise("not a date").alias("created"),
        iso.alias("created_day"), iso.alias("instant"),
    )
    rows = cleaning.normalise_timestamps(rows, ["created", "updated"])
    return cleaning.normalise_timestamps(rows, ["created_day"], as_date=True)


@query(
    "rename_labels",
    """SELECT o_orderkey AS rp_id, strftime(o_orderdate, '%Y-%m-%d') AS rp_created, 'north' AS original_region FROM orders""",
)
def rename_labels(spark, sf_dir):
    export = inputs.load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Rate Plan: ID"), F.to_date("o_orderdate").alias("Rate Plan: Created Date"), "o_custkey"
    )
    labels = {"Rate Plan: ID": "rp_id", "Rate Plan: Created Date": "rp_created", "Account: ID": "account_id"}
    return cleaning.rename_labels(export, labels).drop("o_custkey").withColumn("original_region", F.lit("north"))


# Merges: orders before 1999 are the target, orders from 1998 on the updates.
TARGET_SQL = "t AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderdate < DATE '1999-01-01')"
UPDATES_SQL = "u AS (SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, 'U' AS o_orderstatus FROM orders WHERE o_orderdate >= DATE '1998-01-01')"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]


def _target(spark, sf_dir):
    orders = inputs.load(spark, sf_dir, "orders")
    return orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(ORDER_COLUMNS)


def _updates(spark, sf_dir):
    orders = inputs.load(spark, sf_dir, "orders")
    late = orders.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return late.select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit("U").alias("o_orderstatus")
    )


@query(
    "upsert_all",
    f"""WITH {TARGET_SQL}, {UPDATES_SQL} SELECT * FROM u
  UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u)""",
)
def upsert_all(spark, sf_dir):
    return merge.upsert(_target(spark, sf_dir), _updates(spark, sf_dir), ["o_orderkey"])


@query(
    "upsert_partial",
    f"""WITH {TARGET_SQL}, {UPDATES_SQL} SELECT o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN u.o_custkey ELSE t.o_custkey END AS o_custkey,
  coalesce(u.o_totalprice, t.o_totalprice) AS o_totalprice,
  CASE WHEN t.o_orderkey IS NULL THEN u.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus FROM t FULL JOIN u USING (o_orderkey)""",
)
def upsert_partial(spark, sf_dir):
    return merge.upsert(
        _target(spark, sf_dir), _updates(spark, sf_dir), ["o_orderkey"], update_cols=["o_totalprice"]
    )


@query(
    "insert_ignore",
    f"""WITH {TARGET_SQL}, {UPDATES_SQL} SELECT * FROM t
  UNION ALL SELECT * FROM u WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)""",
)
def insert_ignore(spark, sf_dir):
    return merge.upsert(_target(spark, sf_dir), _updates(spark, sf_dir), ["o_orderkey"], mode="ignore")


@query(
    "upsert_composite",
    """WITH b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem
      WHERE l_returnflag = 'R') WHERE rn = 1),
  t AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'R')
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM b
  UNION ALL SELECT l_orderkey, l_linenumber, NULL, 0 FROM t
  WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.l_orderkey = t.l_orderkey AND b.l_linenumber = t.l_linenumber)""",
    ints=("l_linenumber",),
)
def upsert_composite(spark, sf_dir):
    lines = inputs.load(spark, sf_dir, "lineitem")
    target = lines.where(F.col("l_returnflag") != "R").select(
        *LINE_KEY, F.lit(None).cast("bigint").alias("l_partkey"), F.lit(0.0).alias("l_extendedprice")
    )
    batch = lines.where(F.col("l_returnflag") == "R").select(*LINE_COLUMNS, "l_shipdate")
    newest = keys.dedupe(batch, LINE_KEY, ["l_shipdate"]).select(*LINE_KEY, "l_partkey", "l_extendedprice")
    return merge.upsert(target.distinct(), newest, LINE_KEY)


@query(
    "evolve_schema",
    f"""WITH {TARGET_SQL}, {UPDATES_SQL} SELECT o_orderkey, CAST(NULL AS BIGINT) AS o_custkey, o_totalprice FROM t
  UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM u""",
)
def evolve_schema(spark, sf_dir):
    target = _target(spark, sf_dir).select("o_orderkey", "o_totalprice")
    rows = _updates(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice")
    return merge.append(target, rows)


@query(
    "upsert_missing_columns",
    f"""WITH {TARGET_SQL}, {UPDATES_SQL} SELECT o_orderkey, t.o_custkey, coalesce(u.o_totalprice, t.o_totalprice) AS o_totalprice,
  coalesce(u.o_orderstatus, t.o_orderstatus) AS o_orderstatus FROM t FULL JOIN u USING (o_orderkey)""",
)
def upsert_missing_columns(spark, sf_dir):
    """Updates without a column leave that column's values as they are."""
    return merge.upsert(_target(spark, sf_dir), _updates(spark, sf_dir).drop("o_custkey"), ["o_orderkey"])


@query("delete_keys", f"WITH {TARGET_SQL}, {UPDATES_SQL} SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u)")
def delete_keys(spark, sf_dir):
    return merge.delete_keys(_target(spark, sf_dir), _updates(spark, sf_dir), ["o_orderkey"])


@query(
    "table_upsert",
    f"""WITH {TARGET_SQL}, {UPDATES_SQL} SELECT * FROM u
  UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u)""",
)
def table_upsert(spark, sf_dir):
    """Replace, then upsert, then read the table back."""
    name = scratch_table(spark, "orders")
    tables.replace_table(_target(spark, sf_dir), name)
    tables.upsert_table(_updates(spark, sf_dir), name, ["o_orderkey"])
    return tables.read_table(spark, name)


@query(
    "table_append",
    f"""WITH {TARGET_SQL}, {UPDATES_SQL} SELECT o_orderkey, NULL AS o_custkey, o_totalprice FROM t
  UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM u""",
)
def table_append(spark, sf_dir):
    """Append of a batch with a column the table does not have yet."""
    name = scratch_table(spark, "orders")
    tables.append_table(_target(spark, sf_dir).select("o_orderkey", "o_totalprice"), name)
    tables.append_table(_updates(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice"), name)
    return tables.read_table(spark, name).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "append_evolve_upsert",
    f"""WITH {TARGET_SQL}, {UPDATES_SQL} SELECT o_orderkey, u.o_custkey, CASE WHEN u.o_orderkey % 5 = 0 THEN 0 ELSE coalesce(u.o_totalprice, t.o_totalprice) END AS o_totalprice
  FROM t FULL JOIN u USING (o_orderkey) WHERE u.o_orderkey IS NULL OR t.o_orderkey IS NULL
  UNION ALL SELECT o_orderkey, NULL, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE t.o_totalprice END FROM t JOIN u USING (o_orderkey)
  UNION ALL SELECT o_orderkey, u.o_custkey, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE u.o_totalprice END FROM t JOIN u USING (o_orderkey)""",
)
def append_evolve_upsert(spark, sf_dir):
    """A column that an append adds is still there after an upsert without it."""
    name = scratch_table(spark, "orders")
    updates = _updates(spark, sf_dir)
    tables.append_table(_target(spark, sf_dir).select("o_orderkey", "o_totalprice"), name)
    tables.append_table(updates.select("o_orderkey", "o_custkey", "o_totalprice"), name)
    free = updates.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit(0.0).alias("o_totalprice"))
    tables.upsert_table(free, name, ["o_orderkey"])
    return tables.read_table(spark, name).select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "partition_upsert",
    """SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  count(*) FILTER (year(l_shipdate) = 1998) AS lines_1998 FROM lineitem GROUP BY ALL""",
)
def partition_upsert(spark, sf_dir):
    """One job fills a measure for all months, another one for a single year."""
    lines = inputs.load(spark, sf_dir, "lineitem").withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM"))
    key = ["ship_month", "l_suppkey"]
    revenue = lines.groupBy(*key).agg(
        F.sum(inputs.money("l_extendedprice")).alias("revenue"), F.lit(0).cast("bigint").alias("lines_1998")
    )
    counted = lines.where(F.year("l_shipdate") == 1998).groupBy(*key).agg(F.count("*").alias("lines_1998"))
    name = scratch_table(spark, "by_month")
    tables.upsert_partitions(revenue, name, key, "ship_month")
    tables.upsert_partitions(counted, name, key, "ship_month", update_cols=["lines_1998"])
    return tables.read_table(spark, name)


@query(
    "partition_upsert_new_column",
    """SELECT strftime(l_shipdate, '%Y-%m') AS ship_month, l_suppkey, count(*) AS lines,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (strftime(l_shipdate, '%Y-%m') >= '1998') AS DOUBLE) AS revenue
  FROM lineitem GROUP BY ALL""",
)
def partition_upsert_new_column(spark, sf_dir):
    """A column that one load adds stays when the next load lacks it."""
    lines = inputs.load(spark, sf_dir, "lineitem").withColumn("ship_month", F.date_format("l_shipdate", "yyyy-MM"))
    key = ["ship_month", "l_suppkey"]
    counted = lines.groupBy(*key).agg(F.count("*").alias("lines"))
    late = lines.where(F.col("ship_month") >= "1998").groupBy(*key)
    name = scratch_table(spark, "by_month")
    tables.upsert_partitions(counted.withColumn("lines", F.lit(0).cast("bigint")), name, key, "ship_month")
    tables.upsert_partitions(late.agg(F.sum(inputs.money("l_extendedprice")).alias("revenue")), name, key, "ship_month")
    tables.upsert_partitions(counted, name, key, "ship_month")
    return tables.read_table(spark, name)


@query(
    "upsert_bucketed",
    f"""WITH {TARGET_SQL}, {UPDATES_SQL} SELECT * FROM u WHERE o_orderkey % 50 = 0
  UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM u WHERE o_orderkey % 50 = 0)""",
)
def upsert_bucketed(spark, sf_dir):
    """A batch of few keys into a table partitioned by a hash of its key."""
    name = scratch_table(spark, "orders")
    tables.upsert_bucketed(_target(spark, sf_dir), name, ["o_orderkey"], 16)
    tables.upsert_bucketed(_updates(spark, sf_dir).where("o_orderkey % 50 = 0"), name, ["o_orderkey"], 16)
    return tables.read_table(spark, name).drop(tables.BUCKET)


@query("csv_round_trip", "SELECT doc_id, text, nullif(lang, 'de') AS lang, CASE WHEN lang = 'fr' THEN '' ELSE source END AS source, n_chars FROM documents")
def csv_round_trip(spark, sf_dir):
    """Texts with line breaks, nulls and empty texts through a CSV export."""
    path = scratch_path(spark, "export")
    rows = inputs.load(spark, sf_dir, "documents").select(
        "doc_id", "text", F.nullif("lang", F.lit("de")).alias("lang"),
        F.when(F.col("lang") == "fr", "").otherwise(F.col("source")).alias("source"), "n_chars",
    )
    tables.write_csv(rows, path)
    return readers.read_export(spark, path, rows.schema)


@query("csv_by_name", "SELECT doc_id, lang, source, CASE WHEN doc_id % 3 < 2 THEN n_chars END AS n_chars FROM documents")
def csv_by_name(spark, sf_dir):
    """An export whose files have their columns in different orders, and not all the same ones."""
    path = scratch_path(spark, "export")
    rows = inputs.load(spark, sf_dir, "documents")
    for part, columns in enumerate((["doc_id", "lang", "source", "n_chars"], ["n_chars", "source", "text", "doc_id", "lang"], ["source", "doc_id", "lang"])):
        tables.write_csv(rows.where(F.col("doc_id") % 3 == part).select(columns), f"{path}/part={part}")
    read = readers.read_export(spark, f"{path}/*")
    return read.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", F.col("n_chars").cast("bigint").alias("n_chars"))


@query(
    "read_since",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-15'""",
)
def read_since(spark, sf_dir):
    events = inputs.load(spark, sf_dir, "events").select("event_id", "ts")
    return readers.read_since(events, "ts", "2024-01-15", inclusive=False, by_day=True)


@query(
    "read_since_page",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders WHERE o_orderdate >= DATE '1998-01-01'
  ORDER BY o_orderdate, o_orderkey LIMIT 500""",
)
def read_since_page(spark, sf_dir):
    orders = inputs.load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    return readers.read_since(orders, "o_orderdate", F.lit("1998-01-01").cast("date"), limit=500, tie=["o_orderkey"])


@query(
    "read_next_page",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders
  WHERE (CAST(o_orderdate AS DATE), o_orderkey) > (DATE '1998-01-05', 5000) ORDER BY CAST(o_orderdate AS DATE), o_orderkey LIMIT 500""",
)
def read_next_page(spark, sf_dir):
    orders = inputs.load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"))
    last = [F.lit("1998-01-05").cast("date"), F.lit(5000)]
    return readers.read_after(orders, ["o_orderdate", "o_orderkey"], last, limit=500)


@query(
    "lookback_window",
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'""",
)
def lookback_window(spark, sf_dir):
    """Events of the ten days before a date."""
    window = Spine.lookback(dt.date(2024, 1, 20), 10)
    events = inputs.load(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))
    return events.where(window.contains(F.col("day")))


@query("strict_timestamps", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events")
def strict_timestamps(spark, sf_dir):
    """Text to timestamps, where text that is none would be an error."""
    events = inputs.load(spark, sf_dir, "events").select("event_id", iso_instant(F.col("ts")).alias("ts"))
    return events.withColumn("ts", parse_timestamp(F.col("ts"), strict=True))


@query("high_water_mark", "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS value FROM events")
def high_water_mark(spark, sf_dir):
    return readers.high_water_mark(inputs.load(spark, sf_dir, "events"), "ts")


EVENTS_SQL = "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value FROM events"


@query("incremental_load", EVENTS_SQL)
def incremental(spark, sf_dir):
    """The events loaded in two runs that overlap on the mark's day, and a run without rows."""
    events = inputs.load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    target, control = scratch_table(spark, "events"), scratch_table(spark, "control")
    half = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    for source in (half, events, events.where("false")):
        incremental_load(spark, source, target, control, "events", "ts", ["event_id"], default="1970-01-01")
    return tables.read_table(spark, target)


@query("incremental_append", EVENTS_SQL)
def incremental_append(spark, sf_dir):
    """Appends of loads that overlap on the mark, the last one run twice."""
    events = inputs.load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    target, control = scratch_table(spark, "events"), scratch_table(spark, "control")
    half = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    for source in (half, events, events):
        incremental_load(spark, source, target, control, "events", "ts", ["event_id"], default="1970-01-01", mode="append")
    return tables.read_table(spark, target)


@query("incremental_load_partitioned", EVENTS_SQL)
def incremental_partitioned(spark, sf_dir):
    """The events loaded in two runs into a table by day; an empty load changes nothing."""
    events = inputs.load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    events = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    target, control = scratch_table(spark, "events"), scratch_table(spark, "control")
    half = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    for source in (half, events, events.where("false")):
        incremental_load(
            spark, source, target, control, "events", "ts", ["event_id", "day"], default="1970-01-01", partition="day"
        )
    return tables.read_table(spark, target).drop("day")


@query("streaming_upsert", EVENTS_SQL)
def streaming_upsert(spark, sf_dir):
    """Event files as a stream, a file a batch, the latest events first, upserted by day."""
    events = inputs.load(spark, sf_dir, "events").drop("props").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    landed = scratch_path(spark, "landed")
    for low, high in (("2024-01-21", "9"), ("0", "2024-01-11"), ("2024-01-11", "2024-01-21")):
        events.where((F.col("day") >= low) & (F.col("day") < high)).write.mode("append").parquet(landed)
    stream = stream_parquet(spark, landed, events.schema, files_per_batch=1)
    name = scratch_table(spark, "events")
    run_upsert_stream(stream, name, scratch_path(spark, "progress"), ["event_id", "day"], ["ts"], partition="day")
    return tables.read_table(spark, name).drop("day")


@query(
    "tax_postal_codes",
    """SELECT s_suppkey, try_cast(CASE WHEN s_nationkey % 2 = 0 THEN CAST(20000 + s_nationkey AS VARCHAR) ELSE '12' || 'FDf'[1 + s_suppkey % 3] END AS DOUBLE)
  AS postal_code FROM supplier""",
)
def tax_postal_codes(spark, sf_dir):
    letter = F.substr(F.lit("FDf"), (F.col("s_suppkey") % 3 + 1).cast("int"), F.lit(1))
    code = F.when(F.col("s_nationkey") % 2 == 0, (F.col("s_nationkey") + 20000).cast("string"))
    code = code.otherwise(F.concat(F.lit("12"), letter))
    return inputs.load(spark, sf_dir, "supplier").select("s_suppkey", to_number(code).alias("postal_code"))


# Shifts of every day that has events: they begin and end at odd times and leave gaps.
SHIFTS_SQL = """shifts AS (
  SELECT strftime(day, '%Y%m%d') || kind AS shift, day + to_seconds(3601 * first + 17 * day(day)) AS started,
    day + to_seconds(3601 * last + 23) AS ended
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events), (VALUES ('a', 1, 7), ('b', 8, 15), ('c', 16, 22)) t(kind, first, last))"""


@query(
    "interval_lookup",
    f"""WITH {SHIFTS_SQL} SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, shift, strftime(started, '%Y-%m-%d %H:%M:%S') AS started
  FROM events LEFT JOIN shifts ON ts >= started AND ts < ended""",
)
def event_shifts(spark, sf_dir):
    """The shift that each event falls into, if any."""
    events = inputs.load(spark, sf_dir, "events").select("event_id", "ts")
    day = F.date_trunc("day", F.col("ts").cast("timestamp"))
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(a).alias("first"), F.lit(b).alias("last")) for k, a, b in (("a", 1, 7), ("b", 8, 15), ("c", 16, 22))))
    shifts = events.select(day.alias("day")).distinct().select("day", F.inline(kinds))
    start = F.unix_seconds("day") + F.col("first") * 3601 + F.dayofmonth("day") * 17
    end = F.unix_seconds("day") + F.col("last") * 3601 + 23
    shifts = shifts.select(
        F.concat(F.date_format("day", "yyyyMMdd"), "kind").alias("shift"),
        F.timestamp_seconds(start).alias("started"), F.timestamp_seconds(end).alias("ended"),
    )
    return interval_lookup(events, "ts", shifts, "started", "ended", how="left").drop("ended")


@query(
    "payments_as_of_version",
    """WITH v AS (SELECT o_custkey, o_orderdate, max(o_orderkey) AS version, arg_max(o_orderstatus, o_orderkey) AS status
    FROM orders GROUP BY o_custkey, o_orderdate),
  p AS (SELECT CASE WHEN l_suppkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_extendedprice AS amount, l_shipdate - INTERVAL 60 DAY AS paid FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
  SELECT p.o_custkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, amount,
    strftime(paid, '%Y-%m-%d') AS paid, version, status
  FROM p ASOF LEFT JOIN v ON p.o_custkey = v.o_custkey AND p.paid >= v.o_orderdate""",
)
def payments_as_of_version(spark, sf_dir):
    """Payments with the order that was the customer's newest then; a third of them are one customer's."""
    orders = inputs.load(spark, sf_dir, "orders").withColumn("since", F.to_date("o_orderdate"))
    owners = orders.select("o_orderkey", "o_custkey")
    lines = inputs.load(spark, sf_dir, "lineitem").join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
    payer = F.when(F.col("l_suppkey") % 3 == 0, 7).otherwise(F.col("o_custkey")).cast("long")
    payments = lines.select(
        payer.alias("o_custkey"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").alias("amount"), F.date_sub(F.to_date("l_shipdate"), 60).alias("paid"),
    )
    versions = orders.select("o_custkey", "since", F.col("o_orderkey").alias("version"), F.col("o_orderstatus").alias("status"))
    return as_of_join(payments, versions, ["o_custkey"], "paid", "since", ["version", "status"], tie=["version"])


_LANDED_SQL = """landed AS (
  SELECT CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN CAST(o_orderkey + 1 AS VARCHAR) ELSE CAST(o_orderkey AS VARCHAR) END AS k,
    CASE WHEN o_orderkey % 11 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price, o_orderstatus AS status, o_orderkey
  FROM orders),
judged AS (
  SELECT *, concat_ws(';', CASE WHEN price = 'n/a' THEN 'price is no decimal(18,2)' END, CASE WHEN k IS NULL THEN 'k is null' END,
    CASE WHEN TRY_CAST(price AS DECIMAL(18,2)) >= 400000 THEN 'price below 400000' END) AS why FROM landed),
placed AS (SELECT *, CASE WHEN why = '' THEN row_number() OVER (PARTITION BY why = '', k ORDER BY CAST(price AS VARCHAR) = 'n/a', CASE WHEN why = '' THEN CAST(price AS DECIMAL(18,2)) END, o_orderkey) END AS rn FROM judged)"""


@query(
    "load_with_rejects",
    f"""WITH {_LANDED_SQL}
  SELECT CAST(k AS BIGINT) AS k, CAST(price AS DOUBLE) AS price, status, o_orderkey, NULL AS reasons FROM placed WHERE rn = 1
  UNION ALL SELECT NULL, NULL, NULL, o_orderkey, CASE WHEN rn > 1 THEN 'k occurs before' ELSE why END FROM placed WHERE rn IS NULL OR rn > 1""",
)
def rejected_orders(spark, sf_dir):
    """Orders as text, some of which don't fit: what was loaded, and what wasn't and why. The load runs twice."""
    order = F.col("o_orderkey")
    text = F.when(order % 23 == 0, order + 1).otherwise(order).cast("string")
    landed = inputs.load(spark, sf_dir, "orders").select(
        F.when(order % 19 != 0, text).alias("k"),
        F.when(order % 11 == 0, "n/a").otherwise(inputs.money("o_totalprice").cast("string")).alias("price"),
        F.col("o_orderstatus").alias("status"), "o_orderkey",
    )
    name, rejects = scratch_table(spark, "orders"), scratch_table(spark, "rejects")
    schema = "k long not null, price decimal(18,2), status string, o_orderkey long"
    rules = {"price below 400000": F.col("price") < 400_000}
    for _ in range(2):
        load_with_rejects(landed, name, rejects, schema, "first", rules, ["k"], ["price", "o_orderkey"])
    bad = tables.read_table(spark, rejects).select(
        F.get_json_object("row", "$.o_orderkey").cast("long").alias("o_orderkey"), F.array_join("reasons", ";").alias("reasons")
    )
    return tables.read_table(spark, name).unionByName(bad, allowMissingColumns=True)


@query(
    "stream_newest_version",
    """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts,
    arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id""",
)
def stream_newest_version(spark, sf_dir):
    """The newest event of each user from a stream of files in no order, in two runs of the job."""
    events = inputs.load(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    landed, name, progress = scratch_path(spark, "landed"), scratch_table(spark, "newest"), scratch_path(spark, "progress")
    for parts in ((2, 0), (1, 3)):
        for part in parts:
            events.where(F.col("event_id") % 4 == part).coalesce(2).write.mode("append").parquet(landed)
        stream = stream_parquet(spark, landed, events.schema, files_per_batch=2)
        run_newest_stream(stream, name, progress, ["user_id"], ["ts", "event_id"], buckets=8)
    return tables.read_table(spark, name).drop(tables.BUCKET)
