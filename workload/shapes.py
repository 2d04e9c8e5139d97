"""Joins, wide extracts and the SQL vocabulary."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from subledger.functions.dates import month_end, month_start
from subledger.functions.predicates import type_not_in, within_months
from subledger.operators import joins
from subledger.operators.joins import Dimension
from subledger.plans import extracts
from workload import inputs
from workload.inputs import DAYS, FACTS_SQL
from workload.registry import query


def _load(spark, sf_dir, *names):
    return [inputs.load(spark, sf_dir, n) for n in names]


def _ntz(day: str):
    return F.lit(day).cast("timestamp_ntz")


@query(
    "join_indicator",
    """SELECT c_custkey, o.o_orderkey, o.o_orderkey IS NOT NULL AS matched FROM customer
  LEFT JOIN orders o ON c_custkey = o_custkey""",
)
def join_indicator(spark, sf_dir):
    customer, orders = _load(spark, sf_dir, "customer", "orders")
    right = orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.join_indicator(customer.select("c_custkey"), right, ["c_custkey"])


@query(
    "left_only_rows",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""",
)
def left_only_rows(spark, sf_dir):
    customer, orders = _load(spark, sf_dir, "customer", "orders")
    buyers = orders.select(F.col("o_custkey").alias("c_custkey"))
    return joins.without_matches(customer.select("c_custkey", "c_name"), buyers, ["c_custkey"])


@query(
    "not_in_values",
    """SELECT p_partkey, p_type FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)""",
)
def not_in_values(spark, sf_dir):
    part, line = _load(spark, sf_dir, "part", "lineitem")
    values = line.where(F.col("l_quantity") > 49).select("l_partkey")
    return joins.not_in(part.select("p_partkey", "p_type"), "p_partkey", values)


@query(
    "not_in_with_null",
    """SELECT p_partkey, p_type FROM part
  WHERE p_partkey NOT IN (SELECT CASE WHEN l_quantity > 49 THEN l_partkey END FROM lineitem)""",
)
def not_in_with_null(spark, sf_dir):
    part, line = _load(spark, sf_dir, "part", "lineitem")
    values = line.select(F.when(F.col("l_quantity") > 49, F.col("l_partkey")).alias("v"))
    return joins.not_in(part.select("p_partkey", "p_type"), "p_partkey", values)


@query(
    "all_matched_groups",
    """SELECT o_custkey FROM orders GROUP BY o_custkey HAVING bool_and(o_orderstatus <> 'P')""",
)
def all_matched_groups(spark, sf_dir):
    (orders,) = _load(spark, sf_dir, "orders")
    flagged = orders.select("o_custkey", (F.col("o_orderstatus") != "P").alias("done"))
    return joins.all_matched(flagged, ["o_custkey"], "done")


@query(
    "period_lookup",
    """WITH periods AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS name, CAST(date_trunc('month', l_shipdate) AS DATE) AS s,
    CAST(last_day(l_shipdate) AS DATE) AS e FROM lineitem)
  SELECT o_orderkey, (SELECT name FROM periods WHERE CAST(o_orderdate AS DATE) BETWEEN s AND e) AS period FROM orders""",
)
def period_lookup(spark, sf_dir):
    """Orders with the period their date lies in, by equality on the day."""
    (orders,) = _load(spark, sf_dir, "orders")
    days = joins.period_days(inputs.periods(spark, sf_dir), "name", "start_date", "end_date", DAYS)
    days = joins.unique_period_days(days, "name").withColumnRenamed("name", "period")
    dated = orders.select("o_orderkey", F.to_date("o_orderdate").alias("report_date"))
    return dated.join(days, "report_date", "left").drop("report_date")


@query(
    "star_extract",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderstatus, c_name AS account_name, cn.n_name AS account_state,
    sn.n_name AS vendor_state, r_name AS account_country, p_type AS product_name
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey LEFT JOIN region ON cn.n_regionkey = r_regionkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey
  LEFT JOIN part ON l_partkey = p_partkey""",
    ints=("l_linenumber",),
)
def star_extract(spark, sf_dir):
    """A line with everything it points at, nations under two roles."""
    line, orders, customer, nation, region, supplier, part = _load(
        spark, sf_dir, "lineitem", "orders", "customer", "nation", "region", "supplier", "part"
    )
    fact = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    wide = joins.star_join(
        fact,
        [
            Dimension(
                orders, {"l_orderkey": "o_orderkey"}, {"o_orderstatus": "o_orderstatus", "o_custkey": "_c"}, "inner"
            ),
            Dimension(customer, {"_c": "c_custkey"}, {"c_name": "account_name", "c_nationkey": "_cn"}),
            Dimension(nation, {"_cn": "n_nationkey"}, {"n_name": "account_state", "n_regionkey": "_r"}),
            Dimension(region, {"_r": "r_regionkey"}, {"r_name": "account_country"}),
            Dimension(supplier, {"l_suppkey": "s_suppkey"}, {"s_nationkey": "_sn"}),
            Dimension(nation, {"_sn": "n_nationkey"}, {"n_name": "vendor_state"}),
            Dimension(part, {"l_partkey": "p_partkey"}, {"p_type": "product_name"}),
        ],
    )
    return wide.drop("_c", "_cn", "_r", "_sn")


PAYMENTS_SQL = """FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey WHERE o_orderdate >= DATE '1998-03-01'"""


def _payment_dimensions(spark, sf_dir):
    customer, nation, region = _load(spark, sf_dir, "customer", "nation", "region")
    return [
        Dimension(customer, {"account": "c_custkey"}, {"c_name": "account_name", "c_nationkey": "_n"}),
        Dimension(nation, {"_n": "n_nationkey"}, {"n_name": "state", "n_regionkey": "_r"}),
        Dimension(region, {"_r": "r_regionkey"}, {"r_name": "country"}),
    ]


@query(
    "payments",
    f"""SELECT o_orderkey AS payment_id, o_custkey AS account, o_totalprice AS amount, o_orderstatus AS status,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created, c_name AS account_name, n_name AS state, r_name AS country
  {PAYMENTS_SQL}""",
)
def payments(spark, sf_dir):
    (orders,) = _load(spark, sf_dir, "orders")
    fact = orders.select(
        F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("account"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created"),
    )
    rows = extracts.incremental_extract(
        fact, _payment_dimensions(spark, sf_dir), F.col("created") >= _ntz("1998-03-01"), ["created", "updated"]
    )
    return rows.drop("_n", "_r")


@query(
    "invoice_payments",
    """SELECT DISTINCT l_orderkey AS payment_id, l_suppkey AS invoice_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS posted,
    o_orderstatus AS status, c_name AS account_name, n_name AS state, r_name AS country FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
  WHERE l_shipdate >= DATE '1998-03-01'""",
)
def invoice_payments(spark, sf_dir):
    line, orders = _load(spark, sf_dir, "lineitem", "orders")
    fact = line.select(
        F.col("l_orderkey").alias("payment_id"), F.col("l_suppkey").alias("invoice_id"), F.col("l_shipdate").alias("posted")
    )
    dims = [
        Dimension(
            orders, {"payment_id": "o_orderkey"}, {"o_orderstatus": "status", "o_custkey": "account"}, "inner"
        ),
        *_payment_dimensions(spark, sf_dir),
    ]
    since = F.col("posted") >= _ntz("1998-03-01")
    rows = extracts.incremental_extract(fact, dims, since, ["posted"])
    return rows.drop("account", "_n", "_r").distinct()


@query(
    "tax_items",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax AS tax_rate,
    coalesce(CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, ' ') AS tax_code,
    try_cast(CASE WHEN s_nationkey % 2 = 0 THEN '2' || s_nationkey ELSE '12F' END AS DOUBLE) AS postal_code,
    p_brand AS sku, 'north' AS original_region, '10' AS original_code
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_shipdate >= DATE '1998-01-01'""",
    ints=("l_linenumber",),
)
def tax_items(spark, sf_dir):
    line, part, supplier = _load(spark, sf_dir, "lineitem", "part", "supplier")
    items = line.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_tax").alias("tax_rate"),
        F.nullif("l_returnflag", F.lit("N")).alias("tax_code"), "l_shipdate",
    )
    coded = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("2"), F.col("s_nationkey").cast("string")))
    vendors = supplier.select("s_suppkey", coded.otherwise("12F").alias("postal"))
    dims = [
        Dimension(part, {"l_partkey": "p_partkey"}, {"p_brand": "sku"}),
        Dimension(vendors, {"l_suppkey": "s_suppkey"}, {"postal": "postal_code"}),
    ]
    since = F.col("l_shipdate") >= _ntz("1998-01-01")
    origin = {"original_region": "north", "original_code": "10"}
    return extracts.tax_items(items, dims, since, ["postal_code"], origin).drop("l_shipdate")


@query(
    "contacts",
    """SELECT c_custkey AS id, 'A' || (c_custkey % 1000) AS account_id, n_name AS state, r_name AS country FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def contacts(spark, sf_dir):
    (customer,) = _load(spark, sf_dir, "customer")
    account = F.concat(F.lit("A"), (F.col("c_custkey") % 1000).cast("string"))
    fact = customer.select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("account"), account.alias("account_id")
    )
    rows = extracts.incremental_extract(fact, _payment_dimensions(spark, sf_dir), F.lit(True))
    return rows.select("id", "account_id", "state", "country")


@query(
    "product_rate_plans",
    """SELECT p_partkey AS id, p_name AS name, p_brand AS plan_number, p_size AS term FROM part""",
    ints=("term",),
)
def product_rate_plans(spark, sf_dir):
    (part,) = _load(spark, sf_dir, "part")
    rows = extracts.incremental_extract(part, [], F.lit(True), ["created", "updated"])
    return rows.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("plan_number"),
        F.col("p_size").alias("term"),
    )


@query(
    "subscription_fact",
    f"""WITH {FACTS_SQL}, plans AS (
    SELECT rp_id, arg_min(sub_name, (sub_name, product_name, rp_created)) AS sub_name,
      arg_min(product_name, (sub_name, product_name, rp_created)) AS product_name,
      arg_min(rp_created, (sub_name, product_name, rp_created)) AS rp_created,
      coalesce(sum(mrr), 0) AS mrr, coalesce(sum(tcv), 0) AS tcv FROM z
    WHERE rp_created >= DATE '1995-06-01' AND currency = 'USD' AND sub_version = 1 GROUP BY rp_id),
  billed AS (SELECT l_orderkey || '-' || l_linenumber AS rp_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total_adds_revenue
    FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
  SELECT rp_id, sub_name, product_name, strftime(rp_created, '%Y-%m-%d') AS report_date, CAST(mrr AS DOUBLE) AS mrr,
    CAST(tcv AS DOUBLE) AS tcv, CAST(total_adds_revenue AS DOUBLE) AS total_adds_revenue FROM plans LEFT JOIN billed USING (rp_id)""",
)
def subscription_fact(spark, sf_dir):
    (line,) = _load(spark, sf_dir, "lineitem")
    items = line.where(F.col("l_returnflag") != "R").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("rp_id"),
        inputs.money("l_extendedprice").alias("charge_amount"),
    )
    attributes = ["sub_name", "product_name", "rp_created"]
    rows = extracts.subscription_fact(
        inputs.facts(spark, sf_dir), items, "1995-06-01", attributes, never_null=attributes
    )
    return rows.drop("rp_created")


@query(
    "audit_export",
    """SELECT l_orderkey AS audit_id, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS created, o_totalprice AS order_value,
    a.s_name AS agent, b.s_name AS auditor, c_name AS lead_name, p_name AS case_name
  FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o_orderkey
  LEFT JOIN supplier a ON l_suppkey = a.s_suppkey LEFT JOIN supplier b ON l_linenumber = b.s_suppkey
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey
  WHERE CAST(l_shipdate AS DATE) > DATE '1999-01-01'""",
    ints=("l_linenumber",),
)
def audit_export(spark, sf_dir):
    """One table in two roles, and a dimension that hangs off another."""
    line, orders, supplier, customer, part = _load(
        spark, sf_dir, "lineitem", "orders", "supplier", "customer", "part"
    )
    audits = line.select(
        F.col("l_orderkey").alias("audit_id"), "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").alias("created")
    )
    dims = [
        Dimension(
            orders.where(F.col("o_orderstatus") != "P"),
            {"audit_id": "o_orderkey"},
            {"o_totalprice": "order_value", "o_custkey": "_lead"},
        ),
        Dimension(supplier, {"l_suppkey": "s_suppkey"}, {"s_name": "agent"}),
        Dimension(supplier, {"l_linenumber": "s_suppkey"}, {"s_name": "auditor"}),
        Dimension(customer, {"_lead": "c_custkey"}, {"c_name": "lead_name"}),
        Dimension(part, {"l_partkey": "p_partkey"}, {"p_name": "case_name"}),
    ]
    return extracts.audit_export(audits, dims, "created", "1999-01-01").drop("_lead")


@query(
    "survey_summary",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(o_orderdate, '%Y-%m-%d') AS case_created, s_name AS agent,
    p_name AS product, r.c_name AS save_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey LEFT JOIN (SELECT * FROM customer WHERE c_acctbal < 0) r ON o_custkey = r.c_custkey
  WHERE CAST(o_orderdate AS DATE) > DATE '1998-01-01'""",
    ints=("l_linenumber",),
)
def survey_summary(spark, sf_dir):
    line, orders, supplier, part, customer = _load(
        spark, sf_dir, "lineitem", "orders", "supplier", "part", "customer"
    )
    surveys = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    cases = orders.withColumn("day", F.to_date("o_orderdate"))
    dims = [
        Dimension(cases, {"l_orderkey": "o_orderkey"}, {"day": "case_created", "o_custkey": "_save"}, "inner"),
        Dimension(supplier, {"l_suppkey": "s_suppkey"}, {"s_name": "agent"}, "inner"),
        Dimension(part, {"l_partkey": "p_partkey"}, {"p_name": "product"}, "inner"),
        Dimension(customer.where(F.col("c_acctbal") < 0), {"_save": "c_custkey"}, {"c_name": "save_name"}),
    ]
    return extracts.survey_summary(surveys, dims, "case_created", "1998-01-01").drop("_save")


@query(
    "domain_summary",
    """SELECT c_custkey AS id, c_mktsegment AS status, l_linenumber AS rateplan_id, l_partkey AS name, l_orderkey AS subscription_rateplan_id,
    l_suppkey AS subscription_id, CASE WHEN c_acctbal < 0 THEN 'local' ELSE lower(c_mktsegment) END AS domain_extension
  FROM customer JOIN (SELECT DISTINCT o_orderkey, o_custkey, o_orderkey % 5 AS rp FROM orders) o ON o_custkey = c_custkey
  JOIN lineitem ON l_orderkey = o_orderkey""".replace("l_linenumber AS rateplan_id", "o.rp AS rateplan_id"),
)
def domain_summary(spark, sf_dir):
    customer, orders, line = _load(spark, sf_dir, "customer", "orders", "lineitem")
    site = F.concat(F.lower("c_name"), F.lit(".shop."), F.lower("c_mktsegment"))
    subscriptions = customer.select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("status"),
        F.when(F.col("c_acctbal") < 0, "local").otherwise(site).alias("display_name"),
    )
    rate_plans = orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("subscription_id"),
        (F.col("o_orderkey") % 5).alias("rateplan_id"),
    )
    services = line.select(
        F.col("l_orderkey").alias("subscription_rateplan_id"), F.col("l_partkey").alias("name"),
        F.col("l_suppkey").alias("subscription_id"),
    )
    return extracts.domain_summary(subscriptions, rate_plans, services).drop("display_name")


@query(
    "named_batches",
    """SELECT 'orders' AS name, count(*) AS rows, count(DISTINCT o_custkey) AS keys FROM orders
  UNION ALL SELECT 'lineitem', count(*), count(DISTINCT l_orderkey) FROM lineitem
  UNION ALL SELECT 'events', count(*), count(DISTINCT user_id) FROM events""",
)
def named_batches(spark, sf_dir):
    from subledger.sources.readers import read_tables

    batches = read_tables(spark, sf_dir, ["orders", "lineitem", "events"])
    key = {"orders": "o_custkey", "lineitem": "l_orderkey", "events": "user_id"}
    parts = [
        df.agg(F.count("*").alias("rows"), F.countDistinct(key[name]).alias("keys")).select(
            F.lit(name).alias("name"), "rows", "keys"
        )
        for name, df in batches.items()
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "spine_daily",
    """SELECT strftime(d, '%Y-%m-%d') AS report_date, count(o_orderkey) AS orders FROM
    (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
  LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d""",
)
def spine_daily(spark, sf_dir):
    (orders,) = _load(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("report_date")).agg(F.count("*").alias("orders"))
    return DAYS.frame(spark).join(per_day, "report_date", "left").fillna(0, ["orders"])


@query(
    "spine_month_start",
    """SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month_start, strftime(last_day(l_shipdate), '%Y-%m-%d') AS month_end,
  count(*) AS lines, count(*) FILTER (day(l_shipdate) = 1) AS on_start FROM lineitem GROUP BY 1, 2""",
)
def spine_month_start(spark, sf_dir):
    (line,) = _load(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    return line.groupBy(month_start(day).alias("month_start"), month_end(day).alias("month_end")).agg(
        F.count("*").alias("lines"), F.count_if(F.dayofmonth(day) == 1).alias("on_start")
    )


@query(
    "predicates",
    """SELECT event_id, event_type FROM events WHERE coalesce(event_type, '') NOT IN ('click', 'view')
  AND CAST(ts AS DATE) >= CAST(DATE '2024-03-10' - INTERVAL 2 MONTH AS DATE) AND CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
  AND value <> 0 AND (value < 50 OR user_id IS NOT NULL)""",
)
def predicates(spark, sf_dir):
    (events,) = _load(spark, sf_dir, "events")
    as_of, day = F.lit("2024-03-10").cast("date"), F.to_date("ts")
    return events.where(
        type_not_in(F.col("event_type"), ["click", "view"])
        & within_months(day, as_of, 2)
        & day.between(F.date_sub(as_of, 69), F.date_sub(as_of, 40))
        & (F.col("value") != 0)
        & ((F.col("value") < 50) | F.col("user_id").isNotNull())
    ).select("event_id", "event_type")


@query(
    "rollup_totals",
    """SELECT p_type, p_brand, count(*) AS parts, CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
  CAST(grouping(p_type, p_brand) AS BIGINT) AS level FROM part GROUP BY ROLLUP (p_type, p_brand)""",
)
def rollup_totals(spark, sf_dir):
    (part,) = _load(spark, sf_dir, "part")
    return part.rollup("p_type", "p_brand").agg(
        F.count("*").alias("parts"), F.sum(inputs.money("p_retailprice")).alias("price"), F.grouping_id().alias("level")
    )


@query(
    "cube_totals",
    """SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
  CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS level FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def cube_totals(spark, sf_dir):
    (line,) = _load(spark, sf_dir, "lineitem")
    return line.cube("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("lines"), F.sum(inputs.money("l_quantity")).alias("quantity"), F.grouping_id().alias("level")
    )


@query(
    "having_filter",
    """SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
  min(o_totalprice) AS lowest, max(o_totalprice) AS highest, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average
  FROM orders GROUP BY o_custkey HAVING count(*) BETWEEN 10 AND 20 AND min(o_totalprice) > 1000""",
)
def having_filter(spark, sf_dir):
    (orders,) = _load(spark, sf_dir, "orders")
    total = F.sum(inputs.money("o_totalprice")).cast("double")
    grouped = orders.groupBy("o_custkey").agg(
        F.count("*").alias("orders"), total.alias("total"), F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"), (total / F.count("*")).alias("average"),
    )
    return grouped.where(F.col("orders").between(10, 20) & (F.col("lowest") > 1000))


@query(
    "top_n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice ASC, o_orderkey ASC LIMIT 10",
)
def top_n(spark, sf_dir):
    (orders,) = _load(spark, sf_dir, "orders")
    return orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey").limit(10)


@query(
    "string_profile",
    """SELECT doc_id, length(text) AS n_chars, length(trim(text)) AS n_trimmed, substr(text, 1, 3) AS head, substr(text, 2, 1) AS second,
  instr(text, 'the') AS first_the, length(text) - length(replace(text, 'e', '')) AS n_e, md5(replace(text, 'e', '3')) AS replaced_md5,
  repeat(lang, 2) AS lang_twice, text = '' AS is_empty, lang = 'en' AS is_en FROM documents""",
)
def string_profile(spark, sf_dir):
    (documents,) = _load(spark, sf_dir, "documents")
    text = F.col("text")
    return documents.select(
        "doc_id",
        F.length(text).alias("n_chars"),
        F.length(F.trim(text)).alias("n_trimmed"),
        F.substring(text, 1, 3).alias("head"),
        F.substring(text, 2, 1).alias("second"),
        F.instr(text, "the").alias("first_the"),
        F.regexp_count(text, F.lit("e")).alias("n_e"),
        F.md5(F.replace(text, F.lit("e"), F.lit("3"))).alias("replaced_md5"),
        F.repeat("lang", 2).alias("lang_twice"),
        (text == "").alias("is_empty"),
        (F.col("lang") == "en").alias("is_en"),
    )


@query(
    "array_lengths",
    """SELECT doc_id, len(w) AS words, len(list_distinct(w)) AS distinct_words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS letters,
  list_max(list_transform(w, lambda x: length(x))) AS longest FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)""",
)
def array_lengths(spark, sf_dir):
    (documents,) = _load(spark, sf_dir, "documents")
    words = documents.select("doc_id", F.split("text", " ").alias("w"))
    sizes = F.transform("w", lambda x: F.length(x))
    return words.select(
        "doc_id",
        F.size("w").alias("words"),
        F.size(F.array_distinct("w")).alias("distinct_words"),
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("letters"),
        F.array_max(sizes).alias("longest"),
    )


@query(
    "set_operations",
    """SELECT 'all' AS op, l_partkey AS k, count(*) AS n FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A') GROUP BY 2
  UNION ALL SELECT 'both', l_partkey, 1 FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'
    INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')
  UNION ALL SELECT 'rest', l_partkey, count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'
    EXCEPT ALL SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A') GROUP BY 2""",
)
def set_operations(spark, sf_dir):
    (line,) = _load(spark, sf_dir, "lineitem")
    returned = line.where(F.col("l_returnflag") == "R").select(F.col("l_partkey").alias("k"))
    accepted = line.where(F.col("l_returnflag") == "A").select(F.col("l_partkey").alias("k"))

    def counted(op, df):
        return df.groupBy("k").agg(F.count("*").alias("n")).select(F.lit(op).alias("op"), "k", "n")

    return (
        counted("all", returned.unionByName(accepted))
        .unionByName(counted("both", returned.intersect(accepted)))
        .unionByName(counted("rest", returned.exceptAll(accepted)))
    )


@query(
    "join_kinds",
    """SELECT 'left' AS kind, count(*) AS rows, count(o_orderkey) AS matched FROM customer LEFT JOIN orders ON c_custkey = o_custkey + 100
  UNION ALL SELECT 'right', count(*), count(c_custkey) FROM customer RIGHT JOIN orders ON c_custkey = o_custkey + 100
  UNION ALL SELECT 'full', count(*), count(c_custkey) FROM customer FULL JOIN orders ON c_custkey = o_custkey + 100
  UNION ALL SELECT 'inner', count(*), count(c_custkey) FROM customer JOIN orders ON c_custkey = o_custkey + 100
  UNION ALL SELECT 'semi', count(*), count(c_custkey) FROM customer WHERE c_custkey IN (SELECT o_custkey + 100 FROM orders)""",
)
def join_kinds(spark, sf_dir):
    customer, orders = _load(spark, sf_dir, "customer", "orders")
    left = customer.select("c_custkey")
    right = orders.select((F.col("o_custkey") + 100).alias("k"), "o_orderkey")
    counted = {"left": "o_orderkey", "right": "c_custkey", "full": "c_custkey", "inner": "c_custkey", "semi": "c_custkey"}
    parts = [
        left.join(right, left.c_custkey == right.k, kind)
        .agg(F.count("*").alias("rows"), F.count(column).alias("matched"))
        .select(F.lit(kind).alias("kind"), "rows", "matched")
        for kind, column in counted.items()
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "correlated_subquery",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
  WHERE o_totalprice = (SELECT max(i.o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)""",
)
def correlated_subquery(spark, sf_dir):
    (orders,) = _load(spark, sf_dir, "orders")
    top = orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("o_totalprice"))
    return orders.select("o_orderkey", "o_custkey", "o_totalprice").join(top, ["o_custkey", "o_totalprice"])


@query(
    "like_and_greater",
    "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'sm%' AND p_size > 10 AND NOT p_type IN ('ECONOMY') AND p_retailprice >= ALL (SELECT 900)",
)
def like_and_greater(spark, sf_dir):
    (part,) = _load(spark, sf_dir, "part")
    return part.where(
        F.col("p_name").like("sm%")
        & (F.col("p_size") > 10)
        & ~F.col("p_type").isin("ECONOMY")
        & (F.col("p_retailprice") >= 900)
    ).select("p_partkey", "p_name")


@query(
    "case_and_coalesce",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(nullif(l_returnflag, 'N'), l_linestatus) AS flag,
  CASE WHEN l_quantity < 10 THEN 'low' WHEN l_quantity < 30 THEN 'mid' ELSE 'high' END AS band,
  l_quantity * 2 + 1 AS twice FROM lineitem""",
    ints=("l_linenumber",),
)
def case_and_coalesce(spark, sf_dir):
    (line,) = _load(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.coalesce(F.nullif("l_returnflag", F.lit("N")), "l_linestatus").alias("flag"),
        F.when(F.col("l_quantity") < 10, "low").when(F.col("l_quantity") < 30, "mid").otherwise("high").alias("band"),
        (F.col("l_quantity") * 2 + 1).alias("twice"),
    )
