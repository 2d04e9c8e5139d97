"""Nested documents and JSON text, flattened."""

from __future__ import annotations

from pyspark.sql import functions as F

from subledger.functions.scalars import last_label
from subledger.operators import flatten
from subledger.sources.readers import read_records, unread_records
from subledger.session import scratch_path
from workload import inputs
from workload.inputs import CARTS_SQL
from workload.registry import query

# Cells that only some kinds of rows have.
_CELLS = """CASE WHEN grain IN ('plan', 'onetime', 'recurring') THEN tag || pk END AS add_plan,
  CASE WHEN grain = 'onetime' THEN 'o' || pk END AS onetime_id,
  CASE WHEN grain = 'onetime' THEN actual END AS onetime_actual_price,
  CASE WHEN grain = 'onetime' THEN price END AS onetime_price,
  CASE WHEN grain = 'recurring' THEN ctag || pk END AS recurring_id,
  CASE WHEN grain = 'recurring' THEN ctag END AS recurring_name,
  CASE WHEN grain = 'recurring' THEN disc END AS recurring_discount,
  CASE WHEN grain = 'recurring' THEN CAST(ln AS DOUBLE) END AS recurring_billingperiod"""


def _cells(prefix: str):
    return [
        F.col(f"{prefix}rate_plan_id").alias("add_plan"),
        "onetime_id",
        "onetime_actual_price",
        "onetime_price",
        "recurring_id",
        "recurring_name",
        F.col("recurring_discountAmount").alias("recurring_discount"),
        "recurring_billingperiod",
    ]


@query(
    "flatten_carts_new",
    f"""WITH {CARTS_SQL}, grains AS (
    SELECT l.*, tag, grain, ctag FROM l JOIN charges ON pln = ln
    UNION ALL SELECT l.*, t.tag, 'remove', '' FROM l, (VALUES ('x'), ('y')) t(tag) WHERE odd = 0
    UNION ALL SELECT l.*, 'e', 'existing', '' FROM l WHERE ln % 3 = 0)
  SELECT id, created_at, kind AS cart_type, cart_id, bid AS business_id, 'web' AS meta_flow, uid AS user_id,
    sid AS subscription_id, '' AS "baseProductId", sno AS "subscriptionNumber", domain, ext AS domain_extension,
    'go' AS "action", {_CELLS},
    CASE WHEN grain IN ('plan', 'onetime', 'recurring') THEN family END AS add_family,
    CASE WHEN grain = 'remove' THEN tag || pk END AS remove_plan, CASE WHEN grain = 'remove' THEN sk END AS remove_product,
    CASE WHEN grain = 'existing' THEN tag || pk END AS existing_plan,
    CASE WHEN grain = 'existing' THEN 'live' END AS existing_status
  FROM grains WHERE ln <> 6 AND kind NOT IN ('change', 'reactivate', 'update')""",
)
def flatten_carts_new(spark, sf_dir):
    rows = flatten.flatten_carts_new(inputs.carts(spark, sf_dir), keep=("id", "created_at"), business_id=True)
    return rows.select(
        "id", "created_at", "cart_type", "cart_id", "business_id", "meta_flow", "user_id", "subscription_id",
        "baseProductId", "subscriptionNumber", "domain", "domain_extension", "action", *_cells("addRatePlans_"),
        F.col("addRatePlans_family").alias("add_family"),
        F.col("removeRatePlans_rate_plan_id").alias("remove_plan"),
        F.col("removeRatePlans_product_id").alias("remove_product"),
        F.col("existingRatePlans_rate_plan_id").alias("existing_plan"),
        F.col("existingRatePlans_ratePlanStatus").alias("existing_status"),
    )


@query(
    "flatten_carts_change",
    f"""WITH {CARTS_SQL}
  SELECT id, created_at, kind AS cart_type, cart_id, sno AS "subscriptionNumber", domain, ext AS domain_extension,
    CASE WHEN ln IN (1, 2, 4) THEN 'a' || pk WHEN ln IN (3, 5) THEN 'b' || pk END AS add_plan,
    CASE WHEN odd = 0 THEN 'y' || pk END AS remove_plan, CASE WHEN odd = 0 THEN ptype END AS remove_type,
    CASE WHEN ln % 3 = 0 THEN 'e' || pk END AS existing_plan, CASE WHEN ln % 3 = 0 THEN 'live' END AS existing_status
  FROM l WHERE ln <> 6 AND kind = 'change'""",
)
def flatten_carts_change(spark, sf_dir):
    rows = flatten.flatten_carts_change(inputs.carts(spark, sf_dir), keep=("id", "created_at"))
    return rows.select(
        "id", "created_at", "cart_type", "cart_id", "subscriptionNumber", "domain", "domain_extension",
        F.col("addRatePlans_rate_plan_id").alias("add_plan"),
        F.col("removeRatePlans_rate_plan_id").alias("remove_plan"),
        F.col("removeRatePlans_rateplan_type").alias("remove_type"),
        F.col("existingRatePlans_rate_plan_id").alias("existing_plan"),
        F.col("existingRatePlans_ratePlanStatus").alias("existing_status"),
    )


@query(
    "flatten_carts_reactivate",
    f"""WITH {CARTS_SQL}, grains AS (
    SELECT l.*, tag, grain, ctag FROM l JOIN charges ON pln = ln
    UNION ALL SELECT l.*, '', 'cart', '' FROM l WHERE ln = 6)
  SELECT id, created_at, cart_id, promo, CASE WHEN ln <> 6 THEN sid END AS subscription_domain,
    CASE WHEN ln <> 6 THEN domain END AS domain_name, CASE WHEN ln <> 6 THEN ext END AS domain_extension,
    CASE WHEN ln <> 6 THEN ln = 1 END AS "prOrderable", {_CELLS}
  FROM grains WHERE kind = 'reactivate'""",
)
def flatten_carts_reactivate(spark, sf_dir):
    rows = flatten.flatten_carts_reactivate(inputs.carts(spark, sf_dir), keep=("id", "created_at"))
    return rows.select(
        "id", "created_at", "cart_id", "promo", "subscription_domain", "domain_name", "domain_extension",
        "prOrderable", *_cells(""),
    )


@query(
    "flatten_carts_all",
    f"""WITH {CARTS_SQL}, grains AS (
    SELECT l.*, tag, grain, ctag FROM l JOIN charges ON pln = ln
    UNION ALL SELECT l.*, '', 'bare', '' FROM l WHERE ln = 7)
  SELECT id, created_at, cart_id, promo, sid AS subscription_id, domain, ext AS domain_extension, {_CELLS}
  FROM grains WHERE ln <> 6""",
)
def flatten_carts_all(spark, sf_dir):
    rows = flatten.flatten_carts_all(inputs.carts(spark, sf_dir), keep=("id", "created_at"))
    return rows.select(
        "id", "created_at", "cart_id", "promo", "subscription_id", "domain", "domain_extension", *_cells("")
    )


@query(
    "flatten_refund_items",
    """SELECT l_orderkey || '-' || l_linenumber AS id, tag || l_partkey AS subscription_id,
    l_extendedprice AS amount, l_returnflag AS status, strftime(l_shipdate, '%Y-%m-%d') AS service_start_date,
    l_extendedprice AS charge_amount, tag AS charge_name, l_quantity AS quantity, l_tax AS tax_amount,
    CAST(l_suppkey AS VARCHAR) AS product_id, CASE WHEN l_linenumber = 2 THEN 'Recurring' END AS charge_type,
    CAST(NULL AS DOUBLE) AS unit_price, strftime(l_shipdate, '%Y-%m-%d') AS created_date
  FROM lineitem JOIN (VALUES (1, 'x'), (2, 'x'), (2, 'y')) t(rest, tag) ON l_linenumber % 3 = rest
  WHERE l_orderkey % 89 <> 0""",
)
def flatten_refund_items(spark, sf_dir):
    rows = flatten.flatten_refund_items(inputs.refunds(spark, sf_dir))
    return rows.select(
        "id", "subscription_id", "amount", "status", "service_start_date", "charge_amount", "charge_name", "quantity",
        "tax_amount", "product_id", "charge_type", "unit_price", "created_date",
    )


@query(
    "bad_carts",
    """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id,
    CASE WHEN l_orderkey % 89 = 0 THEN 'document' ELSE 'subscription' END AS level FROM lineitem
  WHERE l_orderkey % 89 = 0 OR (l_orderkey % 13 = 0 AND l_linenumber <> 6)""",
)
def bad_carts(spark, sf_dir):
    """What the flatteners of carts couldn't read."""
    return flatten.bad_carts(inputs.carts(spark, sf_dir), keep=("id",)).select("id", "level")


@query(
    "bad_refund_items",
    """SELECT l_orderkey || '-' || l_linenumber AS id, CASE WHEN l_orderkey % 89 = 0 THEN 'document' ELSE 'item' END AS level
  FROM lineitem WHERE l_orderkey % 89 = 0 OR (l_orderkey % 13 = 0 AND l_linenumber % 3 <> 0)""",
)
def bad_refund_items(spark, sf_dir):
    return flatten.bad_refund_items(inputs.refunds(spark, sf_dir), keep=("id",)).select("id", "level")


@query(
    "extract_meta",
    """SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS meta_k,
    CAST(NULL AS VARCHAR) AS meta_unit_price FROM events""",
)
def extract_meta(spark, sf_dir):
    events = inputs.load(spark, sf_dir, "events").select("event_id", "user_id", "props")
    return flatten.extract_json(
        events, "props", {"meta_k": ("k", "bigint"), "meta_unit_price": ("priceDetails.unitPrice", "string")}
    )


def _order_meta(spark, sf_dir):
    k = F.col("o_orderkey")
    meta = F.to_json(
        F.struct(
            k.cast("string").alias("itemID"),
            F.col("o_orderpriority").alias("info"),
            F.when(k % 2 == 0, "5").otherwise("many").alias("licenses"),
            F.struct(F.col("o_totalprice").alias("unitPrice")).alias("priceDetails"),
        )
    )
    return inputs.load(spark, sf_dir, "orders").select("o_orderkey", meta.alias("meta"))


@query(
    "bad_meta",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'no json' ELSE '[5]' END AS text FROM orders
  WHERE o_orderkey % 11 = 0 OR o_orderkey % 17 = 0""",
)
def bad_meta(spark, sf_dir):
    """Orders whose metadata can't be read, next to those whose can."""
    k = F.col("o_orderkey")
    broken = F.when(k % 11 == 0, "no json").when(k % 17 == 0, "[5]").otherwise(F.col("meta"))
    return flatten.bad_json(_order_meta(spark, sf_dir).withColumn("meta", broken), "meta", ["o_orderkey"])


@query(
    "extract_order_meta",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS meta_item, o_totalprice AS meta_unit_price,
    o_orderpriority AS meta_info, CASE WHEN o_orderkey % 2 = 0 THEN CAST(5 AS DOUBLE) END AS meta_licenses FROM orders""",
)
def extract_order_meta(spark, sf_dir):
    return flatten.extract_json(
        _order_meta(spark, sf_dir),
        "meta",
        {
            "meta_item": ("itemID", "string"),
            "meta_unit_price": ("priceDetails.unitPrice", "double"),
            "meta_info": ("info", "string"),
            "meta_licenses": ("licenses", "double"),
        },
    )


@query(
    "flatten_struct",
    """SELECT c_custkey AS "Id", c_name AS "Name", n_name AS "Address.State", r_name AS "Address.Region.Name"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def flatten_struct(spark, sf_dir):
    return flatten.flatten_struct(_records(spark, sf_dir))


def _records(spark, sf_dir):
    nation, region = inputs.load(spark, sf_dir, "nation"), inputs.load(spark, sf_dir, "region")
    return (
        inputs.load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.struct(F.lit("Customer").alias("type")).alias("attributes"),
            F.col("c_custkey").alias("Id"),
            F.col("c_name").alias("Name"),
            F.struct(
                F.col("n_name").alias("State"), F.struct(F.col("r_name").alias("Name")).alias("Region")
            ).alias("Address"),
        )
    )


@query(
    "read_records",
    """SELECT c_custkey AS "Id", c_name AS "Name", n_name AS "Address.State", r_name AS "Address.Region.Name"
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def read_json_records(spark, sf_dir):
    records = _records(spark, sf_dir)
    path = scratch_path(spark, "records")
    records.select(F.array(F.struct("*")).alias("records")).write.json(path)
    return flatten.flatten_struct(read_records(spark, path, records.schema))


# Customers whose lines are cut short, and those before whom a list holds something else.
CUT_LINE, NO_RECORD = 11, 7


def _landed_records(spark, sf_dir):
    """Record documents of which some can't be read, and the type of a record."""
    records, key = _records(spark, sf_dir), F.col("Id")
    line = F.to_json(F.struct(F.array(F.struct("*")).alias("records")))
    line = F.when(key % NO_RECORD == 0, F.replace(line, F.lit('"records":['), F.lit('"records":["none",{"Id":"x"},'))).otherwise(line)
    line = F.when(key % CUT_LINE == 0, F.left(line, F.length(line) - 1)).otherwise(line)
    path = scratch_path(spark, "records")
    records.select(line.alias("value")).write.text(path)
    return path, records.schema


@query(
    "read_records_kept",
    f"""WITH c AS (
    SELECT c_custkey AS "Id", c_name AS "Name", n_name AS "Address.State", r_name AS "Address.Region.Name"
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE c_custkey % {CUT_LINE} <> 0)
  SELECT * FROM c UNION ALL SELECT NULL, NULL, NULL, NULL FROM c WHERE "Id" % {NO_RECORD} = 0""",
)
def read_records_kept(spark, sf_dir):
    """Records of documents of which some can't be read."""
    path, record = _landed_records(spark, sf_dir)
    return flatten.flatten_struct(read_records(spark, path, record, bad_records="keep"))


@query(
    "bad_records",
    f"""SELECT CASE WHEN n = 0 THEN 'document' ELSE 'record' END AS level, CASE n WHEN 1 THEN 'none' WHEN 2 THEN '{{"Id":"x"}}' END AS text,
    CASE WHEN n = 0 THEN c_name END AS customer
  FROM customer, (VALUES (0), (1), (2)) t(n)
  WHERE CASE WHEN n = 0 THEN c_custkey % {CUT_LINE} = 0 ELSE c_custkey % {CUT_LINE} <> 0 AND c_custkey % {NO_RECORD} = 0 END""",
)
def bad_records(spark, sf_dir):
    """What couldn't be read of them: whose line it is, or the record's text."""
    level, text = F.col("level"), F.col("text")
    name = F.regexp_extract(text, '"Name":"([^"]*)"', 1)
    return unread_records(spark, *_landed_records(spark, sf_dir)).select(
        level, F.when(level == "record", text).alias("text"), F.when(level == "document", name).alias("customer")
    )


@query(
    "raw_copy",
    """SELECT event_id, props, CASE WHEN value < 1 THEN '###' ELSE event_type END AS event_type FROM events""",
)
def raw_copy(spark, sf_dir):
    rows = inputs.load(spark, sf_dir, "events").select(
        "event_id", "props", F.when(F.col("value") >= 1, F.col("event_type")).alias("event_type")
    )
    return rows.fillna("###")


@query(
    "domain_labels",
    r"""SELECT page_id, regexp_extract(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1), '([^.]*)$', 1) AS label,
  regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host FROM pages""",
)
def domain_labels(spark, sf_dir):
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#:]*)", 1)
    return inputs.load(spark, sf_dir, "pages").select("page_id", last_label(host).alias("label"), host.alias("host"))
