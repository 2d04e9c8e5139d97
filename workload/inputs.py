"""Subscription data derived row by row from the order tables.

Each input exists twice: as a DataFrame and as a DuckDB expression, so that
the checking SQL starts from the same values. No derivation looks at another
row, so none of them groups or sorts by a customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.functions.dates import Spine

# Report dates: every date the data has. The last orders end in mid 2002.
DAYS = Spine.of("1995-01-01", "2002-12-31")
MONTHS = Spine.of("1995-01-01", "2002-12-31", "month")
DAYS_SQL = "(SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2002-12-31', INTERVAL 1 DAY)) AS DATE) AS d)"
MONTHS_SQL = "(SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2002-12-31', INTERVAL 1 MONTH)) AS DATE) AS d)"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines dealt by their order, as the join with orders wants them;
    what is derived from them row by row is so spread over all tasks."""
    return load(spark, sf_dir, "lineitem").repartition("l_orderkey")


def lines_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines dealt evenly for documents, which take far more time to make
    and to read than the lines take room: the number of parts is stated, as
    adaptive execution would merge them by their size to hardly more than there
    are cores, and leave most of those idle for the last few."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return load(spark, sf_dir, "lineitem").repartition(parts, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def hundredths(column: str) -> Column:
    """``cast(round(100 * column) as bigint)``, halves away from zero, without
    the decimal arithmetic in which Spark rounds doubles."""
    value = F.col(column) * 100
    whole = value.cast("bigint")
    return whole + F.when(F.abs(value - whole) >= 0.5, F.signum(value).cast("bigint")).otherwise(0)


def present(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text and decimals as doubles, so that both
    engines hand over the same plain types."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(out)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned subscription fact: a row per order line."""
    k, od = F.col("o_orderkey"), F.to_date("o_orderdate")
    orders = load(spark, sf_dir, "orders")
    lines = lines_by_order(spark, sf_dir)
    parts = load(spark, sf_dir, "part")

    def shift(days: Column) -> Column:
        return F.date_add(od, days.cast("int"))

    previous = F.when(k % 7 != 0, F.concat(F.lit("I"), (k - 1).cast("string")))
    termed = F.col("l_returnflag") != "N"
    cents, percent = hundredths("l_extendedprice"), hundredths("l_discount")
    monthly = F.expr("_x div 1200").cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")
    return (
        lines.join(orders, F.col("l_orderkey") == k)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("_x", cents * (F.lit(100) - percent) + 600)
        .select(
            F.concat(F.lit("A"), (F.col("o_custkey") % 1000).cast("string")).alias("account_id"),
            F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("sub_name"),
            F.concat(F.lit("I"), k.cast("string")).alias("sub_id"),
            (F.lit(1) + F.greatest(F.lit(0), F.year(od) - 1995 - (k % 4).cast("int"))).cast("int").alias("sub_version"),
            F.when(F.col("o_orderstatus") == "F", "Cancelled").otherwise("Active").alias("sub_status"),
            F.when(termed, "TERMED").otherwise("EVERGREEN").alias("term_type"),
            F.when(termed, F.col("l_linenumber")).alias("renewal_term"),
            od.alias("term_start"),
            F.date_add(od, 365).alias("term_end"),
            shift(-(k % 10)).cast("timestamp").alias("sub_created"),
            F.when(
                F.col("o_orderstatus") == "F",
                shift(F.when(k % 10 < 3, k % 7 - 3).otherwise(k % 300 + 30)),
            ).alias("cancelled"),
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("rp_id"),
            F.col("p_brand").alias("rp_name"),
            shift(k % 9 - 4).cast("timestamp").alias("rp_created"),
            F.col("p_type").alias("product_name"),
            F.split_part("p_name", F.lit(" "), F.lit(2)).alias("product_family"),
            F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("plan_id"),
            F.when(k % 4 == 1, "NewProduct")
            .when(k % 4 == 2, "RemoveProduct")
            .when(k % 4 == 3, "UpdateProduct")
            .alias("amend_type"),
            F.when((k % 4 != 0) & (k % 5 != 0), shift(k % 60 - 30)).alias("amend_eff"),
            shift(k % 45).alias("amend_created"),
            F.when(k % 3 == 0, F.concat(F.lit("I"), k.cast("string"))).otherwise(previous).alias("amend_sub_id"),
            previous.alias("prev_id"),
            F.when(k % 50 != 0, monthly).cast("decimal(18,2)").alias("mrr"),
            money("l_extendedprice").alias("tcv"),
            shift(F.col("l_linenumber") * 30 + 30).alias("charged_through"),
            F.when(F.col("o_custkey") % 5 == 0, "EUR").otherwise("USD").alias("currency"),
            F.concat(
                F.when(k % 97 == 0, "qa-").otherwise("site-"),
                k.cast("string"),
                F.when(k % 2 == 0, ".com").otherwise(".org"),
            ).alias("display_name"),
            F.col("l_quantity").alias("quantity"),
            F.to_date("l_shipdate").alias("ship_date"),
            F.col("l_partkey").alias("part_key"),
            F.col("l_suppkey").alias("supp_key"),
        )
    )


# Attributes of the fact that no row lacks.
KNOWN = [
    "account_id", "sub_name", "sub_id", "sub_version", "sub_status", "term_type", "term_start", "term_end", "sub_created",
    "rp_name", "rp_created", "product_name", "product_family", "plan_id", "amend_created", "charged_through", "currency",
    "display_name", "quantity", "ship_date", "part_key", "supp_key",
]


# The same fact for the checking SQL: ``z`` is a name for WITH.
FACTS_SQL = """z AS (
  SELECT 'A' || (o_custkey % 1000) AS account_id,
         'S' || o_custkey AS sub_name,
         'I' || o_orderkey AS sub_id,
         CAST(1 + greatest(0, year(od) - 1995 - o_orderkey % 4) AS INTEGER) AS sub_version,
         CASE WHEN o_orderstatus = 'F' THEN 'Cancelled' ELSE 'Active' END AS sub_status,
         CASE WHEN l_returnflag <> 'N' THEN 'TERMED' ELSE 'EVERGREEN' END AS term_type,
         CASE WHEN l_returnflag <> 'N' THEN l_linenumber END AS renewal_term,
         od AS term_start,
         od + 365 AS term_end,
         od - CAST(o_orderkey % 10 AS INTEGER) AS sub_created,
         CASE WHEN o_orderstatus = 'F' THEN od + CAST(CASE WHEN o_orderkey % 10 < 3 THEN o_orderkey % 7 - 3
              ELSE 30 + o_orderkey % 300 END AS INTEGER) END AS cancelled,
         l_orderkey || '-' || l_linenumber AS rp_id,
         p_brand AS rp_name,
         od + CAST(o_orderkey % 9 - 4 AS INTEGER) AS rp_created,
         p_type AS product_name,
         split_part(p_name, ' ', 2) AS product_family,
         'P' || p_partkey AS plan_id,
         CASE o_orderkey % 4 WHEN 1 THEN 'NewProduct' WHEN 2 THEN 'RemoveProduct' WHEN 3 THEN 'UpdateProduct' END AS amend_type,
         CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 5 <> 0 THEN od + CAST(o_orderkey % 60 - 30 AS INTEGER) END AS amend_eff,
         od + CAST(o_orderkey % 45 AS INTEGER) AS amend_created,
         CASE WHEN o_orderkey % 3 = 0 THEN 'I' || o_orderkey WHEN o_orderkey % 7 <> 0 THEN 'I' || (o_orderkey - 1) END AS amend_sub_id,
         CASE WHEN o_orderkey % 7 <> 0 THEN 'I' || (o_orderkey - 1) END AS prev_id,
         CASE WHEN o_orderkey % 50 <> 0 THEN CAST((CAST(round(l_extendedprice * 100) AS BIGINT)
              * (100 - CAST(round(l_discount * 100) AS BIGINT)) + 600) // 1200 AS DECIMAL(18,0)) * 0.01 END AS mrr,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS tcv,
         od + CAST(l_linenumber * 30 + 30 AS INTEGER) AS charged_through,
         CASE WHEN o_custkey % 5 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
         CASE WHEN o_orderkey % 97 = 0 THEN 'qa-' ELSE 'site-' END || o_orderkey
           || CASE WHEN o_orderkey % 2 = 0 THEN '.com' ELSE '.org' END AS display_name,
         l_quantity AS quantity,
         CAST(l_shipdate AS DATE) AS ship_date,
         l_partkey AS part_key,
         l_suppkey AS supp_key
  FROM lineitem
  JOIN (SELECT *, CAST(o_orderdate AS DATE) AS od FROM orders) ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey)"""


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of accounts: several customers share an account."""
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    return (
        load(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("A"), (F.col("c_custkey") % 1000).cast("string")).alias("account_id"),
            F.col("r_name").alias("country"),
            F.nullif("n_name", F.lit("NATION_3")).alias("state"),
            F.col("c_mktsegment").alias("city"),
        )
    )


CONTACTS_SQL = """contacts AS (
  SELECT 'A' || (c_custkey % 1000) AS account_id, r_name AS country, nullif(n_name, 'NATION_3') AS state,
         c_mktsegment AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue schedule: a line's price, booked in its period on its day.

    Some lines are booked in the period after their day.
    """
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    late = F.when(F.col("l_linenumber") == 7, F.add_months("l_shipdate", 1)).otherwise(F.to_date("l_shipdate"))
    return (
        load(spark, sf_dir, "lineitem")
        .join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(load(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.date_format(late, "yyyy-MM").alias("accounting_period"),
            F.to_date("l_shipdate").alias("revenue_date"),
            F.col("p_type").alias("product_name"),
            F.col("r_name").alias("region"),
            F.when(F.col("s_suppkey") % 5 == 0, "EUR").otherwise("USD").alias("currency"),
            money("l_extendedprice").alias("revenue_amount"),
        )
    )


def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounting periods: the months in which something was shipped."""
    month = F.trunc("l_shipdate", "MM")
    return (
        load(spark, sf_dir, "lineitem")
        .select(month.alias("start_date"))
        .distinct()
        .select(
            F.date_format("start_date", "yyyy-MM").alias("name"), "start_date", F.last_day("start_date").alias("end_date")
        )
    )


SCHEDULE_SQL = """schedule AS (
  SELECT strftime(CASE WHEN l_linenumber = 7 THEN CAST(l_shipdate AS DATE) + INTERVAL 1 MONTH ELSE l_shipdate END, '%Y-%m') AS accounting_period,
         CAST(l_shipdate AS DATE) AS revenue_date, p_type AS product_name, r_name AS region,
         CASE WHEN s_suppkey % 5 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS revenue_amount
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
periods AS (
  SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS name, CAST(date_trunc('month', l_shipdate) AS DATE) AS start_date,
         CAST(last_day(l_shipdate) AS DATE) AS end_date
  FROM lineitem)"""


# Orders whose carts end too early, and those whose carts list something else
# before their subscription.
BROKEN_CART, BROKEN_SUBSCRIPTION = 89, 13


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cart document per order line, of the shape its keys decide."""
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    text = lambda c: c.cast("string")
    price = F.struct(
        F.lit("USD").alias("currency"),
        F.col("l_extendedprice").alias("actualPrice"),
        F.when(ln == 3, F.lit("abc")).otherwise(text(F.col("l_quantity"))).alias("price"),
        F.col("l_discount").alias("discountAmount"),
    )

    def charge(tag: str) -> Column:
        return F.struct(
            F.concat(F.lit(tag), text(pk)).alias("id"),
            F.lit(tag).alias("name"),
            text(F.col("l_suppkey")).alias("chargeId"),
            F.lit("flat").alias("chargeModel"),
            price.alias("priceDetails"),
            ln.alias("billingPeriod"),
        )

    def plan(tag: str, *more: Column) -> Column:
        return F.struct(
            F.concat(F.lit(tag), text(pk)).alias("ratePlanId"),
            text(F.col("l_suppkey")).alias("productId"),
            F.col("l_returnflag").alias("type"),
            F.col("l_linestatus").alias("family"),
            *more,
        )

    def charges(onetime: bool, recurring: int) -> Column:
        once = F.array(charge("o")) if onetime else F.array().cast("array<string>")
        again = [charge(f"r{i}") for i in range(recurring)]
        return F.struct(
            once.alias("onetime"), (F.array(*again) if again else F.array().cast("array<string>")).alias("recurring")
        ).alias("charges")

    def listed(*plans: Column) -> Column:
        return F.concat(F.lit("["), F.concat_ws(",", *[F.to_json(p) for p in plans]), F.lit("]"))

    added = F.when(ln == 1, listed(plan("a", charges(True, 2)))).when(ln == 2, listed(plan("a")))
    added = added.when(ln.isin(3, 5), listed(plan("a", charges(True, 0)), plan("b", charges(False, 1))))
    added = added.when(ln == 4, listed(plan("a", charges(False, 0)))).otherwise(F.lit("[]"))
    removed = F.when(ln % 2 == 0, listed(plan("x"), plan("y"))).otherwise(F.lit("[]"))
    kept = F.when(ln % 3 == 0, listed(plan("e", F.lit("live").alias("ratePlanStatus")))).otherwise(F.lit("[]"))
    kind = F.element_at(F.array(*map(F.lit, ["change", "reactivate", "update", "buy", ""])), (ok % 5 + 1).cast("int"))
    meta = F.concat(
        F.lit('{"domain":"'),
        F.when(ok % 3 == 0, "").otherwise(F.concat(F.lit("site"), text(ok), F.lit(".shop.net"))),
        F.lit('","action":"go","prOrderable":'),
        F.when(ln == 1, "true").otherwise("false"),
        F.lit("}"),
    )
    subscription = F.concat(
        F.lit('{"id":"s'), text(ok), F.lit('","subscriptionNumber":"n'), text(ln), F.lit('","meta":'), meta,
        F.lit(',"addRatePlans":'), added, F.lit(',"removeRatePlans":'), removed,
        F.lit(',"existingRatePlans":'), kept, F.lit("}"),
    )
    broken = F.when(ok % BROKEN_SUBSCRIPTION == 0, '"no subscription",').otherwise("")
    document = F.concat(
        F.lit('{"id":"c'), text(ok), F.lit('","type":"'), kind, F.lit('","promo":"p'), text(ln),
        F.lit('","meta":{"flow":"web","whois":{"businessId":"b'), text(F.col("l_suppkey")),
        F.lit('"}},"user":{"userId":"u'), text(pk), F.lit('"}'),
        F.when(ln == 6, "").otherwise(F.concat(F.lit(',"subscriptions":['), broken, subscription, F.lit("]"))),
        F.when(ok % BROKEN_CART != 0, "}").otherwise(""),
    )
    # Charges of a kind that nobody reads, next to the others.
    document = F.replace(document, F.lit('"charges":{"onetime"'), F.lit('"charges":{"usage":5,"onetime"'))
    return lines_spread(spark, sf_dir).select(
        F.concat_ws("-", text(ok), text(ln), text(pk), text(F.col("l_suppkey"))).alias("id"),
        F.to_date("l_shipdate").alias("created_at"),
        document.alias("cart"),
    )


# The documents' fields for the checking SQL, without any JSON.
CARTS_SQL = """l AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id,
         strftime(l_shipdate, '%Y-%m-%d') AS created_at, 'c' || l_orderkey AS cart_id,
         CASE l_orderkey % 5 WHEN 0 THEN 'change' WHEN 1 THEN 'reactivate' WHEN 2 THEN 'update' WHEN 3 THEN 'buy' ELSE '' END AS kind,
         's' || l_orderkey AS sid, 'n' || l_linenumber AS sno,
         CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE 'site' || l_orderkey || '.shop.net' END AS domain,
         CASE WHEN l_orderkey % 3 = 0 THEN '' ELSE '.net' END AS ext,
         l_linenumber AS ln, l_linenumber % 2 AS odd, 'p' || l_linenumber AS promo, 'b' || l_suppkey AS bid,
         'u' || l_partkey AS uid, CAST(l_partkey AS VARCHAR) AS pk, CAST(l_suppkey AS VARCHAR) AS sk,
         l_returnflag AS ptype, l_linestatus AS family,
         l_extendedprice AS actual, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS price, l_discount AS disc
  FROM lineitem WHERE l_orderkey % 89 <> 0),
plans AS (  -- added plans: tag, onetime charges, recurring charges; -1 = plan without charges
  SELECT * FROM (VALUES (1, 'a', 1, 2), (2, 'a', -1, -1), (3, 'a', 1, 0), (3, 'b', 0, 1), (5, 'a', 1, 0), (5, 'b', 0, 1),
                        (4, 'a', 0, 0)) p(pln, tag, n_once, n_rec)),
charges AS (
  SELECT pln, tag, 'plan' AS grain, '' AS ctag FROM plans WHERE n_once < 0
  UNION ALL SELECT pln, tag, 'onetime', 'o' FROM plans WHERE n_once > 0
  UNION ALL SELECT pln, tag, 'recurring', 'r' || i FROM plans, (VALUES (0), (1)) r(i) WHERE i < n_rec)"""


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refund per order line whose document lists none, one or two items."""
    ln = F.col("l_linenumber")

    def item(tag: str) -> Column:
        return F.struct(
            F.to_date("l_shipdate").cast("string").alias("serviceStartDate"),
            F.col("l_extendedprice").alias("chargeAmount"),
            F.lit(tag).alias("chargeName"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_tax").alias("taxAmount"),
            F.concat(F.lit(tag), F.col("l_partkey").cast("string")).alias("subscriptionId"),
            F.col("l_suppkey").cast("string").alias("productId"),
            F.when(ln == 2, F.lit("Recurring")).alias("chargeType"),
        )

    items = F.when(ln % 3 == 0, F.lit("[]")).when(ln % 3 == 1, F.to_json(F.array(item("x"))))
    items = items.otherwise(F.to_json(F.array(item("x"), item("y"))))
    # Some lists hold something else before their items, and some end too early.
    items = F.when(F.col("l_orderkey") % 13 == 0, F.regexp_replace(items, r"^\[\{", '["no item",{')).otherwise(items)
    items = F.when(F.col("l_orderkey") % 89 == 0, F.substr(items, F.lit(1), F.length(items) - 1)).otherwise(items)
    return lines_spread(spark, sf_dir).select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), ln.cast("string")).alias("id"),
        F.lit("parent").alias("subscription_id"),
        money("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("status"),
        items.alias("invoice_items"),
        F.col("l_shipdate").alias("created_at"),
    )
