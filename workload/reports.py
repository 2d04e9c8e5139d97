"""Subscription reports. The SQL states each rule per report date, as a cross
of facts and dates; the DataFrame side never forms that product."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from subledger.operators.pivots import OTHER, with_total_row
from subledger.plans import customers, daily, disconnects, pivots, revenue
from subledger.plans.daily_store import DailyStore
from subledger.session import scratch_path, scratch_table
from subledger.sources.readers import read_export
from subledger.sources.tables import write_report_bundle
from workload import inputs
from workload.inputs import (
    CONTACTS_SQL,
    DAYS,
    DAYS_SQL,
    FACTS_SQL,
    MONTHS,
    MONTHS_SQL,
    SCHEDULE_SQL,
)
from workload.registry import query

LATEST = """latest AS (
  SELECT d, sub_name, max(sub_version) AS sub_version FROM z JOIN {spine} ON term_start <= d AND sub_created <= d
  GROUP BY d, sub_name)"""
AMEND_OK = """(amend_type IS NULL OR (amend_type = 'UpdateProduct' AND amend_eff IS NOT NULL)
     OR (amend_type = 'NewProduct' AND amend_eff <= d) OR (amend_type = 'RemoveProduct' AND amend_eff > d))"""
ACTIVE = (
    LATEST
    + f""", active AS (
  SELECT d, z.* FROM z JOIN latest USING (sub_name, sub_version)
  WHERE term_start <= d AND (cancelled IS NULL OR cancelled > d) AND {AMEND_OK})"""
)
DISC_OK = """(amend_type IS NULL OR NOT ((amend_type = 'RemoveProduct' AND amend_eff <= d)
     OR (amend_type = 'NewProduct' AND amend_eff > d) OR term_start > d))"""
DISC_OK_KEEP = """(amend_type IS NULL OR NOT (coalesce(amend_type = 'RemoveProduct' AND amend_eff <= d, false)
     OR coalesce(amend_type = 'NewProduct' AND amend_eff > d, false) OR coalesce(term_start > d, false)))"""
NOT_GONE = """NOT EXISTS (SELECT 1 FROM z g WHERE g.sub_name = z.sub_name AND g.rp_created < d AND g.cancelled < d)"""
ACTIVE_MONTHS = f"WITH {FACTS_SQL}, {ACTIVE.format(spine=MONTHS_SQL)}"


def _date(column: str = "d") -> str:
    return f"strftime({column}, '%Y-%m-%d')"


@query(
    "active_snapshot",
    ACTIVE_MONTHS
    + f""" SELECT {_date()} AS report_date, account_id, sub_name, sub_version, rp_id, product_name, rp_name,
  CAST(mrr AS DOUBLE) AS mrr, CAST(tcv AS DOUBLE) AS tcv FROM active""",
    ints=("sub_version",),
)
def active_snapshot(spark, sf_dir):
    # Plain types per fact, not per fact and month.
    plain = {name: F.col(name).cast("double") for name in ("mrr", "tcv")}
    rows = daily.active_snapshot(inputs.facts(spark, sf_dir).withColumns(plain), MONTHS, text_dates=True)
    return rows.select(
        "report_date", "account_id", "sub_name", "sub_version", "rp_id", "product_name", "rp_name", "mrr", "tcv"
    )


ACTIVE_DAILY = """SELECT strftime(d, '%Y-%m-%d') AS report_date, product_name, rp_name, count(*) AS total_active,
  CAST(sum(mrr) AS DOUBLE) AS mrr_active, CAST(sum(tcv) AS DOUBLE) AS tcv_active
  FROM active GROUP BY d, product_name, rp_name"""


@query("active_daily", f"WITH {FACTS_SQL}, {ACTIVE.format(spine=DAYS_SQL)} {ACTIVE_DAILY}")
def active_daily(spark, sf_dir):
    return daily.active_daily(inputs.facts(spark, sf_dir), DAYS)


# Branches a to d of the rule for new rows. The dates a branch can hit are
# found by equality, the rest of its conditions are as stated per date.
NEW_ROWS = f"""new_rows AS (
  SELECT d, 0 AS chg, z.* FROM z JOIN {DAYS_SQL} ON rp_created = d WHERE term_start <= d AND sub_version = 1
  UNION ALL
  SELECT d, 0, z.* FROM z JOIN {DAYS_SQL} ON term_start = d WHERE rp_created < d AND sub_version = 1
    AND {NOT_GONE}
  UNION ALL
  SELECT d, 1, z.* FROM z JOIN {DAYS_SQL} ON rp_created = d WHERE amend_type = 'NewProduct' AND amend_eff <= d
    AND amend_sub_id = prev_id
  UNION ALL
  SELECT d, 1, z.* FROM z JOIN {DAYS_SQL} ON amend_eff = d WHERE amend_type = 'NewProduct' AND rp_created < d
    AND amend_sub_id = prev_id AND {NOT_GONE})"""
NEW_DAILY = f"""SELECT {_date()} AS report_date, product_name, rp_name, count(*) AS "new",
  CAST(sum(chg) AS BIGINT) AS new_changed, CAST(coalesce(sum(mrr), 0) AS DOUBLE) AS mrr_new,
  CAST(coalesce(sum(tcv), 0) AS DOUBLE) AS tcv_new FROM new_rows GROUP BY d, product_name, rp_name"""


@query("new_daily", f"WITH {FACTS_SQL}, {NEW_ROWS} {NEW_DAILY}")
def new_daily(spark, sf_dir):
    return daily.new_daily(inputs.facts(spark, sf_dir), DAYS)


CANCELLED_ROWS = f"""cancelled_rows AS (
  SELECT d, 1 AS chg, z.* FROM z JOIN {DAYS_SQL} ON rp_created = d WHERE amend_type = 'RemoveProduct'
    AND amend_eff <= d AND amend_sub_id = prev_id
  UNION ALL
  SELECT d, 1, z.* FROM z JOIN {DAYS_SQL} ON amend_eff = d WHERE amend_type = 'RemoveProduct' AND rp_created < d
    AND amend_sub_id = prev_id AND {NOT_GONE}
  UNION ALL
  SELECT d, 0, z.* FROM z JOIN {DAYS_SQL} ON rp_created = d WHERE cancelled <= d AND {DISC_OK}
  UNION ALL
  SELECT d, 0, z.* FROM z JOIN {DAYS_SQL} ON cancelled = d WHERE rp_created < d AND {DISC_OK})"""
CANCELLED_DAILY = f"""SELECT {_date()} AS report_date, product_name, rp_name, count(*) AS cancelled,
  CAST(sum(chg) AS BIGINT) AS cancelled_changed, CAST(sum(mrr) AS DOUBLE) AS mrr_cancelled,
  CAST(sum(tcv) AS DOUBLE) AS tcv_cancelled FROM cancelled_rows GROUP BY d, product_name, rp_name"""


@query("cancelled_daily", f"WITH {FACTS_SQL}, {CANCELLED_ROWS} {CANCELLED_DAILY}")
def cancelled_daily(spark, sf_dir):
    return daily.cancelled_daily(inputs.facts(spark, sf_dir), DAYS)


DAILY_REPORT = f"""WITH {FACTS_SQL}, {ACTIVE.format(spine=DAYS_SQL)}, {NEW_ROWS}, {CANCELLED_ROWS},
  a AS ({ACTIVE_DAILY}), n AS ({NEW_DAILY}), c AS ({CANCELLED_DAILY})
  SELECT * FROM a FULL JOIN n USING (report_date, product_name, rp_name)
  FULL JOIN c USING (report_date, product_name, rp_name)"""


@query("daily_report", DAILY_REPORT)
def daily_report(spark, sf_dir):
    return daily.daily_report(inputs.facts(spark, sf_dir), DAYS)


FACT_KEY = ("sub_name", "sub_id", "rp_id", "plan_id", "supp_key", "ship_date", "tcv", "quantity", "display_name")


@query("daily_report_incremental", DAILY_REPORT)
def daily_report_incremental(spark, sf_dir):
    """The report kept up to date by three batches: old terms, some of them wrong;
    new terms, of which some are late; corrections and late rows."""
    z = inputs.facts(spark, sf_dir)
    order = F.substr("sub_id", F.lit(2)).cast("bigint")
    old, wrong, late = F.year("term_start") < 1999, order % 10 == 0, order % 7 == 3
    mistaken = z.withColumns(
        {
            "mrr": F.when(wrong, F.lit(5)).otherwise(F.col("mrr")).cast("decimal(18,2)"),
            "cancelled": F.when(wrong, F.date_add("term_start", 40)).otherwise(F.col("cancelled")),
            "amend_type": F.when(~wrong, F.col("amend_type")),
            "sub_version": F.when(wrong, 9).otherwise(F.col("sub_version")),
        }
    )
    names = (scratch_table(spark, name) for name in ("facts", "steps", "totals"))
    store = DailyStore(*names, FACT_KEY, DAYS.start, buckets=16)
    for batch in (mistaken.where(old & ~late), z.where(~old & ~late), z.where(late | (old & wrong))):
        store.load(batch)
    return store.report(spark, DAYS.end)


DISCONNECT_COLUMNS = ["report_date", "account_id", "sub_name", "sub_id", "rp_id", "product_name", "rp_name", "mrr"]
DISCONNECT_SELECT = f"""SELECT {_date()} AS report_date, account_id, sub_name, sub_id, rp_id, product_name, rp_name,
  CAST(mrr AS DOUBLE) AS mrr"""
EXCLUDED = "product_name <> 'PROMO' AND product_name NOT LIKE '%ECON%'"


def disconnect_sql(ok: str, keep: str = "true") -> str:
    return f"""gone AS (
  SELECT d, z.* FROM z JOIN {DAYS_SQL} ON rp_created = d WHERE cancelled <= d AND {keep} AND {ok}
  UNION ALL
  SELECT d, z.* FROM z JOIN {DAYS_SQL} ON cancelled = d WHERE rp_created < d AND {keep} AND {ok})"""


@query("disconnects_sql", f"WITH {FACTS_SQL}, {disconnect_sql(DISC_OK, EXCLUDED)} {DISCONNECT_SELECT} FROM gone")
def disconnects_sql(spark, sf_dir):
    rows = disconnects.disconnect_rows(
        inputs.facts(spark, sf_dir), DAYS, exclude=["PROMO"], exclude_like=["%ECON%"]
    )
    return rows.select(DISCONNECT_COLUMNS)


@query("disconnects_pandas_nulls", f"WITH {FACTS_SQL}, {disconnect_sql(DISC_OK_KEEP)} {DISCONNECT_SELECT} FROM gone")
def disconnects_pandas_nulls(spark, sf_dir):
    rows = disconnects.disconnect_rows(inputs.facts(spark, sf_dir), DAYS, null_semantics="pandas")
    return rows.select(DISCONNECT_COLUMNS)


@query(
    "disconnects_created_only",
    f"""WITH {FACTS_SQL} {DISCONNECT_SELECT} FROM z JOIN {DAYS_SQL} ON rp_created = d WHERE {DISC_OK_KEEP}""",
)
def disconnects_created_only(spark, sf_dir):
    rows = disconnects.disconnect_rows(
        inputs.facts(spark, sf_dir), DAYS, null_semantics="pandas", created_only=True
    )
    return rows.select(DISCONNECT_COLUMNS)


WINDOW = (dt.date(1995, 1, 1), dt.date(2002, 12, 31))
CHURN_FIXED = f"""{ACTIVE_MONTHS}, {disconnect_sql(DISC_OK, EXCLUDED)},
kept AS (SELECT * FROM active WHERE {EXCLUDED}),
merged AS (
  SELECT k.d AS snapshot_date, k.account_id, k.sub_name, k.product_family, k.product_name, k.rp_name,
         g.d AS cancel_date
  FROM kept k LEFT JOIN gone g ON g.account_id = k.account_id AND g.sub_name = k.sub_name),
churned AS (
  SELECT * FROM merged m WHERE NOT EXISTS (
    SELECT 1 FROM merged o WHERE o.snapshot_date = m.snapshot_date AND o.account_id = m.account_id
      AND o.cancel_date IS NULL))"""
CHURN_MONTH = CHURN_FIXED.replace(
    "g.sub_name = k.sub_name", "g.sub_name = k.sub_name AND g.d BETWEEN k.d AND last_day(k.d)"
)
CHURN_ROWS = f"""SELECT {_date('snapshot_date')} AS snapshot_date, account_id, sub_name, product_family, product_name,
  rp_name, {_date('cancel_date')} AS cancel_date, count(*) AS row_count FROM churned GROUP BY ALL"""
CHURN_COUNTS = f"""SELECT {_date('cancel_date')} AS cancel_date, count(DISTINCT account_id) AS accounts_cancelled
  FROM churned GROUP BY cancel_date"""
PRODUCT_RULES = {"exclude": ["PROMO"], "exclude_like": ["%ECON%"]}


@query("churned_accounts", f"{CHURN_FIXED} {CHURN_ROWS}")
def churned_accounts(spark, sf_dir):
    return disconnects.churned_accounts(inputs.facts(spark, sf_dir), MONTHS, WINDOW, **PRODUCT_RULES)


@query("churned_accounts_month", f"{CHURN_MONTH} {CHURN_ROWS}")
def churned_accounts_month(spark, sf_dir):
    return disconnects.churned_accounts(inputs.facts(spark, sf_dir), MONTHS, **PRODUCT_RULES)


@query("accounts_cancelled_daily", f"{CHURN_FIXED} {CHURN_COUNTS}")
def accounts_cancelled_daily(spark, sf_dir):
    return disconnects.accounts_cancelled_daily(inputs.facts(spark, sf_dir), MONTHS, WINDOW, **PRODUCT_RULES)


@query("accounts_cancelled_month", f"{CHURN_MONTH} {CHURN_COUNTS}")
def accounts_cancelled_month(spark, sf_dir):
    return disconnects.accounts_cancelled_daily(inputs.facts(spark, sf_dir), MONTHS, **PRODUCT_RULES)


# An invoice item per line; some are billed on another day than creation.
ITEMS_SQL = """items AS (
  SELECT *, rp_created + CASE WHEN quantity < 10 THEN 1 ELSE 0 END AS item_created FROM z)"""
ADDS_SQL = f"""WITH {FACTS_SQL}, {ITEMS_SQL}, adds AS (
  SELECT rp_id,
    arg_min(sub_name, (sub_id, plan_id, ship_date, tcv, quantity, supp_key)) AS sub_name,
    arg_min(sub_id, (sub_id, plan_id, ship_date, tcv, quantity, supp_key)) AS sub_id,
    arg_min(product_name, (sub_id, plan_id, ship_date, tcv, quantity, supp_key)) AS product_name,
    arg_min(product_family, (sub_id, plan_id, ship_date, tcv, quantity, supp_key)) AS product_family,
    arg_min(rp_name, (sub_id, plan_id, ship_date, tcv, quantity, supp_key)) AS rp_name,
    arg_min(sub_status, (sub_id, plan_id, ship_date, tcv, quantity, supp_key)) AS sub_status,
    arg_min(term_type, (sub_id, plan_id, ship_date, tcv, quantity, supp_key)) AS term_type,
    arg_min(renewal_term, (sub_id, plan_id, ship_date, tcv, quantity, supp_key)) FILTER (renewal_term IS NOT NULL) AS renewal_term,
    min(rp_created) AS report_date, coalesce(sum(mrr), 0) AS mrr, coalesce(sum(tcv), 0) AS tcv,
    coalesce(sum(tcv), 0) AS total_adds_revenue
  FROM items WHERE rp_created >= DATE '1995-01-01' AND currency = 'USD' AND sub_version = 1
    AND item_created = rp_created AND display_name NOT LIKE 'qa-%'
  GROUP BY rp_id)"""


def _adds(spark, sf_dir):
    z = inputs.facts(spark, sf_dir)
    later = F.when(F.col("quantity") < 10, 1).otherwise(0)
    items = z.withColumn("item_created", F.date_add(F.to_date("rp_created"), later)).withColumn(
        "charge_amount", F.col("tcv")
    )
    return revenue.adds_extract(
        items,
        "1995-01-01",
        order=["sub_id", "plan_id", "ship_date", "tcv", "quantity", "supp_key"],
        test_names={"display_name": ["qa-%"]},
        never_null=[*inputs.KNOWN, "item_created"],
    )


@query(
    "adds_by_rate_plan",
    ADDS_SQL
    + f""" SELECT rp_id, sub_name, sub_id, product_name, product_family, rp_name, sub_status, term_type,
  CAST(renewal_term AS BIGINT) AS renewal_term, {_date('report_date')} AS report_date, CAST(mrr AS DOUBLE) AS mrr,
  CAST(tcv AS DOUBLE) AS tcv, CAST(total_adds_revenue AS DOUBLE) AS total_adds_revenue FROM adds""",
)
def adds_by_rate_plan(spark, sf_dir):
    return _adds(spark, sf_dir).select(
        "rp_id", "sub_name", "sub_id", "product_name", "product_family", "rp_name", "sub_status", "term_type",
        "renewal_term", "report_date", "mrr", "tcv", "total_adds_revenue",
    )


@query(
    "adds_without_regroup",
    f"""WITH {FACTS_SQL}, {ITEMS_SQL} SELECT rp_id, sub_name, product_name, CAST(tcv AS DOUBLE) AS tcv,
  {_date('rp_created')} AS rp_created FROM items
  WHERE rp_created >= DATE '1995-01-01' AND currency = 'USD' AND sub_version = 1 AND item_created = rp_created
    AND display_name NOT LIKE 'qa-%'""",
)
def adds_without_regroup(spark, sf_dir):
    z = inputs.facts(spark, sf_dir)
    later = F.when(F.col("quantity") < 10, 1).otherwise(0)
    items = z.withColumn("item_created", F.date_add(F.to_date("rp_created"), later))
    rows = revenue.adds_rows(items, "1995-01-01", test_names={"display_name": ["qa-%"]})
    return rows.select("rp_id", "sub_name", "product_name", "tcv", F.to_date("rp_created").alias("rp_created"))


def _pivot_sql(source: str, column: str, cells: dict[str, str], other: bool = True) -> str:
    """Every row counts in the total, and in a cell of its own or the other one."""
    counted = [f"nullif(count(*) FILTER ({column} = {value}), 0) AS \"{label}\"" for label, value in cells.items()]
    if other:
        counted.append(f"nullif(count(*) FILTER ({column} NOT IN ({', '.join(cells.values())})), 0) AS other")
    return f"""SELECT {_date('report_date')} AS report_date, {", ".join(counted)}, count(*) AS grand_total
  FROM {source} WHERE report_date IS NOT NULL AND {column} IS NOT NULL GROUP BY report_date"""


# Usual terms; the sample holds terms from 1 to 7, so some are named and some are not.
TERMS = [1, 2, 3, 12, 24, 36]
TERM_CELLS = {"EVERGREEN": "'EVERGREEN'", "TERMED": "'TERMED'"}
RENEWAL_CELLS = {f"term_{t}": str(t) for t in TERMS}
STATUS_CELLS = {s: f"'{s}'" for s in ("Active", "Cancelled")}


@query("pivot_term_type", f"{ADDS_SQL} {_pivot_sql('adds', 'term_type', TERM_CELLS)}")
def pivot_term_type(spark, sf_dir):
    return pivots.pivot_term_type(_adds(spark, sf_dir))


@query("pivot_renewal_term", f"{ADDS_SQL} {_pivot_sql('adds', 'coalesce(renewal_term, 1)', RENEWAL_CELLS)}")
def pivot_renewal_term(spark, sf_dir):
    return pivots.pivot_renewal_term(_adds(spark, sf_dir), TERMS)


@query("pivot_status", f"{ADDS_SQL} {_pivot_sql('adds', 'sub_status', STATUS_CELLS, other=False)}")
def pivot_status(spark, sf_dir):
    """A column for each status that occurs."""
    return pivots.pivot_status(_adds(spark, sf_dir))


@query(
    "pivot_total_row",
    f"""{ADDS_SQL}, p AS ({_pivot_sql('adds', 'term_type', TERM_CELLS)})
  SELECT * FROM p UNION ALL SELECT 'Total', CAST(sum("EVERGREEN") AS BIGINT), CAST(sum("TERMED") AS BIGINT),
  CAST(sum(other) AS BIGINT), CAST(sum(grand_total) AS BIGINT) FROM p""",
)
def pivot_total_row(spark, sf_dir):
    return with_total_row(pivots.pivot_term_type(_adds(spark, sf_dir)), "report_date")


@query(
    "pivot_long_totals",
    f"""{ADDS_SQL}, p AS (SELECT report_date, rp_name, grouping(report_date) = 1 AS all_report_date,
    grouping(rp_name) = 1 AS all_rp_name, count(*) AS row_count
    FROM adds WHERE report_date IS NOT NULL AND rp_name IS NOT NULL GROUP BY CUBE (report_date, rp_name))
  SELECT {_date('report_date')} AS report_date, rp_name, all_report_date, all_rp_name, row_count FROM p""",
)
def pivot_long_totals(spark, sf_dir):
    """Each pair of day and rate plan, however many plans there are, and all totals."""
    return pivots.plan_counts(_adds(spark, sf_dir))


@query(
    "product_counts",
    f"""{ADDS_SQL} SELECT {_date('report_date')} AS report_date, product_name, count(sub_id) AS subscription_count
  FROM adds GROUP BY ALL""",
)
def product_counts(spark, sf_dir):
    return pivots.product_counts(_adds(spark, sf_dir))


@query(
    "family_counts",
    f"""{ADDS_SQL} SELECT {_date('report_date')} AS report_date, product_name, product_family,
  count(product_name) AS product_count FROM adds GROUP BY ALL""",
)
def family_counts(spark, sf_dir):
    return pivots.family_counts(_adds(spark, sf_dir))


@query(
    "product_revenue",
    f"""{ADDS_SQL} SELECT {_date('report_date')} AS report_date, product_name,
  CAST(sum(total_adds_revenue) AS DOUBLE) AS total_adds_revenue FROM adds GROUP BY ALL""",
)
def product_revenue(spark, sf_dir):
    return pivots.product_revenue(_adds(spark, sf_dir))


@query(
    "daily_revenue",
    f"""{ADDS_SQL} SELECT {_date('report_date')} AS report_date, count(sub_id) AS subscription_count,
  CAST(sum(total_adds_revenue) AS DOUBLE) AS total_adds_revenue FROM adds GROUP BY ALL""",
)
def daily_revenue(spark, sf_dir):
    return pivots.daily_revenue(_adds(spark, sf_dir))


@query(
    "disconnect_pivot_status",
    f"""WITH {FACTS_SQL}, {disconnect_sql(DISC_OK_KEEP)}, g AS (SELECT d AS report_date, * FROM gone)
  {_pivot_sql('g', 'sub_status', {"Cancelled": "'Cancelled'"})}""",
)
def disconnect_pivot_status(spark, sf_dir):
    rows = disconnects.disconnect_rows(inputs.facts(spark, sf_dir), DAYS, null_semantics="pandas")
    return pivots.disconnect_pivots(rows, TERMS, ["Cancelled"])["statuses"]


@query(
    "disconnect_pivot_renewal_term",
    f"""WITH {FACTS_SQL}, {disconnect_sql(DISC_OK_KEEP)}, g AS (SELECT d AS report_date, * FROM gone)
  {_pivot_sql('g', 'coalesce(renewal_term, 1)', RENEWAL_CELLS)}""",
)
def disconnect_pivot_renewal_term(spark, sf_dir):
    rows = disconnects.disconnect_rows(inputs.facts(spark, sf_dir), DAYS, null_semantics="pandas")
    return pivots.disconnect_pivots(rows, TERMS)["renewal_terms"]


SHEETS_SQL = f"""SELECT report_date, "EVERGREEN", "TERMED", term_types.other AS other_types, {", ".join(f'"{c}"' for c in RENEWAL_CELLS)},
  renewal_terms.other AS other_terms, renewal_terms.grand_total AS rows"""


@query(
    "report_bundle",
    f"""{ADDS_SQL}, term_types AS ({_pivot_sql('adds', 'term_type', TERM_CELLS)}),
  renewal_terms AS ({_pivot_sql('adds', 'coalesce(renewal_term, 1)', RENEWAL_CELLS)}),
  revenue AS (SELECT {_date('report_date')} AS report_date, CAST(sum(total_adds_revenue) AS DOUBLE) AS total_adds_revenue FROM adds GROUP BY ALL)
  {SHEETS_SQL}, total_adds_revenue FROM term_types JOIN renewal_terms USING (report_date) JOIN revenue USING (report_date)""",
)
def report_bundle(spark, sf_dir):
    """The adds extract and its pivots written as one bundle, and three sheets read back."""
    path = scratch_path(spark, "adds")
    write_report_bundle(_adds(spark, sf_dir), lambda adds: pivots.adds_pivots(adds, TERMS), path)
    return _sheets(spark, path).join(
        read_export(spark, f"{path}/daily_revenue", "report_date date, subscription_count bigint, total_adds_revenue decimal(28,2)"),
        "report_date",
    ).drop("subscription_count")


def _sheets(spark, path):
    """The sheets of term types and of renewal terms, whose columns of the same name are told apart."""
    types = read_export(spark, f"{path}/term_types", f"report_date date, EVERGREEN bigint, TERMED bigint, {OTHER} bigint")
    kinds = ", ".join(f"{c} bigint" for c in [*RENEWAL_CELLS, OTHER, pivots.GRAND_TOTAL])
    terms = read_export(spark, f"{path}/renewal_terms", f"report_date date, {kinds}")
    terms = terms.withColumnsRenamed({OTHER: "other_terms", pivots.GRAND_TOTAL: "rows"})
    return types.withColumnRenamed(OTHER, "other_types").join(terms, "report_date")


@query(
    "disconnect_bundle",
    f"""WITH {FACTS_SQL}, {disconnect_sql(DISC_OK_KEEP)}, g AS (SELECT d AS report_date, * FROM gone),
  term_types AS ({_pivot_sql('g', 'term_type', TERM_CELLS)}),
  renewal_terms AS ({_pivot_sql('g', 'coalesce(renewal_term, 1)', RENEWAL_CELLS)})
  {SHEETS_SQL} FROM term_types JOIN renewal_terms USING (report_date)""",
)
def disconnect_bundle(spark, sf_dir):
    rows = disconnects.disconnect_rows(inputs.facts(spark, sf_dir), DAYS, null_semantics="pandas")
    path = scratch_path(spark, "disconnects")
    write_report_bundle(rows, lambda stored: pivots.disconnect_pivots(stored, TERMS), path)
    return _sheets(spark, path)


BY_PLAN_ORDER = ["rp_created", "sub_id", "plan_id", "ship_date", "tcv", "quantity", "supp_key"]


def _by_plan_sql(test: str) -> str:
    order = "(" + ", ".join(BY_PLAN_ORDER) + ")"
    return f"""WITH {FACTS_SQL} SELECT rp_id, arg_min(sub_name, {order}) AS sub_name,
  arg_min(product_name, {order}) AS product_name,
  CAST(arg_min(renewal_term, {order}) FILTER (renewal_term IS NOT NULL) AS BIGINT) AS renewal_term,
  {_date(f"arg_min(cancelled, {order}) FILTER (cancelled IS NOT NULL)")} AS cancelled,
  CAST(coalesce(sum(mrr), 0) AS DOUBLE) AS mrr, CAST(coalesce(sum(tcv), 0) AS DOUBLE) AS tcv,
  {_date('min(rp_created)')} AS report_date FROM z WHERE {test} GROUP BY rp_id"""


BY_PLAN_COLUMNS = ["rp_id", "sub_name", "product_name", "renewal_term", "cancelled", "mrr", "tcv", "report_date"]


@query(
    "disconnect_extract",
    _by_plan_sql(
        """(rp_created >= DATE '1998-01-01' AND cancelled <= DATE '1998-06-30')
     OR (rp_created < DATE '1998-01-01' AND cancelled >= DATE '1998-01-01')"""
    ),
)
def disconnect_extract(spark, sf_dir):
    rows = disconnects.disconnect_extract(
        inputs.facts(spark, sf_dir), "1998-01-01", "1998-06-30", order=BY_PLAN_ORDER, never_null=inputs.KNOWN
    )
    return rows.select(BY_PLAN_COLUMNS)


@query(
    "cancel_customer_details",
    _by_plan_sql("amend_created >= DATE '1997-04-01' AND amend_created <= DATE '1998-04-30'"),
)
def cancel_customer_details(spark, sf_dir):
    rows = disconnects.cancel_details(
        inputs.facts(spark, sf_dir), "amend_created", "1997-04-01", "1998-04-30",
        order=BY_PLAN_ORDER, never_null=inputs.KNOWN,
    )
    return rows.select(BY_PLAN_COLUMNS)


@query(
    "revenue_to_date",
    f"""WITH {SCHEDULE_SQL}, days AS (SELECT d, (SELECT name FROM periods WHERE d >= start_date AND d <= end_date) AS period
    FROM {DAYS_SQL}),
  sums AS (SELECT accounting_period, revenue_date, product_name, region, currency, sum(revenue_amount) AS amount
    FROM schedule GROUP BY ALL)
  SELECT {_date()} AS report_date, product_name, region, currency, CAST(sum(amount) AS DOUBLE) AS revenue_amount
  FROM days JOIN sums ON accounting_period = period AND revenue_date <= d GROUP BY d, product_name, region, currency""",
)
def revenue_to_date(spark, sf_dir):
    return revenue.revenue_to_date(inputs.schedule(spark, sf_dir), inputs.periods(spark, sf_dir), DAYS)


@query(
    "customer_demographics",
    f"""{ACTIVE_MONTHS}, {CONTACTS_SQL}
  SELECT {_date()} AS report_date, country, coalesce(state, '***') AS state, count(DISTINCT account_id) AS account_count,
  count(DISTINCT sub_name) AS subscription_count, count(*) AS product_count
  FROM active JOIN (SELECT DISTINCT account_id, country, state, city FROM contacts) c USING (account_id)
  WHERE country IS NOT NULL GROUP BY ALL""",
)
def customer_demographics(spark, sf_dir):
    return customers.customer_demographics(inputs.facts(spark, sf_dir), inputs.contacts(spark, sf_dir), MONTHS)


@query(
    "demographics_rollup",
    f"""{ACTIVE_MONTHS}, {CONTACTS_SQL},
  held AS (SELECT d, account_id, sub_name, country, coalesce(state, '***') AS state, city FROM active JOIN contacts USING (account_id)
    WHERE country IS NOT NULL)
  SELECT {_date()} AS report_date, CAST(CASE WHEN GROUPING(country) = 1 THEN 3 WHEN GROUPING(state) = 1 THEN 2
    WHEN GROUPING(city) = 1 THEN 1 ELSE 0 END AS BIGINT) AS level, country, state, city,
    count(DISTINCT account_id) AS account_count, count(DISTINCT sub_name) AS subscription_count
  FROM held GROUP BY d, ROLLUP (country, state, city)""",
)
def demographics_rollup(spark, sf_dir):
    return customers.demographics_rollup(inputs.facts(spark, sf_dir), inputs.contacts(spark, sf_dir), MONTHS)


@query(
    "demographics_rows",
    f"""{ACTIVE_MONTHS}, {CONTACTS_SQL}
  SELECT {_date()} AS report_date, account_id, sub_name, rp_id, product_name, country, state, city
  FROM active JOIN (SELECT DISTINCT account_id, country, state, city FROM contacts) c USING (account_id)""",
)
def demographics_rows(spark, sf_dir):
    rows = customers.demographics_rows(
        inputs.facts(spark, sf_dir), inputs.contacts(spark, sf_dir), MONTHS, text_dates=True
    )
    return rows.select(
        "report_date", "account_id", "sub_name", "rp_id", "product_name", "country", "state", "city"
    )


@query(
    "active_products",
    f"""WITH {FACTS_SQL}, on_day AS (SELECT DATE '1999-01-01' AS d),
  rows AS (SELECT z.* FROM z, on_day WHERE term_start <= d AND sub_created <= d AND charged_through >= d AND currency = 'USD'
    AND (cancelled IS NULL OR cancelled > d) AND {AMEND_OK}
    AND NOT EXISTS (SELECT 1 FROM z o WHERE o.sub_name = z.sub_name AND o.sub_status = 'Cancelled' AND o.cancelled < d))
  SELECT rp_name, product_family, plan_id, arg_min(product_name, (rp_created, sub_id, rp_id)) AS product_name,
  count(*) AS product_count, count(DISTINCT sub_name) AS subscription_count, '1999-01-01' AS report_date
  FROM rows GROUP BY rp_name, product_family, plan_id""",
)
def active_products(spark, sf_dir):
    z = inputs.facts(spark, sf_dir)
    cancelled = z.where(F.col("sub_status") == "Cancelled")
    return customers.active_products(z, cancelled, "1999-01-01", order=["rp_created", "sub_id", "rp_id"])


@query(
    "arr_forecast",
    f"""WITH {FACTS_SQL} SELECT DISTINCT account_id, sub_name, rp_id, rp_name, product_name, term_type,
  CAST(renewal_term AS BIGINT) AS renewal_term, {_date('charged_through')} AS charged_through, CAST(mrr AS DOUBLE) AS mrr,
  CAST(tcv AS DOUBLE) AS tcv, CAST(CASE WHEN term_type = 'EVERGREEN' THEN mrr ELSE 0 END AS DOUBLE) AS evergreen_arr,
  CAST(CASE WHEN term_type = 'TERMED' THEN mrr * renewal_term ELSE 0 END AS DOUBLE) AS termed_arr
  FROM z WHERE charged_through BETWEEN DATE '1998-06-01' AND DATE '1998-12-31' AND sub_status = 'Active'
    AND currency = 'USD'""",
)
def arr_forecast(spark, sf_dir):
    kept = [
        "account_id", "sub_name", "rp_id", "rp_name", "product_name", "term_type", "renewal_term", "charged_through",
        "mrr", "tcv", "sub_status", "currency",
    ]
    rows = revenue.arr_forecast(inputs.facts(spark, sf_dir).select(kept), "1998-06-01", "1998-12-31")
    return rows.drop("sub_status", "currency")
