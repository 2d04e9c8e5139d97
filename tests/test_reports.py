"""Reports against their rules evaluated date by date in plain Python."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subledger import Spine
from subledger.operators.snapshot import latest_version_on, version_ranges
from subledger.plans import customers, daily, disconnects, revenue

DAY0 = dt.date(2024, 1, 1)
SPINE = Spine(DAY0, DAY0 + dt.timedelta(days=59))
MONTHS = Spine(DAY0, DAY0 + dt.timedelta(days=120), "month")
SCHEMA = (
    "account_id string, sub_name string, sub_id string, sub_version int, sub_status string, term_type string, "
    "renewal_term int, term_start date, sub_created timestamp, cancelled date, rp_id string, rp_name string, "
    "rp_created timestamp, product_name string, product_family string, amend_type string, amend_eff date, "
    "amend_sub_id string, prev_id string, mrr decimal(18,2), tcv decimal(18,2)"
)
NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def make_rows(seed, n=400, hot=0.35):
    """Random rows; one subscription of one account holds a third of them."""
    rnd = random.Random(seed)

    def day(null=0.0):
        return None if rnd.random() < null else DAY0 + dt.timedelta(days=rnd.randint(-20, 70))

    def stamp(date):
        return None if date is None else dt.datetime.combine(date, dt.time(rnd.randint(0, 23), 5))

    out = []
    for i in range(n):
        s = 0 if rnd.random() < hot else rnd.randint(1, 30)
        out.append(
            (
                f"A{s % 7}", f"S{s}", f"I{i}", rnd.randint(1, 6), "Active", rnd.choice(["TERMED", "EVERGREEN"]),
                rnd.choice([None, 1, 12]), day(0.03), stamp(day(0.03)), day(0.5), f"R{i % 150}",
                rnd.choice(["basic", "plus", None]), stamp(day(0.03)), rnd.choice(["Mail", "Shop", "Shop India"]),
                rnd.choice(["f1", "f2"]), rnd.choice([None, "NewProduct", "RemoveProduct", "UpdateProduct", "Terms"]),
                day(0.25), rnd.choice(["p", "q", None]), rnd.choice(["p", "q", None]),
                rnd.choice([None, Decimal("1.10"), Decimal("2.25")]), Decimal(rnd.randint(0, 500)) / 4,
            )
        )
    return out


class Row:
    def __init__(self, values):
        self.__dict__.update(zip(NAMES, values))
        self.created = self.sub_created.date() if self.sub_created else None
        self.rpc = self.rp_created.date() if self.rp_created else None


def lt(a, b):
    return None if a is None or b is None else a < b


def le(a, b):
    return None if a is None or b is None else a <= b


def all3(*tests):
    if any(t is False for t in tests):
        return False
    return None if any(t is None for t in tests) else True


def any3(*tests):
    if any(t is True for t in tests):
        return True
    return None if any(t is None for t in tests) else False


def not3(t):
    return None if t is None else not t


def equals(a, b):
    return None if a is None or b is None else a == b


def active_on(rows, d):
    top = {}
    for r in rows:
        if le(r.term_start, d) and le(r.created, d):
            top[r.sub_name] = max(top.get(r.sub_name, 0), r.sub_version)
    for r in rows:
        amended = any3(
            r.amend_type is None,
            all3(equals(r.amend_type, "UpdateProduct"), r.amend_eff is not None),
            all3(equals(r.amend_type, "NewProduct"), le(r.amend_eff, d)),
            all3(equals(r.amend_type, "RemoveProduct"), lt(d, r.amend_eff)),
        )
        kept = r.cancelled is None or r.cancelled > d
        if top.get(r.sub_name) == r.sub_version and le(r.term_start, d) and kept and amended:
            yield r


def disconnect(r, d, pandas=False):
    known = (lambda t: bool(t)) if pandas else (lambda t: t)
    return any3(
        r.amend_type is None,
        not3(
            any3(
                all3(known(equals(r.amend_type, "RemoveProduct")), known(le(r.amend_eff, d))),
                all3(known(equals(r.amend_type, "NewProduct")), known(lt(d, r.amend_eff))),
                known(lt(d, r.term_start)),
            )
        ),
    )


def gone_on(rows, d, pandas=False):
    for r in rows:
        same = all3(equals(r.rpc, d), le(r.cancelled, d))
        later = all3(lt(r.rpc, d), equals(r.cancelled, d))
        if (same or later) and disconnect(r, d, pandas):
            yield r


def ended_before(rows, d):
    return {r.sub_name for r in rows if lt(r.rpc, d) and lt(r.cancelled, d)}


@pytest.fixture(scope="module", params=[1, 2])
def sample(request, spark):
    raw = make_rows(request.param)
    df = spark.createDataFrame(raw, SCHEMA).repartition(5).persist()
    yield df, [Row(v) for v in raw]
    df.unpersist()


def dates(spine):
    return [r[0] for r in _frames[spine]]


_frames = {}


@pytest.fixture(scope="module", autouse=True)
def frames(spark):
    for spine in (SPINE, MONTHS):
        _frames[spine] = spine.frame(spark).collect()


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


@pytest.mark.parametrize("spine", [SPINE, MONTHS])
def test_active_snapshot(sample, spine):
    df, rows = sample
    got = Counter((r.report_date, r.sub_id) for r in daily.active_snapshot(df, spine).collect())
    assert got == Counter((d, r.sub_id) for d in dates(spine) for r in active_on(rows, d))


def test_version_ranges_have_one_latest_per_date(sample):
    df, rows = sample
    ranges = version_ranges(df, SPINE).collect()
    for d in dates(SPINE):
        top = {}
        for r in rows:
            if le(r.term_start, d) and le(r.created, d):
                top[r.sub_name] = max(top.get(r.sub_name, 0), r.sub_version)
        got = {r.sub_name: r.sub_version for r in ranges if r["_from"] <= d and (r["_to"] is None or d < r["_to"])}
        assert got == top


def test_latest_version_on(sample):
    df, rows = sample
    d = DAY0 + dt.timedelta(days=10)
    top = {}
    for r in rows:
        if le(r.term_start, d) and le(r.created, d):
            top[r.sub_name] = max(top.get(r.sub_name, 0), r.sub_version)
    expected = Counter(r.sub_id for r in rows if top.get(r.sub_name) == r.sub_version)
    assert Counter(r.sub_id for r in latest_version_on(df, d).collect()) == expected


@pytest.mark.parametrize("spine", [SPINE, MONTHS])
def test_active_daily(sample, spine):
    df, rows = sample
    groups = defaultdict(list)
    for d in dates(spine):
        for r in active_on(rows, d):
            groups[d, r.product_name, r.rp_name].append(r)
    expected = {k: (len(g), total(r.mrr for r in g), total(r.tcv for r in g)) for k, g in groups.items()}
    got = daily.active_daily(df, spine).collect()
    assert {(r.report_date, r.product_name, r.rp_name): (r.total_active, r.mrr_active, r.tcv_active) for r in got} == expected
    assert len(got) == len(expected)


def new_entries(rows):
    for d in dates(SPINE):
        ended = ended_before(rows, d)
        for r in rows:
            first, amended = r.sub_version == 1, all3(equals(r.amend_type, "NewProduct"), equals(r.amend_sub_id, r.prev_id))
            if all3(equals(r.rpc, d), le(r.term_start, d), first):
                yield d, 0, r
            if all3(lt(r.rpc, d), equals(r.term_start, d), first, r.sub_name not in ended):
                yield d, 0, r
            if all3(amended, equals(r.rpc, d), le(r.amend_eff, d)):
                yield d, 1, r
            if all3(amended, lt(r.rpc, d), equals(r.amend_eff, d), r.sub_name not in ended):
                yield d, 1, r


def cancelled_entries(rows):
    for d in dates(SPINE):
        ended = ended_before(rows, d)
        for r in rows:
            amended = all3(equals(r.amend_type, "RemoveProduct"), equals(r.amend_sub_id, r.prev_id))
            if all3(amended, equals(r.rpc, d), le(r.amend_eff, d)):
                yield d, 1, r
            if all3(amended, lt(r.rpc, d), equals(r.amend_eff, d), r.sub_name not in ended):
                yield d, 1, r
        for r in gone_on(rows, d):
            yield d, 0, r


def grouped(entries, zero):
    groups = defaultdict(list)
    for d, changed, r in entries:
        groups[d, r.product_name, r.rp_name].append((changed, r))
    out = {}
    for k, g in groups.items():
        mrr, tcv = total(r.mrr for _, r in g), total(r.tcv for _, r in g)
        out[k] = (len(g), sum(c for c, _ in g), (mrr or 0) if zero else mrr, (tcv or 0) if zero else tcv)
    return out


def test_new_daily(sample):
    df, rows = sample
    got = daily.new_daily(df, SPINE).collect()
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == grouped(new_entries(rows), zero=True)


def test_cancelled_daily(sample):
    df, rows = sample
    got = daily.cancelled_daily(df, SPINE).collect()
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == grouped(cancelled_entries(rows), zero=False)


def test_daily_report_has_the_parts(sample):
    df, _ = sample
    whole = daily.daily_report(df, SPINE).persist()
    for part, label in (
        (daily.active_daily(df, SPINE), "total_active"),
        (daily.new_daily(df, SPINE), "new"),
        (daily.cancelled_daily(df, SPINE), "cancelled"),
    ):
        inside = whole.where(f"`{label}` is not null").select(part.columns)
        assert inside.exceptAll(part).isEmpty() and part.exceptAll(inside).isEmpty()
    keys = ["report_date", "product_name", "rp_name"]
    assert whole.count() == whole.select(keys).distinct().count()
    whole.unpersist()


@pytest.mark.parametrize("mode", ["sql", "pandas"])
def test_disconnect_rows(sample, mode):
    df, rows = sample
    got = disconnects.disconnect_rows(df, SPINE, null_semantics=mode).collect()
    expected = Counter((d, r.sub_id) for d in dates(SPINE) for r in gone_on(rows, d, mode == "pandas"))
    assert Counter((r.report_date, r.sub_id) for r in got) == expected


def test_null_semantics_differ(sample):
    df, _ = sample
    sql, pandas = (disconnects.disconnect_rows(df, SPINE, null_semantics=m).count() for m in ("sql", "pandas"))
    assert sql < pandas


@pytest.mark.parametrize("window", [None, (DAY0, DAY0 + dt.timedelta(days=59))])
@pytest.mark.parametrize("spine", [MONTHS, Spine(DAY0 + dt.timedelta(days=10), DAY0 + dt.timedelta(days=13))])
def test_churn(sample, spark, window, spine):
    df, rows = sample
    expected, churned = defaultdict(set), Counter()
    kept = [r for r in rows if "India" not in r.product_name]
    for (d,) in spine.frame(spark).collect():
        active = [r for r in active_on(rows, d) if "India" not in r.product_name]
        last = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        first, last = window or (d, last)
        span = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        ends = [(c, r) for c in span for r in gone_on(kept, c)]
        by_sub = defaultdict(list)
        for c, r in ends:
            by_sub[r.account_id, r.sub_name].append(c)
        for account in {r.account_id for r in active}:
            mine = [r for r in active if r.account_id == account]
            if all((account, r.sub_name) in by_sub for r in mine):
                for r in mine:
                    for c in by_sub[account, r.sub_name]:
                        expected[c].add(account)
                        churned[d, account, r.sub_name, r.product_family, r.product_name, r.rp_name, c] += 1
    rules = {"exclude_like": ["%India%"]}
    got = disconnects.accounts_cancelled_daily(df, spine, window, **rules).collect()
    assert {r.cancel_date: r.accounts_cancelled for r in got} == {c: len(a) for c, a in expected.items()}
    found = disconnects.churned_accounts(df, spine, window, **rules).collect()
    assert Counter({tuple(r[:-1]): r.row_count for r in found}) == churned


def test_churn_of_a_subscription_with_a_third_of_the_rows(spark):
    """Pairs are written after the rows are dealt by rate plan, and only distinct ones."""
    n, names = 30_000, 200
    text = ["account_id", "sub_name", "sub_id", "sub_status", "term_type", "rp_id", "amend_sub_id", "prev_id"]
    hot = F.col("id") % 3 == 0
    sub = F.when(hot, "S0").otherwise(F.concat(F.lit("S"), (F.col("id") % 5000 + 1).cast("string")))
    facts = spark.range(n).select(
        *(F.lit("x").alias(c) for c in text if c != "sub_name" and c != "account_id"),
        sub.alias("sub_name"), F.concat(F.lit("A"), sub).alias("account_id"), F.lit(1).alias("sub_version"),
        F.lit(1).alias("renewal_term"), F.lit(DAY0 - dt.timedelta(days=9)).alias("term_start"),
        F.lit(dt.datetime(2023, 12, 1)).alias("sub_created"), F.lit(dt.datetime(2023, 12, 1)).alias("rp_created"),
        F.date_add(F.lit(DAY0), (F.col("id") % 59).cast("int")).alias("cancelled"),
        (F.col("id") % names).cast("string").alias("product_name"), F.lit("f").alias("product_family"),
        F.lit("r").alias("rp_name"), F.lit(None).cast("string").alias("amend_type"),
        F.lit(None).cast("date").alias("amend_eff"),
    )
    spine, window = Spine(DAY0, DAY0 + dt.timedelta(days=5)), (DAY0, DAY0 + dt.timedelta(days=58))
    df = disconnects.churned_accounts(facts, spine, window)
    got = Counter((r.snapshot_date, r.row_count) for r in df.where("sub_name = 'S0'").collect())
    rows = [(i % 59, i % names) for i in range(0, n, 3)]
    days = Counter(day for day, _ in rows)
    expected = Counter()
    for d in range(6):
        for active in Counter(name for day, name in rows if day > d).values():
            expected.update((DAY0 + dt.timedelta(days=d), active * ended) for ended in days.values())
    assert got == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode(_days") < plan.index("Exchange hashpartitioning(account_id") < plan.index("collect_list")


def test_demographics(sample, spark):
    df, rows = sample
    places = [("A0", "X", None, "c"), ("A0", "X", "s", "c"), ("A0", "X", "s", "d"), ("A0", "X", "s", "d"),
              ("A1", "X", "s", "c"), ("A2", None, "s", "c"), ("A3", "Y", "s", "c"), ("A9", "Y", "s", "c")]
    contacts = spark.createDataFrame(places, "account_id string, country string, state string, city string")
    groups = defaultdict(list)
    for d in dates(MONTHS):
        for r in active_on(rows, d):
            for account, country, state, _ in set(places):
                if account == r.account_id and country is not None:
                    groups[d, country, state or "***"].append(r)
    expected = {k: (len({r.account_id for r in g}), len({r.sub_name for r in g}), len(g)) for k, g in groups.items()}
    got = customers.customer_demographics(df, contacts, MONTHS).collect()
    assert {(r.report_date, r.country, r.state): (r.account_count, r.subscription_count, r.product_count) for r in got} == expected


def test_demographics_counts_a_subscription_of_two_accounts_once(spark):
    raw = [list(make_rows(5, 1)[0]) for _ in range(2)]
    for i, r in enumerate(raw):
        r[NAMES.index("account_id")] = f"B{i}"
        r[NAMES.index("term_start")] = DAY0
        r[NAMES.index("sub_created")] = dt.datetime(2024, 1, 1)
        r[NAMES.index("cancelled")] = None
        r[NAMES.index("amend_type")] = None
    contacts = spark.createDataFrame([(f"B{i}", "X", "s", "c") for i in range(2)], "account_id string, country string, state string, city string")
    (row,) = customers.customer_demographics(
        spark.createDataFrame([tuple(r) for r in raw], SCHEMA), contacts, Spine(DAY0, DAY0)
    ).collect()
    assert (row.account_count, row.subscription_count, row.product_count) == (2, 1, 2)


def test_demographics_rollup(sample, spark):
    df, rows = sample
    places = [("A0", "X", None, "c"), ("A0", "X", "s", "c"), ("A0", "X", "s", None), ("A0", "X", "s", None),
              ("A1", "X", "s", "c"), ("A2", None, "s", "c"), ("A3", "Y", "s", "c"), ("A9", "Y", "s", "c")]
    # Subscriptions of two accounts, next to those of one.
    rows = rows + [Row([f"A{i}", *r[1:]]) for i in (0, 1) for r in make_rows(8, 40)]
    twice = [(f"A{i}", *r[1:]) for i in (0, 1) for r in make_rows(8, 40)]
    contacts = spark.createDataFrame(places, "account_id string, country string, state string, city string")
    groups = defaultdict(list)
    for d in dates(MONTHS):
        for r in active_on(rows, d):
            for account, country, state, city in set(places):
                if account == r.account_id and country is not None:
                    state = state or "***"
                    for level, place in enumerate([(country, state, city), (country, state, None), (country, None, None), (None, None, None)]):
                        groups[d, level, *place].append(r)
    expected = {k: (len({r.account_id for r in g}), len({r.sub_name for r in g})) for k, g in groups.items()}
    facts = df.unionByName(spark.createDataFrame(twice, SCHEMA))
    got = customers.demographics_rollup(facts, contacts, MONTHS)
    assert {tuple(r)[:5]: tuple(r)[5:] for r in got.collect()} == expected
    # Dates are written out before the places multiply them, but for shared subscriptions.
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined, dated = (next(i for i, line in enumerate(plan) if x in line) for x in ("Join Inner, (account_id", "Generate explode([0,1,2"))
    assert joined < dated


def test_demographics_rows_meet_addresses_as_ranges(sample, spark):
    df, rows = sample
    places = [("A0", "X", None, "c"), ("A0", "X", "s", "c"), ("A0", "X", "s", "c"), ("A1", None, None, None)]
    contacts = spark.createDataFrame(places, "account_id string, country string, state string, city string")
    got = customers.demographics_rows(df, contacts, MONTHS)
    columns = ["report_date", "account_id", "sub_name", "sub_id", "country", "state", "city"]
    expected = Counter(
        (d, r.account_id, r.sub_name, r.sub_id, *p[1:])
        for d in dates(MONTHS) for r in active_on(rows, d) for p in set(places) if p[0] == r.account_id
    )
    assert Counter(tuple(r) for r in got.select(columns).collect()) == expected
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    dated, joined = (next(i for i, line in enumerate(plan) if x in line) for x in ("Generate explode", "Join Inner, (account_id"))
    assert dated < joined


def test_demographics_rows_of_one_account_are_written_by_several_tasks(sample, spark):
    df, rows = sample
    one = df.withColumn("account_id", F.lit("A"))
    places = [("A", "X", "s", None), ("A", None, None, "c"), ("A", "X", "s", None), (None, "X", "s", "c")]
    contacts = spark.createDataFrame(places, "account_id string, country string, state string, city string")
    got = customers.demographics_rows(one.unionByName(df.withColumn("account_id", F.lit(None).cast("string"))), contacts, MONTHS, text_dates=True)
    columns = ["report_date", "account_id", "sub_name", "sub_id", "country", "state", "city"]
    expected = Counter(
        (str(d), "A", r.sub_name, r.sub_id, *p[1:]) for d in dates(MONTHS) for r in active_on(rows, d) for p in set(places) if p[0] == "A"
    )
    found = got.select(*columns, F.spark_partition_id()).collect()
    assert Counter(tuple(r)[:-1] for r in found) == expected
    assert len({r[-1] for r in found}) > 1


SCHEDULE = "accounting_period string, revenue_date date, product_name string, region string, currency string, revenue_amount decimal(18,2)"
PERIODS = "name string, start_date date, end_date date"


def test_revenue_to_date(spark):
    rnd = random.Random(3)
    periods = [("p1", DAY0, DAY0 + dt.timedelta(days=9)), ("p2", DAY0 + dt.timedelta(days=12), DAY0 + dt.timedelta(days=30))]
    rows = [
        (rnd.choice(["p1", "p2", "p3", None]), DAY0 + dt.timedelta(days=rnd.randint(-5, 40)), rnd.choice("ab"), None, "USD",
         rnd.choice([None, Decimal("1.25")]))
        for _ in range(200)
    ]
    got = revenue.revenue_to_date(
        spark.createDataFrame(rows, SCHEDULE), spark.createDataFrame(periods, PERIODS), SPINE
    ).collect()
    expected = {}
    for d in dates(SPINE):
        inside = [name for name, a, b in periods if a <= d <= b]
        for p in "ab":
            amounts = [r[5] for r in rows if inside and r[0] == inside[0] and r[1] <= d and r[2] == p]
            if amounts:
                expected[d, p, None, "USD"] = sum(x or 0 for x in amounts)
    assert {tuple(r[:4]): r.revenue_amount for r in got} == expected


def test_revenue_date_in_two_periods_raises(spark):
    periods = [("p1", DAY0, DAY0 + dt.timedelta(days=9)), ("p2", DAY0 + dt.timedelta(days=9), DAY0 + dt.timedelta(days=30))]
    rows = [("p1", DAY0, "a", "r", "USD", Decimal(1))]
    df = revenue.revenue_to_date(spark.createDataFrame(rows, SCHEDULE), spark.createDataFrame(periods, PERIODS), SPINE)
    with pytest.raises(Exception, match="more than one period"):
        df.collect()


def test_amendment_rules_on_the_boundary(spark):
    d = DAY0 + dt.timedelta(days=5)

    def row(kind, eff):
        r = dict.fromkeys(NAMES)
        r.update(account_id="A", sub_name=f"{kind}{eff}", sub_id=f"{kind}/{eff}", sub_version=1, term_start=DAY0,
                 sub_created=dt.datetime(2024, 1, 1), rp_created=dt.datetime(2024, 1, 1), product_name="p",
                 amend_type=kind, amend_eff=eff, cancelled=None)
        return r

    one = dt.timedelta(days=1)
    cases = [row("NewProduct", d), row("NewProduct", d + one), row("RemoveProduct", d), row("RemoveProduct", d + one),
             row("UpdateProduct", None), row("UpdateProduct", d + one), row("Terms", d), row(None, None)]
    df = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in cases], SCHEMA)
    got = {r.sub_id for r in daily.active_snapshot(df, Spine(d, d)).collect()}
    assert got == {cases[i]["sub_id"] for i in (0, 3, 5, 7)}
    cancelled = [dict(r, cancelled=d) for r in [row("RemoveProduct", None), row("NewProduct", d), row("NewProduct", d + one)]]
    df = spark.createDataFrame([tuple(r[n] for n in NAMES) for r in cancelled], SCHEMA)
    sql, pandas = (
        {r.sub_id for r in disconnects.disconnect_rows(df, Spine(d, d), null_semantics=m).collect()} for m in ("sql", "pandas")
    )
    assert sql == {cancelled[1]["sub_id"]} and pandas == {cancelled[0]["sub_id"], cancelled[1]["sub_id"]}


def test_arr_forecast(spark):
    rows = [("EVERGREEN", None, 10.0), ("TERMED", 12, 10.0), ("TERMED", None, 10.0), ("TERMED", 12, 10.0), (None, 1, 3.0)]
    df = spark.createDataFrame(
        [(t, n, m, dt.date(2024, 6, 1), "Active", "USD") for t, n, m in rows],
        "term_type string, renewal_term int, mrr double, charged_through date, sub_status string, currency string",
    )
    got = revenue.arr_forecast(df, "2024-06-01", "2024-12-31").collect()
    assert sorted(((r.evergreen_arr, r.termed_arr) for r in got), key=str) == sorted(
        [(10.0, 0.0), (0.0, 120.0), (0.0, None), (0.0, 0.0)], key=str
    )
