"""Shape of the plans: what reaches the scan, what is joined how."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from workload import inputs

QUERIES = contract.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["active_daily", "new_daily", "cancelled_daily", "daily_report", "disconnects_sql", "churned_accounts",
     "accounts_cancelled_month", "customer_demographics", "revenue_to_date", "period_lookup", "not_in_values",
     "upsert_all", "upsert_partial", "star_extract"],
)
def test_no_product_joins_and_no_python(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEvalPython"):
        assert bad not in text


def test_filters_reach_the_scan(spark, data):
    text = plan(QUERIES["payments"](spark, data))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


def test_scan_reads_needed_columns_only(spark, data):
    text = plan(QUERIES["having_filter"](spark, data))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_documents_are_parsed_once(spark, data):
    """One parse of a document's text; all else is taken out of its variant."""
    for name in ("flatten_carts_new", "flatten_carts_change", "flatten_refund_items", "bad_carts", "extract_meta"):
        text = plan(QUERIES[name](spark, data))
        assert text.count("parseJson(") == 1 and "from_json(" not in text


def test_deduplication_cuts_keys_before_the_shuffle(spark, data):
    text = plan(QUERIES["dedupe_last"](spark, data))
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")


def test_churn_shares_its_aggregations(spark, data):
    df = QUERIES["churned_accounts"](spark, data)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Latest versions, active rows and disconnects read the facts once each.
    assert final.count("FileScan parquet [o_orderkey") <= 3
    assert "ReusedExchange" in final


def test_small_updates_do_not_shuffle_the_target(spark):
    from subledger.operators.merge import upsert

    target = spark.range(1000).selectExpr("id", "id * 2 as v")
    batch = spark.createDataFrame([(1, 5)], "id bigint, v bigint")
    df = upsert(target, batch, ["id"])
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final


@pytest.mark.parametrize("name", ["flatten_carts_new", "flatten_carts_change", "flatten_carts_reactivate", "flatten_carts_all"])
def test_rows_of_carts_are_listed_before_one_explode(spark, data, name):
    assert plan(QUERIES[name](spark, data)).count("Generate ") == 1


def test_bad_carts_take_each_list_out_once(spark, data):
    text = plan(QUERIES["bad_carts"](spark, data))
    assert text.count("$.subscriptions, ArrayType(VariantType") == 1
    assert text.count("$.addRatePlans, ArrayType(VariantType") == 1


@pytest.mark.parametrize("made", [inputs.carts, inputs.refunds])
def test_documents_are_dealt_over_many_tasks(spark, data, made):
    used = made(spark, data).select(F.spark_partition_id()).distinct().count()
    assert used >= 4 * spark.sparkContext.defaultParallelism


def test_dates_of_results_are_cast_to_text(spark, data):
    assert "date_format" not in plan(QUERIES["active_snapshot"](spark, data))
    kinds = spark.sql("SELECT DATE '1995-01-09' AS d, CAST(NULL AS DATE) AS n, TIMESTAMP '1995-01-09 00:00:01' AS t")
    assert tuple(inputs.present(kinds).head()) == ("1995-01-09", None, "1995-01-09 00:00:01")


def test_plain_types_are_made_before_dates_are_written_out(spark, data):
    text = plan(QUERIES["active_snapshot"](spark, data))
    per_row = text[: text.index("Generate ")]
    assert "as string)" not in per_row and "as double)" not in per_row
    assert "INTERVAL" not in text


def test_date_of_eligibility_is_worked_out_once(spark, data):
    text = plan(QUERIES["active_snapshot"](spark, data))
    (line,) = [line for line in text.splitlines() if "Project" in line and "AS _from" in line]
    assert "greatest" not in line


def test_hundredths_are_rounded_as_before(spark, data):
    values = [0.005, 0.015, 0.025, 1.005, 2.675, 0.0049999999999999996, 900.1, 104949.99, 0.07, 1e12 + 0.125, 0.125, 0.375, 0.0]
    values += [v / 7 for v in range(2000)] + [v / 800 for v in range(2000)]
    values = [(v,) for v in values + [-v for v in values]] + [(None,)]
    df = spark.createDataFrame(values, "v double")
    rounded = F.round(F.col("v") * 100).cast("bigint")
    assert df.where(~inputs.hundredths("v").eqNullSafe(rounded)).count() == 0
    assert "round" not in plan(inputs.facts(spark, data).select("mrr")).lower()
