"""Extracts of rows whose attributes are missing."""

import datetime

from subledger.plans import extracts


def test_subscription_fact_keeps_charges_without_attributes(spark):
    day = datetime.date(2024, 1, 2)
    charges = spark.createDataFrame(
        [("a", None, "x", day, "USD", 1, 1, 2), ("a", "s", "x", day, "USD", 1, 10, 20), ("b", None, None, day, "USD", 1, 5, 6)],
        "rp_id string, sub_name string, product_name string, rp_created date, currency string, sub_version int, mrr int, tcv int",
    )
    items = spark.createDataFrame([("a", 7)], "rp_id string, charge_amount int")
    rows = extracts.subscription_fact(charges, items, "2024-01-01", ["sub_name", "product_name", "rp_created"])
    got = {tuple(r) for r in rows.select("rp_id", "sub_name", "product_name", "mrr", "tcv", "total_adds_revenue").collect()}
    assert got == {("a", "s", "x", 11, 22, 7), ("b", None, None, 5, 6, None)}
