"""Row rules of the document flatteners on literal documents."""

import json

from subledger.operators import flatten


def carts(spark, *documents):
    rows = [(i, "2024-01-02", d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "id int, created_at string, cart string")


def rows(df):
    return [r.asDict() for r in df.collect()]


KEEP = ("id", "created_at")


def plan(name, **more):
    return {"ratePlanId": name, "productId": "P" + name, "type": "base", "family": "F", **more}


def charge(name, **price):
    return {"id": name, "name": "n" + name, "priceDetails": price, "billingPeriod": "12"}


def sub(**fields):
    return {"id": "s", "meta": {"domain": "a.shop.com", "prOrderable": "false"}, **fields}


def new(spark, *documents, **more):
    return rows(flatten.flatten_carts_new(carts(spark, *documents), keep=KEEP, **more))


def test_new_one_row_per_charge_plan_removal_and_existing(spark):
    cart = {
        "id": "c1",
        "meta": {"flow": "web"},
        "user": {"userId": "u1"},
        "subscriptions": [
            sub(
                addRatePlans=[
                    plan("a", charges={"onetime": [charge("o", price="1.5")], "recurring": [charge("r", price="abc")]})
                ],
                removeRatePlans=[plan("x")],
                existingRatePlans=[plan("e", ratePlanStatus="live")],
            )
        ],
    }
    got = new(spark, cart)
    assert len(got) == 4
    once, again, removed, kept = got
    assert once["onetime_id"] == "o" and once["onetime_price"] == 1.5 and once["recurring_id"] is None
    assert again["recurring_id"] == "r" and again["recurring_price"] is None and again["recurring_billingperiod"] == 12
    assert removed["removeRatePlans_rate_plan_id"] == "x" and removed["addRatePlans_rate_plan_id"] is None
    assert kept["existingRatePlans_ratePlanStatus"] == "live"
    assert {r["domain_extension"] for r in got} == {".com"}
    assert {(r["cart_type"], r["meta_flow"], r["user_id"]) for r in got} == {("", "web", "u1")}


def test_new_keeps_missing_type_and_drops_the_three(spark):
    body = {"subscriptions": [sub(removeRatePlans=[plan("x")])]}
    kinds = [{}, {"type": "buy"}, {"type": "change"}, {"type": "reactivate"}, {"type": "update"}]
    got = new(spark, *[{**body, **k} for k in kinds])
    assert sorted(r["id"] for r in got) == [0, 1]


def test_new_plans_without_charges(spark):
    def cart(**charges):
        return {"subscriptions": [sub(addRatePlans=[plan("a", **charges)])]}

    got = new(
        spark,
        cart(),
        cart(charges={}),
        cart(charges=None),
        cart(charges={"onetime": [], "recurring": []}),
        cart(charges={"onetime": [], "recurring": [charge("r")]}),
    )
    assert [r["id"] for r in got] == [0, 1, 2, 4]
    assert [r["recurring_id"] for r in got] == [None, None, None, "r"]
    assert all(r["addRatePlans_rate_plan_id"] == "a" for r in got)


def test_new_documents_without_rows(spark):
    assert new(spark, {}, {"subscriptions": "none"}, {"subscriptions": []}, {"subscriptions": [sub()]}) == []
    assert new(spark, "no json", {"subscriptions": [sub(addRatePlans="x", removeRatePlans=[])]}) == []


def test_new_meta_that_is_no_object_and_empty_domain(spark):
    got = new(
        spark,
        {"meta": "x", "user": [1], "subscriptions": [sub(meta="text", removeRatePlans=[plan("x")])]},
        {"subscriptions": [sub(meta={"domain": ""}, removeRatePlans=[plan("x")])]},
        {"subscriptions": [sub(meta={"domain": "host"}, removeRatePlans=[plan("x")])]},
    )
    assert [(r["domain"], r["domain_extension"], r["meta_flow"], r["user_id"]) for r in got] == [
        ("", "", "", ""),
        ("", "", "", ""),
        ("host", ".host", "", ""),
    ]


def test_change_keeps_the_last_plan_and_leaks_nothing(spark):
    first = sub(addRatePlans=[plan("a1"), plan("a2")], removeRatePlans=[plan("x")], existingRatePlans=[plan("e")])
    second = sub(addRatePlans=[plan("b")], removeRatePlans=[])
    documents = carts(spark, {"type": "change", "subscriptions": [first, second]}, {"subscriptions": [first]})
    got = rows(flatten.flatten_carts_change(documents, keep=KEEP))
    assert [r["addRatePlans_rate_plan_id"] for r in got] == ["a2", "b"]
    assert [r["removeRatePlans_rate_plan_id"] for r in got] == ["x", None]
    assert [r["existingRatePlans_rate_plan_id"] for r in got] == ["e", None]
    assert [r["existingRatePlans_ratePlanStatus"] for r in got] == ["", None]


def test_reactivate_rows(spark):
    documents = carts(
        spark,
        {"type": "reactivate", "promo": "p", "subscriptions": [sub(addRatePlans=[plan("a")])]},
        {"type": "reactivate", "subscriptions": [sub()]},
        {"type": "reactivate", "id": "bare"},
        {"type": "buy", "subscriptions": [sub(addRatePlans=[plan("a")])]},
    )
    got = rows(flatten.flatten_carts_reactivate(documents, keep=KEEP))
    assert [(r["id"], r["cart_id"], r["rate_plan_id"]) for r in got] == [(0, "", "a"), (2, "bare", None)]
    assert got[0]["promo"] == "p" and got[0]["prOrderable"] is False and got[0]["subscription_domain"] == "s"
    assert got[1]["subscription_domain"] is None and got[1]["action"] is None
    kept = flatten.flatten_carts_reactivate(documents, keep=KEEP, bare_carts=False, bare_subscriptions=True)
    assert [(r["id"], r["subscription_domain"]) for r in rows(kept)] == [(0, "s"), (1, "s")]


def test_all_takes_every_type(spark):
    documents = carts(
        spark,
        {"type": "update", "subscriptions": [sub(addRatePlans=[plan("a", charges={"onetime": [charge("o")]})])]},
        {"subscriptions": [sub()]},
        {},
    )
    got = rows(flatten.flatten_carts_all(documents, keep=KEEP))
    assert [(r["id"], r["rate_plan_id"], r["onetime_id"]) for r in got] == [(0, "a", "o"), (1, None, None)]


def test_refund_items(spark):
    items = [{"subscriptionId": "item", "chargeAmount": 2.5, "quantity": "x"}, {"chargeName": "c"}]
    df = spark.createDataFrame(
        [(1, "parent", json.dumps(items), "2024-01-02 10:00:00"), (2, "parent", "[]", "2024-01-02 10:00:00")],
        "id int, subscription_id string, invoice_items string, created_at string",
    )
    got = rows(flatten.flatten_refund_items(df))
    assert [(r["id"], r["subscription_id"], r["charge_amount"]) for r in got] == [(1, "item", 2.5), (1, None, None)]
    assert got[0]["quantity"] is None and str(got[0]["created_date"]) == "2024-01-02"


def test_extract_json(spark):
    df = spark.createDataFrame(
        [(1, '{"a": 5, "p": {"unitPrice": "2.50"}}'), (2, None), (3, "{}"), (4, "{broken")], "id int, meta string"
    )
    got = flatten.extract_json(df, "meta", {"a": ("a", "int"), "price": ("p.unitPrice", "double")})
    assert got.columns == ["id", "a", "price"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [
        (1, 5, 2.5),
        (2, None, None),
        (3, None, None),
        (4, None, None),
    ]


def test_flatten_struct_names_and_drops(spark):
    df = spark.createDataFrame(
        [(("x",), 1, (2, ("z",)), [1])],
        "attributes struct<t string>, Id int, Owner struct<Id int, Role struct<Name string>>, Tags array<int>",
    )
    assert flatten.flatten_struct(df).columns == ["Id", "Owner.Id", "Owner.Role.Name", "Tags"]


def test_bad_carts_name_every_level(spark):
    good = {"subscriptions": [sub(addRatePlans=[plan("a", charges={"onetime": [charge("o")], "usage": 5})])]}
    documents = carts(
        spark,
        good,
        {"meta": "x", "subscriptions": ["none", 5, sub(meta=[1], removeRatePlans="x")]},
        {"subscriptions": [sub(addRatePlans=["p", plan("b", charges="c"), plan("c", charges={"onetime": ["q", {"priceDetails": 1}]})])]},
        {"subscriptions": [sub(addRatePlans=[plan("d", charges={"recurring": 7})], existingRatePlans=[None])]},
        "{broken",
        '{"id": 1, "id": 2}',
        "[1]",
    )
    got = sorted((r["id"], r["level"]) for r in rows(flatten.bad_carts(documents, keep=("id",))))
    assert got == [
        (1, "document"), (1, "subscription"), (1, "subscription"), (1, "subscription"),
        (2, "charge"), (2, "charge"), (2, "plan"), (2, "plan"), (3, "plan"), (3, "plan"),
        (4, "document"), (5, "document"), (6, "document"),
    ]
    empty = spark.createDataFrame([(1, None)], "id int, cart string")
    assert rows(flatten.bad_carts(empty, keep=("id",))) == []


def test_each_document_is_parsed_once(spark, capsys):
    flatten.flatten_carts_new(carts(spark, {}), keep=KEEP).explain("formatted")
    assert capsys.readouterr().out.count("parseJson(") == 1


def test_bad_json(spark):
    df = spark.createDataFrame([(1, '{"a": 5}'), (2, None), (3, "[]"), (4, "{broken"), (5, "")], "id int, meta string")
    assert sorted(r["id"] for r in rows(flatten.bad_json(df, "meta", ["id"]))) == [3, 4, 5]
