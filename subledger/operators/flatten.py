"""Nested documents to flat rows: carts, refund items, metadata, records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subledger.functions.predicates import type_in, type_not_in
from subledger.functions.scalars import blank_if_null, domain_extension, to_flag, to_number

_PRICE = "struct<currency:string,actualPrice:string,price:string,discountAmount:string,"\
    "discountPercentage:string,discountPeriod:string,model:string>"
_CHARGE = "struct<id:string,name:string,chargeId:string,billingId:string,chargeModel:string,type:string,"\
    f"billingPeriod:string,priceDetails:{_PRICE}>"
_PLAN = "ratePlanId:string,productId:string,type:string,family:string"
_META = "domain:string,paymentToken:string,oacs:string,pvtreg:string,businessId:string,action:string,prOrderable:string"

# A document's text is parsed once, to a variant; everything else is taken out
# of that by path and type. What isn't of the type asked for is null, and takes
# nothing else with it. ``charges`` is a map, so that an empty object can be
# told from one whose charge lists are empty, and charges of other kinds don't
# matter.
_LISTED_PLAN = f"struct<{_PLAN},ratePlanStatus:string,charges:map<string,variant>>"
_SUBSCRIPTION = (
    "struct<id:string,baseProductId:string,subscriptionNumber:string,previousSubscriptionNumber:string,"
    f"meta:struct<{_META}>,addRatePlans:array<{_LISTED_PLAN}>,removeRatePlans:array<{_LISTED_PLAN}>,"
    f"existingRatePlans:array<{_LISTED_PLAN}>>"
)
CART_SCHEMA = (
    "struct<id:string,type:string,promo:string,meta:struct<flow:string,whois:struct<businessId:string>>,"
    "user:struct<userId:string>>"
)
_CHARGE_KINDS = ("onetime", "recurring")
# An object of any kind, and a list of anything, whose elements needn't be taken out.
_OBJECT, _LIST = "struct<_:string>", "array<struct<_:string>>"

# Fixed values of the cart type field.
CHANGE, REACTIVATE, UPDATE = "change", "reactivate", "update"

_ROW = f"struct<grain:string,plan:struct<{_PLAN},ratePlanStatus:string>,charge:{_CHARGE}>"


def _present(items: Column) -> Column:
    """Elements of the type asked for; the others were read as null."""
    return F.filter(items, lambda x: x.isNotNull())


def _plans(sub: Column, name: str) -> Column:
    return _present(sub[name])


def _charges(plan: Column, kind: str) -> Column:
    return _present(F.try_variant_get(plan["charges"][kind], "$", f"array<{_CHARGE}>"))


_SUBSCRIPTION_PARTS = ("id", "baseProductId", "subscriptionNumber", "previousSubscriptionNumber", "meta")


def _subscription_rows(df: DataFrame, column: str, keep: Sequence[str], rows, wanted=None, bare_carts: bool = False) -> DataFrame:
    """The rows that ``rows`` lists of each subscription of the wanted carts:
    ``keep``, ``_cart``, ``_s`` (the subscription's plain parts) and ``_r``.

    All rows of a document are listed before any is exploded, so its plans and
    charges, which are still variants, are never written out themselves. The
    type is tested inside the exploded value. As a filter Spark would move
    it, and the test for empty lists, in front of the parse and parse the text
    once more for each. Text that is no document, and list elements that are
    no subscriptions, give no row here but one of :func:`bad_carts`.
    """
    parsed = df.select(*keep, F.try_parse_json(F.col(column)).alias("_v"))
    carts = parsed.select(*keep, "_v", F.try_variant_get("_v", "$", CART_SCHEMA).alias("_cart"))
    listed = _present(F.try_variant_get("_v", "$.subscriptions", f"array<{_SUBSCRIPTION}>"))
    if bare_carts:
        given = F.try_variant_get("_v", "$.subscriptions", "variant")
        bare = F.col("_cart").isNotNull() & (given.isNull() | F.is_variant_null(given))
        listed = F.coalesce(listed, F.when(bare, F.array(F.lit(None).cast(_SUBSCRIPTION))))
    if wanted is not None:
        listed = F.when(wanted(F.col("_cart.type")), listed)

    def placed(sub: Column) -> Column:
        parts = F.when(sub.isNotNull(), F.struct(*(sub[p].alias(p) for p in _SUBSCRIPTION_PARTS)))
        return F.transform(rows(sub), lambda row: F.struct(parts.alias("_s"), row.alias("_r")))

    every = F.flatten(F.transform(listed, placed))
    found = carts.select(*keep, "_cart", F.explode_outer(every).alias("_x")).where(F.col("_x").isNotNull())
    return found.select(*keep, "_cart", "_x._s", "_x._r")


def _problem(level: str, text: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), text.cast("string").alias("text"))


def _no_problems() -> Column:
    return F.array().cast("array<struct<level:string,text:string>>")


def _is_object(value: Column) -> Column:
    return F.try_variant_get(value, "$", _OBJECT).isNotNull()


def _unfit(value: Column, path: str, kind: str) -> Column:
    """Whether something stands at a path that isn't of this kind.

    What fits is told by one look, and needs no other.
    """
    found = F.try_variant_get(value, path, "variant")
    return F.try_variant_get(value, path, kind).isNull() & found.isNotNull() & ~F.is_variant_null(found)


def _elements(value: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.array().cast("array<variant>"))


def _bad(value: Column, fields: Mapping[str, str]) -> Column:
    """Whether this is no object, or one with a field of another kind."""
    out = ~_is_object(value)
    for path, kind in fields.items():
        out = out | _unfit(value, path, kind)
    return out


def _unread_one(value: Column, level: str, fields: Mapping[str, str]) -> Column:
    return F.when(_bad(value, fields), F.array(_problem(level, value))).otherwise(_no_problems())


def _unread(values: Column, level: str, fields: Mapping[str, str]) -> Column:
    """Elements that are no objects, and objects with a field of another kind."""
    return F.transform(F.filter(values, lambda value: _bad(value, fields)), lambda v: _problem(level, v))


def _each_unread(values: Column, problems) -> Column:
    """All problems of all elements; each element is looked at once."""
    return F.coalesce(F.flatten(F.transform(values, problems)), _no_problems())


# Fields of a cart document and its parts that aren't plain values.
_CART_FIELDS = {"$.meta": _OBJECT, "$.meta.whois": _OBJECT, "$.user": _OBJECT, "$.subscriptions": _LIST}
_LISTS = ("addRatePlans", "removeRatePlans", "existingRatePlans")
_SUBSCRIPTION_FIELDS = {"$.meta": _OBJECT} | {f"$.{name}": _LIST for name in _LISTS}
_PLAN_KINDS = {"$.charges": _OBJECT} | {f"$.charges.{kind}": _LIST for kind in _CHARGE_KINDS}


def bad_carts(df: DataFrame, column: str = "cart", keep: Sequence[str] = ("id", "created_at", "modified_at")) -> DataFrame:
    """What can't be read of cart documents, a row each: ``level`` (document,
    subscription, plan or charge) and ``text``.

    Text that is no JSON object has one row and nothing below it; that includes
    an object that names a key twice. Elsewhere a row is an element that is no
    object, which has no rows in the flat tables, or an object of which some
    field has the wrong kind and is read as missing. Null text has no row.
    """
    carts = df.select(*keep, F.col(column).alias("_t"), F.try_parse_json(F.col(column)).alias("_v"))
    document = F.col("_v")

    def of_plan(plan: Column) -> Column:
        charges = (_unread(_elements(plan, f"$.charges.{kind}"), "charge", {"$.priceDetails": _OBJECT}) for kind in _CHARGE_KINDS)
        return F.concat(_unread_one(plan, "plan", _PLAN_KINDS), *charges)

    def of_subscription(sub: Column) -> Column:
        others = (_unread(_elements(sub, f"$.{name}"), "plan", {}) for name in _LISTS[1:])
        added = _each_unread(_elements(sub, f"$.{_LISTS[0]}"), of_plan)
        return F.concat(_unread_one(sub, "subscription", _SUBSCRIPTION_FIELDS), added, *others)

    inner = _each_unread(_elements(document, "$.subscriptions"), of_subscription)
    found = F.concat(_unread_one(document, "document", _CART_FIELDS), inner)
    whole = F.array(_problem("document", F.col("_t")))
    bad = F.when(_is_object(document), found).when(F.col("_t").isNotNull(), whole)
    return carts.select(*keep, F.explode(bad).alias("_p")).select(*keep, "_p.level", "_p.text")


def _plan(plan: Column, status: bool = False) -> Column:
    names = ("ratePlanId", "productId", "type", "family")
    fields = [blank_if_null(plan[n]).alias(n) for n in names]
    state = blank_if_null(plan["ratePlanStatus"]) if status else F.lit(None).cast("string")
    return F.struct(*fields, state.alias("ratePlanStatus"))


def _row(grain: str, plan: Column, charge: Column | None = None) -> Column:
    value = F.lit(None).cast(_CHARGE) if charge is None else charge
    return F.struct(F.lit(grain).alias("grain"), plan.alias("plan"), value.alias("charge")).cast(_ROW)


def _none() -> Column:
    return F.array().cast(f"array<{_ROW}>")


def _each(items: Column, to_row) -> Column:
    return F.coalesce(F.transform(items, to_row), _none())


def _charge_rows(add_plans: Column) -> Column:
    """A row per charge of each plan; one row for a plan without charges."""

    def rows(plan: Column) -> Column:
        charges = plan["charges"]
        listed = F.concat(
            _each(_charges(plan, "onetime"), lambda c: _row("onetime", _plan(plan), c)),
            _each(_charges(plan, "recurring"), lambda c: _row("recurring", _plan(plan), c)),
        )
        bare = charges.isNull() | (F.size(charges) == 0)
        return F.when(bare, F.array(_row("plan", _plan(plan)))).otherwise(listed)

    return F.coalesce(F.flatten(F.transform(add_plans, rows)), _none())


def _add_plan_columns(prefix: str, family: bool) -> list[Column]:
    added = F.col("_r.grain").isin("onetime", "recurring", "plan")
    names = [("ratePlanId", "rate_plan_id"), ("productId", "product_id"), ("type", "rateplan_type")]
    if family:
        names.append(("family", "family"))
    return [F.when(added, F.col(f"_r.plan.{n}")).alias(prefix + alias) for n, alias in names]


def _charge_columns(grain: str, fields: Sequence[tuple[str, str]]) -> list[Column]:
    here = F.col("_r.grain") == grain
    out = []
    for path, alias in fields:
        value = blank_if_null(F.col(f"_r.charge.{path}"))
        out.append(F.when(here, to_number(value) if path in _NUMBERS else value).alias(alias))
    return out


# Columns of the flat cart tables and the fields they hold.
_NUMBERS = {
    "priceDetails.actualPrice",
    "priceDetails.price",
    "priceDetails.discountAmount",
    "priceDetails.discountPercentage",
    "priceDetails.discountPeriod",
    "billingPeriod",
}
_ONETIME = [
    ("id", "onetime_id"),
    ("name", "onetime_charge_name"),
    ("chargeId", "onetime_chargeId"),
    ("billingId", "onetime_billingId"),
    ("chargeModel", "onetime_chargeModel"),
    ("type", "onetime_charge_type"),
    ("priceDetails.currency", "onetime_currency"),
    ("priceDetails.actualPrice", "onetime_actual_price"),
    ("priceDetails.price", "onetime_price"),
    ("priceDetails.model", "onetime_price_model"),
    ("priceDetails.discountAmount", "onetime_discountAmount"),
    ("priceDetails.discountPercentage", "onetime_discountPercentage"),
    ("priceDetails.discountPeriod", "onetime_discountPeriod"),
    ("billingPeriod", "onetime_billingperiod"),
]
_RECURRING = [
    ("id", "recurring_id"),
    ("name", "recurring_name"),
    ("billingId", "recurring_billingId"),
    ("chargeModel", "recurring_chargeModel"),
    ("chargeId", "recurring_charge_id"),
    ("type", "recurring_charge_type"),
    ("priceDetails.currency", "recurring_currency"),
    ("priceDetails.actualPrice", "recurring_actual_price"),
    ("priceDetails.price", "recurring_price"),
    ("priceDetails.model", "recurring_price_model"),
    ("priceDetails.discountAmount", "recurring_discountAmount"),
    ("priceDetails.discountPercentage", "recurring_discountPercentage"),
    ("priceDetails.discountPeriod", "recurring_discountPeriod"),
    ("billingPeriod", "recurring_billingperiod"),
]
_PLAN_FIELDS = [
    ("ratePlanId", "rate_plan_id"),
    ("productId", "product_id"),
    ("type", "rateplan_type"),
    ("family", "family"),
]


def _subscription_meta(*names: tuple[str, str]) -> list[Column]:
    return [blank_if_null(F.col(f"_s.meta.{n}")).alias(alias) for n, alias in names]


def flatten_carts_new(
    df: DataFrame,
    column: str = "cart",
    keep: Sequence[str] = ("id", "created_at", "modified_at"),
    business_id: bool = False,
) -> DataFrame:
    """Rows of carts that are no change, reactivation or update.

    One row per onetime and recurring charge, per added plan without charges,
    per removed plan and per existing plan. A plan whose charge lists are both
    empty, and a subscription without plans, give no row. Fields a document
    lacks are empty strings, fields of another kind of row are null.
    """

    def grains(sub: Column) -> Column:
        return F.concat(
            _charge_rows(_plans(sub, "addRatePlans")),
            _each(_plans(sub, "removeRatePlans"), lambda p: _row("remove", _plan(p))),
            _each(_plans(sub, "existingRatePlans"), lambda p: _row("existing", _plan(p, status=True))),
        )

    rows = _subscription_rows(df, column, keep, grains, lambda kind: type_not_in(kind, (CHANGE, REACTIVATE, UPDATE)))
    removed, existing = F.col("_r.grain") == "remove", F.col("_r.grain") == "existing"
    extra = [F.col("_cart.meta.whois.businessId").alias("business_id")] if business_id else []
    return rows.select(
        *keep,
        blank_if_null(F.col("_cart.type")).alias("cart_type"),
        blank_if_null(F.col("_cart.id")).alias("cart_id"),
        *extra,
        blank_if_null(F.col("_cart.meta.flow")).alias("meta_flow"),
        blank_if_null(F.col("_cart.user.userId")).alias("user_id"),
        blank_if_null(F.col("_s.id")).alias("subscription_id"),
        blank_if_null(F.col("_s.baseProductId")).alias("baseProductId"),
        blank_if_null(F.col("_s.subscriptionNumber")).alias("subscriptionNumber"),
        blank_if_null(F.col("_s.previousSubscriptionNumber")).alias("previousSubscriptionNumber"),
        *_subscription_meta(("paymentToken", "paymentToken"), ("oacs", "oacs"), ("domain", "domain")),
        domain_extension(F.col("_s.meta.domain")).alias("domain_extension"),
        *_subscription_meta(("pvtreg", "pvtreg"), ("businessId", "businessId"), ("action", "action")),
        *_add_plan_columns("addRatePlans_", family=True),
        *_charge_columns("onetime", _ONETIME),
        *_charge_columns("recurring", _RECURRING),
        *[F.when(removed, F.col(f"_r.plan.{n}")).alias(f"removeRatePlans_{a}") for n, a in _PLAN_FIELDS],
        *[F.when(existing, F.col(f"_r.plan.{n}")).alias(f"existingRatePlans_{a}") for n, a in _PLAN_FIELDS],
        F.when(existing, F.col("_r.plan.ratePlanStatus")).alias("existingRatePlans_ratePlanStatus"),
    )


def flatten_carts_change(
    df: DataFrame, column: str = "cart", keep: Sequence[str] = ("id", "created_at", "modified_at")
) -> DataFrame:
    """One row per subscription of the change carts, with the last added, the
    last removed and the last existing plan; null where a list is empty."""

    def plans(sub: Column) -> Column:
        lasts = (F.try_element_at(_plans(sub, x), F.lit(-1)) for x in _LISTS)
        return F.array(F.struct(*(F.when(p.isNotNull(), _plan(p, status=True)).alias(x) for p, x in zip(lasts, _LISTS, strict=True))))

    subs = _subscription_rows(df, column, keep, plans, lambda kind: type_in(kind, (CHANGE,)))

    def last(items: str, prefix: str, fields: Sequence[tuple[str, str]]) -> list[Column]:
        return [F.col(f"_r.{items}.{n}").alias(prefix + alias) for n, alias in fields]

    return subs.select(
        *keep,
        blank_if_null(F.col("_cart.type")).alias("cart_type"),
        blank_if_null(F.col("_cart.id")).alias("cart_id"),
        blank_if_null(F.col("_s.subscriptionNumber")).alias("subscriptionNumber"),
        blank_if_null(F.col("_s.previousSubscriptionNumber")).alias("previousSubscriptionNumber"),
        *_subscription_meta(("paymentToken", "paymentToken"), ("oacs", "oacs"), ("domain", "domain")),
        domain_extension(F.col("_s.meta.domain")).alias("domain_extension"),
        *_subscription_meta(("pvtreg", "pvtreg"), ("businessId", "businessId")),
        *last("addRatePlans", "addRatePlans_", _PLAN_FIELDS),
        *last("removeRatePlans", "removeRatePlans_", _PLAN_FIELDS),
        *last("existingRatePlans", "existingRatePlans_", [*_PLAN_FIELDS, ("ratePlanStatus", "ratePlanStatus")]),
    )


def flatten_carts_reactivate(
    df: DataFrame,
    column: str = "cart",
    keep: Sequence[str] = ("id", "created_at", "modified_at"),
    bare_carts: bool = True,
    bare_subscriptions: bool = False,
) -> DataFrame:
    """Rows of reactivation carts per charge, or per plan without charges.

    ``bare_carts`` keeps a cart that has no list of subscriptions as one row,
    ``bare_subscriptions`` a subscription without added plans.
    """
    grains = _plan_grains(bare_carts, bare_subscriptions)
    rows = _subscription_rows(df, column, keep, grains, lambda kind: type_in(kind, (REACTIVATE,)), bare_carts)
    known = F.col("_s").isNotNull()
    return rows.select(
        *keep,
        blank_if_null(F.col("_cart.type")).alias("cart_type"),
        blank_if_null(F.col("_cart.id")).alias("cart_id"),
        F.when(known, blank_if_null(F.col("_s.id"))).alias("subscription_domain"),
        F.when(known, blank_if_null(F.col("_s.baseProductId"))).alias("baseProductId"),
        F.when(known, blank_if_null(F.col("_s.meta.domain"))).alias("domain_name"),
        F.when(known, domain_extension(F.col("_s.meta.domain"))).alias("domain_extension"),
        F.when(known, blank_if_null(F.col("_s.meta.action"))).alias("action"),
        to_flag(F.col("_s.meta.prOrderable")).alias("prOrderable"),
        blank_if_null(F.col("_cart.promo")).alias("promo"),
        *_add_plan_columns("", family=False),
        *_charge_columns("onetime", _ONETIME),
        *_charge_columns("recurring", _RECURRING),
    )


def flatten_carts_all(
    df: DataFrame,
    column: str = "cart",
    keep: Sequence[str] = ("id", "created_at", "modified_at"),
    bare_subscriptions: bool = True,
) -> DataFrame:
    """Charges of the added plans of every cart, whatever its type."""
    rows = _subscription_rows(df, column, keep, _plan_grains(bare_carts=False, bare_subscriptions=bare_subscriptions))
    return rows.select(
        *keep,
        blank_if_null(F.col("_cart.id")).alias("cart_id"),
        blank_if_null(F.col("_s.id")).alias("subscription_id"),
        *_subscription_meta(("domain", "domain")),
        domain_extension(F.col("_s.meta.domain")).alias("domain_extension"),
        *_subscription_meta(("action", "action")),
        blank_if_null(F.col("_cart.promo")).alias("promo"),
        *_add_plan_columns("", family=False),
        *_charge_columns("onetime", _ONETIME),
        *_charge_columns("recurring", _RECURRING),
    )


def _plan_grains(bare_carts: bool, bare_subscriptions: bool):
    """Rows of a subscription's added plans, and of one that has none."""
    header = F.array(_row("header", F.lit(None)))

    def grains(sub: Column) -> Column:
        rows, plans = _charge_rows(_plans(sub, "addRatePlans")), sub["addRatePlans"]
        if bare_carts:
            rows = F.when(sub.isNull(), header).otherwise(rows)
        if bare_subscriptions:
            rows = F.when(sub.isNotNull() & (plans.isNull() | (F.size(plans) == 0)), header).otherwise(rows)
        return rows

    return grains


# Refund item fields, the column each one fills, and its type.
_REFUND_ITEM = [
    ("serviceStartDate", "service_start_date", "string"),
    ("serviceEndDate", "service_end_date", "string"),
    ("chargeAmount", "charge_amount", "double"),
    ("availableAmount", "available_amount", "double"),
    ("chargeDescription", "charge_description", "string"),
    ("chargeName", "charge_name", "string"),
    ("productName", "product_name", "string"),
    ("quantity", "quantity", "double"),
    ("taxAmount", "tax_amount", "double"),
    ("unitOfMeasure", "unit_of_measure", "string"),
    ("unitPrice", "unit_price", "double"),
    ("subscriptionId", "subscription_id", "string"),
    ("invoiceItemId", "invoice_item_id", "string"),
    ("subscriptionNumber", "subscription_number", "string"),
    ("productId", "product_id", "string"),
    ("chargeType", "charge_type", "string"),
]


_ITEM_SCHEMA = "struct<" + ",".join(f"{name}:string" for name, _, _ in _REFUND_ITEM) + ">"


def bad_refund_items(df: DataFrame, column: str = "invoice_items", keep: Sequence[str] = ("id",)) -> DataFrame:
    """What can't be read of refunds' item lists, a row each: ``level``
    (document or item) and ``text``. Null text has no row."""
    rows = df.select(*keep, F.col(column).alias("_t"), F.try_parse_json(F.col(column)).alias("_v"))
    listed = F.try_variant_get("_v", "$", "array<variant>")
    whole = F.when(F.col("_t").isNotNull(), F.array(_problem("document", F.col("_t"))))
    bad = F.when(listed.isNotNull(), _unread(listed, "item", {})).otherwise(whole)
    return rows.select(*keep, F.explode(bad).alias("_p")).select(*keep, "_p.level", "_p.text")


def flatten_refund_items(df: DataFrame, column: str = "invoice_items", created: str = "created_at") -> DataFrame:
    """One row per invoice item of a refund, next to the refund's own fields.

    The item's subscription id replaces the refund's; a refund without items
    gives no row. Elements that are no items are left to :func:`bad_refund_items`.
    """
    parsed = F.try_variant_get(F.try_parse_json(F.col(column)), "$", f"array<{_ITEM_SCHEMA}>")
    listed = df.withColumn("_i", F.explode_outer(parsed))
    items = listed.where(F.col("_i").isNotNull())
    filled = {alias for _, alias, _ in _REFUND_ITEM}
    own = [c for c in df.columns if c != column and c not in filled]
    fields = [
        (F.col(f"_i.{name}") if kind == "string" else F.col(f"_i.{name}").try_cast(kind)).alias(alias)
        for name, alias, kind in _REFUND_ITEM
    ]
    return items.select(*own, *fields, F.to_date(created).alias("created_date"))


def _path_of(dotted: str) -> str:
    """A dotted path as Spark's variant functions write it."""
    return "$" + "".join(f"['{name}']" for name in dotted.split("."))


def extract_json(
    df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]], drop_source: bool = True
) -> DataFrame:
    """JSON text to columns: ``{name: (dotted path, type)}``, parsed once.

    Missing keys, null text and text that is no JSON give null; rows with the
    latter are also rows of :func:`bad_json`.
    """
    parsed = df.withColumn("_json", F.try_parse_json(F.col(column)))
    leaves = {
        n: F.try_variant_get("_json", _path_of(path), "string").try_cast(to) for n, (path, to) in fields.items()
    }
    out = parsed.withColumns(leaves).drop("_json")
    return out.drop(column) if drop_source else out


def bad_json(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """Rows whose text is no JSON object: ``keep`` and the text. Null text has no row."""
    text = F.col(column)
    return df.where(text.isNotNull() & ~_is_object(F.try_parse_json(text))).select(*keep, text.alias("text"))


def flatten_struct(df: DataFrame, sep: str = ".", drop: Sequence[str] = ("attributes",)) -> DataFrame:
    """Struct columns to one column per leaf, named by its path; arrays stay."""

    def leaves(kind: T.StructType, path: tuple[str, ...]):
        for f in kind.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield here

    kept = T.StructType([f for f in df.schema.fields if f.name not in drop])
    return df.select(
        [F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in leaves(kept, ())]
    )
