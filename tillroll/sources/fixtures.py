"""Logical tables over the bundled TPC-H-shaped Parquet fixtures.

The fixture directory holds generic tables (orders, lineitem, part, events,
customer, supplier, nation, ...). Each logical table the jobs read is a view
over them, so every job's work grows with the fixture tables. The mapping is
documented in FIXTURES.md section 4; the DuckDB oracle defines the same views
independently in SQL.

Profiles swap a few views for jobs that need other shapes:

* ``events``  - ``order_center.orders`` are purchase events, so same-day joins
  with the event stream find orders;
* ``ledger``  - ``order_center.order_items`` are the returned lineitems only,
  so stock movements do not overlap;
* ``expense`` - ``inventory.receipt_items`` are all lineitems.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.window import BatchWindow
from tillroll.sources.schemas import fields
from tillroll.sources.tables import Tables

# The fixture calendar and an all-history window.
JAN1 = "2024-01-01"
ALL_TIME = BatchWindow("1900-01-01", "2100-01-01", "2024-01-30")

PHYSICAL = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def _jan(n: Column) -> Column:
    """2024-01-01 plus ``n`` days, as DATE."""
    return F.date_add(F.lit(JAN1).cast("date"), n.cast("int"))


def _jan_ts(n: Column) -> Column:
    return _jan(n).cast("timestamp_ntz")


def _completed_if_final(status: str) -> Column:
    return F.when(F.col(status) == "F", "completed").otherwise("pending")


def _line_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _c(name: str) -> Column:
    return F.col(name)


# Each builder takes the Tables being built (``t.raw(name)`` for a physical
# table, ``t[name]`` for another logical table).
Builder = Callable[["FixtureTables"], DataFrame]


def _orders_tpch(t: "FixtureTables") -> DataFrame:
    return t.raw("orders").select(
        _c("o_orderkey").alias("order_id"),
        _c("o_custkey").alias("user_id"),
        _c("o_orderdate").alias("order_time"),
        _c("o_totalprice").alias("total_amount"),
        F.when(_c("o_orderstatus") == "F", "completed")
        .when(_c("o_orderstatus") == "O", "pending")
        .when(_c("o_orderstatus") == "P", "processing")
        .alias("status"),
        _c("o_orderpriority").alias("payment_method"),
        (_c("o_custkey") % 10).alias("warehouse_id"),
    )


def _orders_events(t: "FixtureTables") -> DataFrame:
    return (
        t.raw("events")
        .where(_c("event_type") == "purchase")
        .select(
            _c("event_id").alias("order_id"),
            _c("user_id"),
            _c("ts").alias("order_time"),
            _c("value").alias("total_amount"),
            F.lit("completed").alias("status"),
            F.lit(None).cast("string").alias("payment_method"),
            (_c("user_id") % 10).alias("warehouse_id"),
        )
    )


def _order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        _c("l_orderkey").alias("order_id"),
        _c("l_partkey").alias("product_id"),
        _c("l_quantity").alias("quantity"),
        _c("l_extendedprice").alias("unit_price"),
        (_c("l_quantity") * _c("l_extendedprice")).alias("subtotal"),
    )


def _receipt_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        _c("l_orderkey").alias("receipt_id"),
        _c("l_partkey").alias("product_id"),
        _c("l_quantity").alias("quantity"),
        _c("l_extendedprice").alias("unit_cost"),
    )


def _flags(returnflag: str | None, linestatus: str | None) -> Builder:
    def build(t: "FixtureTables") -> DataFrame:
        li = t.raw("lineitem")
        if returnflag is not None:
            li = li.where(_c("l_returnflag") == returnflag)
        if linestatus is not None:
            li = li.where(_c("l_linestatus") == linestatus)
        return li

    return build


def _events_of(kind: str) -> Builder:
    return lambda t: t.raw("events").where(_c("event_type") == kind)


def _events_with_customer(t: "FixtureTables", kinds: tuple[str, ...] | None = None) -> DataFrame:
    ev = t.raw("events")
    if kinds:
        ev = ev.where(_c("event_type").isin(*kinds))
    cust = t.raw("customer").select(
        _c("c_custkey").alias("user_id"), "c_name", "c_nationkey", "c_mktsegment"
    )
    return ev.join(cust, "user_id")


def _part_time(t: "FixtureTables") -> DataFrame:
    return t.raw("part").withColumn("__t", _jan_ts(_c("p_partkey") % 30))


VIEWS: dict[str, Builder] = {
    # --- orders, items, payments, refunds, shipping ---------------------
    "raw_data.order_logs": lambda t: t.raw("orders").select(
        _c("o_orderkey").alias("order_id"),
        _c("o_custkey").alias("user_id"),
        _c("o_orderdate").alias("create_time"),
        _c("o_totalprice").alias("total_price"),
        _c("o_orderstatus").alias("order_status"),
        _c("o_orderpriority").alias("payment_type"),
    ),
    "order_center.orders": _orders_tpch,
    "raw_data.order_item_details": lambda t: t.raw("lineitem").select(
        _c("l_orderkey").alias("order_id"),
        _c("l_partkey").alias("product_id"),
        _c("l_quantity").alias("quantity"),
        _c("l_extendedprice").alias("price"),
        _c("l_shipdate").alias("create_time"),
    ),
    "order_center.order_items": lambda t: _order_items(t.raw("lineitem")),
    "raw_data.payment_logs": lambda t: t["payment_center.payments"].select(
        "payment_id",
        "order_id",
        "user_id",
        _c("amount").alias("payment_amount"),
        "payment_time",
        _c("status").alias("payment_status"),
    ),
    "payment_center.payments": lambda t: t.raw("lineitem")
    .join(
        t.raw("orders").select(_c("o_orderkey").alias("l_orderkey"), "o_custkey"),
        "l_orderkey",
    )
    .select(
        _line_id().alias("payment_id"),
        _c("l_orderkey").alias("order_id"),
        _c("o_custkey").alias("user_id"),
        _c("l_extendedprice").alias("amount"),
        _c("l_shipdate").alias("payment_time"),
        _completed_if_final("l_linestatus").alias("status"),
    ),
    "raw_data.refund_logs": lambda t: t["payment_center.refunds"].select(
        "refund_id",
        "order_id",
        "payment_id",
        _c("amount").alias("refund_amount"),
        "refund_time",
        _c("reason").alias("refund_reason"),
        _c("status").alias("refund_status"),
    ),
    "payment_center.refunds": lambda t: _flags("R", None)(t).select(
        _line_id().alias("refund_id"),
        _c("l_orderkey").alias("order_id"),
        _line_id().alias("payment_id"),
        _c("l_extendedprice").alias("amount"),
        _c("l_shipdate").alias("refund_time"),
        _c("l_returnflag").alias("reason"),
        _completed_if_final("l_linestatus").alias("status"),
    ),
    "raw_data.shipping_records": lambda t: t.raw("lineitem").select(
        _line_id().alias("shipment_id"),
        _c("l_orderkey").alias("order_id"),
        _c("l_suppkey").alias("address_id"),
        _c("l_linestatus").alias("shipping_method"),
        _c("l_linenumber").cast("string").alias("tracking_number"),
        F.when(_c("l_returnflag") == "A", "delivered").otherwise("in_transit").alias("status"),
        _c("l_shipdate").alias("create_time"),
    ),
    "logistics.shipments": lambda t: t.raw("lineitem").select(
        _line_id().alias("shipment_id"),
        _c("l_orderkey").alias("order_id"),
        F.lit(None).cast("string").alias("shipping_address"),
        _c("l_linestatus").alias("shipping_method"),
        _c("l_linenumber").cast("string").alias("tracking_number"),
        F.when(_c("l_returnflag") == "A", "delivered").otherwise("in_transit").alias("status"),
        (_c("l_extendedprice") * _c("l_tax")).alias("shipping_cost"),
        _c("l_shipdate").alias("shipping_date"),
        _c("l_shipdate").alias("delivery_time"),
    ),
    "user_center.user_addresses": lambda t: t.raw("supplier")
    .join(t.raw("nation").withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey")
    .select(
        _c("s_suppkey").alias("address_id"),
        F.concat(_c("s_name"), F.lit(", "), _c("n_name")).alias("full_address"),
    ),
    # --- products ---------------------------------------------------------
    "raw_data.product_logs": lambda t: _part_time(t).select(
        _c("p_partkey").alias("product_id"),
        _c("p_name").alias("product_name"),
        _c("p_name").alias("product_description"),
        _c("p_type").alias("category"),
        _c("p_retailprice").alias("price"),
        _c("p_size").alias("stock_quantity"),
        _c("p_brand").alias("product_status"),
        _c("__t").alias("create_time"),
    ),
    "product_center.products": lambda t: t.raw("part").select(
        _c("p_partkey").alias("product_id"),
        _c("p_name").alias("name"),
        _c("p_name").alias("description"),
        _c("p_type").alias("category"),
        _c("p_retailprice").alias("price"),
        _c("p_size").cast("bigint").alias("stock"),
        _c("p_brand").alias("status"),
        _c("p_size").cast("double").alias("reorder_threshold"),
        F.lit(None).cast("double").alias("average_rating"),
    ),
    "raw_data.product_images": lambda t: _part_time(t).select(
        _c("p_partkey").alias("image_id"),
        _c("p_partkey").alias("product_id"),
        F.concat(F.lit("img/"), _c("p_partkey").cast("string")).alias("image_url"),
        F.when(_c("p_size") % 2 == 0, 1).otherwise(0).alias("is_main"),
        (_c("p_size") % 5).alias("display_order"),
        _c("__t").alias("upload_time"),
    ),
    "raw_data.product_attributes": lambda t: _part_time(t)
    .select(
        _c("p_partkey").alias("product_id"),
        F.lit("brand").alias("attribute_key"),
        _c("p_brand").alias("attribute_value"),
        _c("__t").alias("update_time"),
    )
    .unionByName(
        _part_time(t).select(
            _c("p_partkey").alias("product_id"),
            F.lit("type").alias("attribute_key"),
            _c("p_type").alias("attribute_value"),
            _c("__t").alias("update_time"),
        )
    ),
    "raw_data.inventory_logs": lambda t: _part_time(t).select(
        _c("p_partkey").alias("product_id"),
        (_c("p_partkey") % 10).alias("warehouse_id"),
        (_c("p_partkey") % 60).alias("stock_quantity"),
        _c("__t").alias("update_time"),
    ),
    "inventory.product_inventory": lambda t: _part_time(t).select(
        _c("p_partkey").alias("product_id"),
        (_c("p_partkey") % 10).alias("warehouse_id"),
        (_c("p_partkey") % 60).cast("double").alias("quantity"),
        _c("__t").alias("last_updated"),
    ),
    "raw_data.price_change_logs": lambda t: t.raw("events").select(
        _c("user_id").alias("product_id"),
        _c("value").alias("new_price"),
        _c("ts").alias("change_time"),
        _c("event_type").alias("change_reason"),
    ),
    "raw_data.product_reviews": lambda t: _events_of("view")(t).select(
        _c("event_id").alias("review_id"),
        _c("user_id").alias("product_id"),
        "user_id",
        (F.lit(1) + _c("event_id") % 5).cast("int").alias("rating"),
        _c("props").alias("comment"),
        _c("ts").alias("create_time"),
    ),
    "product_center.product_reviews": lambda t: t["raw_data.product_reviews"].select(
        "review_id",
        "product_id",
        "user_id",
        "rating",
        _c("comment").alias("review_text"),
        _c("create_time").alias("review_time"),
    ),
    # --- users --------------------------------------------------------------
    "raw_data.user_signup_logs": lambda t: _events_with_customer(t, ("signup",)).select(
        _c("user_id").alias("id"),
        _c("c_name").alias("username"),
        _c("c_name").alias("email"),
        _c("c_nationkey").cast("string").alias("phone_number"),
        _c("ts").alias("create_time"),
    ),
    "user_center.registered_users": lambda t: _events_of("signup")(t)
    .groupBy("user_id")
    .agg(F.min("ts").alias("register_time"))
    .join(
        t.raw("customer").select(
            _c("c_custkey").alias("user_id"), "c_name", "c_nationkey", "c_mktsegment"
        ),
        "user_id",
    )
    .select(
        "user_id",
        _c("c_name").alias("username"),
        _c("c_name").alias("email"),
        _c("c_nationkey").cast("string").alias("phone"),
        "register_time",
        F.lit(1).alias("status"),
        _c("c_mktsegment").alias("referral_source"),
        F.lit(None).cast("timestamp_ntz").alias("deletion_time"),
    ),
    "raw_data.login_logs": lambda t: _events_of("view")(t).select(
        "user_id",
        _c("ts").alias("login_time"),
        _c("props").alias("ip_address"),
        _c("event_type").alias("device_type"),
        F.lit("1").alias("app_version"),
    ),
    "user_center.login_history": lambda t: t["raw_data.login_logs"],
    "raw_data.user_profile_updates": lambda t: _events_with_customer(t).select(
        "user_id",
        _c("c_name").alias("nickname"),
        _c("c_name").alias("avatar_url"),
        _c("event_type").alias("gender"),
        F.to_date("ts").alias("birthday"),
        _c("c_mktsegment").alias("region"),
        _c("ts").alias("update_time"),
    ),
    "raw_data.user_settings": lambda t: _events_with_customer(t).select(
        "user_id",
        _c("event_type").alias("preference_name"),
        _c("c_mktsegment").alias("preference_value"),
        _c("ts").alias("update_time"),
    ),
    "raw_data.device_registry": lambda t: _events_with_customer(t).select(
        "user_id",
        _c("event_id").alias("device_id"),
        _c("c_name").alias("device_name"),
        _c("event_type").alias("os_type"),
        _c("ts").alias("last_login_time"),
        _c("ts").alias("register_time"),
    ),
    "raw_data.user_sessions": lambda t: t.raw("events").select(
        "user_id",
        _c("ts").alias("login_time"),
        (_c("value") * 30).alias("session_duration"),
        (_c("event_id") % 10).alias("pages_visited"),
        (_c("event_id") % 5).alias("actions"),
    ),
    "raw_data.account_deletion_requests": lambda t: _events_of("error")(t).select(
        "user_id",
        _c("ts").alias("request_time"),
        F.when(_c("event_id") % 2 == 0, "approved").otherwise("pending").alias("status"),
    ),
    "raw_data.user_events": lambda t: t.raw("events").select(
        "user_id",
        _c("ts").alias("event_time"),
        F.when(_c("event_type") == "click", "add_to_cart")
        .when(_c("event_type") == "view", "begin_checkout")
        .otherwise(_c("event_type"))
        .alias("event_type"),
    ),
    # --- marketing ------------------------------------------------------------
    "raw_data.marketing_campaigns": lambda t: t.raw("nation").select(
        _c("n_nationkey").cast("bigint").alias("campaign_id"),
        _c("n_name").alias("campaign_name"),
        _c("n_name").alias("campaign_description"),
        F.lit(JAN1).cast("date").alias("start_date"),
        _jan(_c("n_nationkey")).alias("end_date"),
        F.lit(1000.0).alias("budget_amount"),
        F.when(_c("n_nationkey") % 2 == 1, "active").otherwise("draft").alias("campaign_status"),
        _jan_ts(_c("n_nationkey")).alias("create_time"),
    ),
    "marketing.campaigns": lambda t: t.raw("nation").select(
        _c("n_nationkey").cast("bigint").alias("campaign_id"),
        _c("n_name").alias("name"),
        _c("n_name").alias("description"),
        F.lit(JAN1).cast("date").alias("start_date"),
        _jan(_c("n_nationkey")).alias("end_date"),
        F.lit(1000.0).alias("budget"),
        F.when(_c("n_nationkey") % 2 == 1, "active").otherwise("draft").alias("status"),
        (_c("n_nationkey") * 100).cast("double").alias("budget_spent"),
        _c("n_regionkey").cast("bigint").alias("channel_id"),
    ),
    "raw_data.campaign_channels": lambda t: t.raw("nation").select(
        _c("n_nationkey").cast("bigint").alias("campaign_id"),
        F.concat(F.lit("channel_"), _c("n_regionkey").cast("string")).alias("channel_name"),
        (_c("n_nationkey") * 100).cast("double").alias("allocated_budget"),
        F.lit(JAN1).cast("date").alias("channel_start_date"),
        _jan(_c("n_nationkey")).alias("channel_end_date"),
        _jan_ts(_c("n_nationkey")).alias("create_time"),
    ),
    "raw_data.promotion_codes": lambda t: t.raw("nation").select(
        F.concat(F.lit("PROMO"), _c("n_nationkey").cast("string")).alias("promo_code"),
        _c("n_nationkey").cast("bigint").alias("campaign_id"),
        F.when(_c("n_nationkey") % 2 == 0, "percent").otherwise("fixed").alias("discount_type"),
        _c("n_nationkey").cast("double").alias("discount_amount"),
        F.lit(JAN1).cast("date").alias("valid_from"),
        _jan(_c("n_nationkey")).alias("valid_to"),
        (_c("n_nationkey") * 10).cast("bigint").alias("max_uses"),
        _jan_ts(_c("n_nationkey")).alias("create_time"),
    ),
    "raw_data.promotion_usage_logs": lambda t: _events_of("purchase")(t).select(
        F.concat(F.lit("PROMO"), (_c("user_id") % 25).cast("string")).alias("promo_code"),
        _c("event_id").alias("order_id"),
        "user_id",
        _c("ts").alias("apply_time"),
        _c("value").alias("discount_amount"),
    ),
    "raw_data.email_campaigns": lambda t: t.raw("nation").select(
        _c("n_nationkey").cast("bigint").alias("campaign_id"),
        _c("n_name").alias("email_subject"),
        _c("n_name").alias("email_content"),
        _jan_ts(_c("n_nationkey")).alias("send_time"),
        (_c("n_nationkey") * 10).cast("bigint").alias("recipient_count"),
    ),
    "marketing.email_campaigns": lambda t: t["raw_data.email_campaigns"].select(
        "campaign_id",
        _c("email_subject").alias("subject"),
        _c("email_content").alias("content"),
        _c("send_time").alias("sent_time"),
        "recipient_count",
    ),
    "raw_data.email_events": lambda t: t.raw("events").select(
        (_c("user_id") % 25).alias("campaign_id"),
        "user_id",
        F.when(_c("event_type") == "view", "open").otherwise(_c("event_type")).alias("event_type"),
    ),
    "raw_data.marketing_metrics": lambda t: _events_with_customer(t, ("view", "click")).select(
        (_c("user_id") % 25).alias("campaign_id"),
        "user_id",
        _c("ts").alias("event_date"),
        F.when(_c("event_type") == "view", "impression").otherwise(_c("event_type")).alias("event_type"),
        F.lit(1).cast("bigint").alias("event_count"),
        _c("value").alias("cost"),
        _c("c_mktsegment").alias("source"),
    ),
    # --- inventory ------------------------------------------------------------
    "raw_data.warehouse_records": lambda t: t.raw("supplier").select(
        _c("s_suppkey").alias("warehouse_id"),
        _c("s_name").alias("warehouse_name"),
        _c("s_nationkey").cast("string").alias("warehouse_location"),
        F.lit(1000).cast("bigint").alias("storage_capacity"),
        F.lit("open").alias("operational_status"),
        _jan_ts(_c("s_suppkey")).alias("create_time"),
    ),
    "inventory.warehouses": lambda t: t["raw_data.warehouse_records"].select(
        "warehouse_id",
        _c("warehouse_name").alias("name"),
        _c("warehouse_location").alias("location"),
        _c("storage_capacity").alias("capacity"),
        _c("operational_status").alias("status"),
    ),
    "raw_data.inventory_receipts": lambda t: t.raw("orders").select(
        _c("o_orderkey").alias("receipt_id"),
        (_c("o_custkey") % 10).alias("warehouse_id"),
        _c("o_custkey").alias("supplier_id"),
        _c("o_orderdate").alias("receive_date"),
        (_c("o_orderkey") % 7).alias("item_count"),
    ),
    "inventory.inventory_receipts": lambda t: t["raw_data.inventory_receipts"].select(
        "receipt_id",
        "warehouse_id",
        "supplier_id",
        _c("receive_date").alias("receipt_date"),
        _c("item_count").alias("total_items"),
    ),
    "raw_data.receipt_item_details": lambda t: t.raw("lineitem").select(
        _c("l_orderkey").alias("receipt_id"),
        _c("l_partkey").alias("product_id"),
        _c("l_quantity").alias("received_quantity"),
        _c("l_extendedprice").alias("cost_per_unit"),
        _c("l_shipdate").alias("create_time"),
    ),
    "inventory.receipt_items": lambda t: _receipt_items(t.raw("lineitem")),
    "raw_data.inventory_adjustments": lambda t: t.raw("lineitem").select(
        _line_id().alias("adjustment_id"),
        (_c("l_suppkey") % 10).alias("warehouse_id"),
        _c("l_partkey").alias("product_id"),
        (_c("l_quantity") - 25).alias("quantity_delta"),
        _c("l_linestatus").alias("adjustment_reason"),
        _c("l_shipdate").alias("adjustment_time"),
    ),
    "inventory.inventory_adjustments": lambda t: t["raw_data.inventory_adjustments"].select(
        "adjustment_id",
        "warehouse_id",
        "product_id",
        _c("quantity_delta").alias("quantity_change"),
        _c("adjustment_reason").alias("reason"),
        "adjustment_time",
    ),
    "raw_data.inventory_transfers": lambda t: t.raw("orders").select(
        _c("o_orderkey").alias("transfer_id"),
        (_c("o_custkey") % 10).alias("from_warehouse_id"),
        ((_c("o_custkey") + 3) % 10).alias("to_warehouse_id"),
        _c("o_orderdate").alias("transfer_date"),
        _c("o_orderstatus").alias("transfer_status"),
    ),
    "inventory.inventory_transfers": lambda t: t["raw_data.inventory_transfers"].select(
        "transfer_id",
        _c("from_warehouse_id").alias("source_warehouse_id"),
        _c("to_warehouse_id").alias("destination_warehouse_id"),
        "transfer_date",
        _c("transfer_status").alias("status"),
    ),
    "raw_data.transfer_item_details": lambda t: t.raw("lineitem").select(
        _c("l_orderkey").alias("transfer_id"),
        _c("l_partkey").alias("product_id"),
        _c("l_quantity").alias("transfer_quantity"),
        _c("l_shipdate").alias("create_time"),
    ),
    "inventory.transfer_items": lambda t: t["raw_data.transfer_item_details"].select(
        "transfer_id", "product_id", _c("transfer_quantity").alias("quantity")
    ),
    "inventory.low_stock_alerts": lambda t: _events_of("error")(t).select(
        _c("user_id").alias("product_id"),
        (_c("user_id") % 10).alias("warehouse_id"),
        F.lit(None).cast("double").alias("current_quantity"),
        F.lit(None).cast("double").alias("threshold"),
        F.to_date("ts").alias("alert_date"),
    ),
    # the first ledger day starts empty: a typed relation with no rows
    "analytics.inventory_levels": lambda t: t.spark.range(0).select(
        *[F.lit(None).cast(ty).alias(n) for n, ty in fields("analytics.inventory_levels")]
    ),
    # --- tables filled by other jobs, over all history --------------------------
    "finance.revenue": lambda t: _plans().finance.revenue_recognition(t, ALL_TIME),
    "finance.expenses": lambda t: _all_expenses(t),
    "analytics.user_activity_summary": lambda t: _plans().users.user_activity(t, ALL_TIME),
}

PROFILES: dict[str, dict[str, Builder]] = {
    "default": {},
    "events": {"order_center.orders": _orders_events},
    "carried": {"analytics.inventory_levels": lambda t: _prior_ledger(t)},
}

# Fixed value: the day before the ledger's fixture window.
PRIOR_LEDGER_DAY = "1996-06-02"


def _prior_ledger(t: "FixtureTables") -> DataFrame:
    """Balances of the day before: for every part, its stocked pair and one
    at another warehouse."""
    own = {"date": F.lit(PRIOR_LEDGER_DAY), "product_id": _c("p_partkey"), "ending_quantity": _c("p_size")}

    def day(warehouse: Column) -> DataFrame:
        given = own | {"warehouse_id": warehouse}
        return t.raw("part").select(*[given.get(n, F.lit(None)).cast(ty).alias(n) for n, ty in fields("analytics.inventory_levels")])

    return day(_c("p_partkey") % 10).unionByName(day((_c("p_partkey") + 3) % 10))


def _plans():
    import tillroll.plans as plans

    return plans


def _all_expenses(t: "FixtureTables") -> DataFrame:
    f = _plans().finance
    parts = [
        f.refund_expense(t, ALL_TIME),
        f.shipping_expense(t, ALL_TIME),
        f.inventory_expense(t, ALL_TIME),
        f.marketing_expense(t, ALL_TIME),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# per-session caches, dropped with the session (weak keys), so a later
# session never sees plans bound to a stopped one
_RAW: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


class FixtureTables(Tables):
    """``Tables`` over the fixture directory, with a named profile."""

    def __init__(self, spark: SparkSession, sf_dir: str, profile: str = "default"):
        resolvers = dict(VIEWS)
        resolvers.update(PROFILES[profile])
        super().__init__(spark, resolvers)
        self.sf_dir = sf_dir.rstrip("/")
        self.profile_name = profile

    def raw(self, name: str) -> DataFrame:
        # one DataFrame per (session, file): a read lists the file and reads
        # its footer on the driver, so repeated views reuse it
        path = f"{self.sf_dir}/{name}.parquet"
        reads = _RAW.setdefault(self.spark, {})
        if path not in reads:
            reads[path] = self.spark.read.parquet(path)
        return reads[path]

    def profile(self, name: str) -> "FixtureTables":
        return fixture_tables(self.spark, self.sf_dir, name)


_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[tuple[str, str], FixtureTables]]" = weakref.WeakKeyDictionary()


def fixture_tables(spark: SparkSession, sf_dir: str, profile: str = "default") -> FixtureTables:
    """One registry per (session, directory, profile): views are lazy plans,
    so jobs of one session share them (as ``spark.table`` would)."""
    key = (sf_dir.rstrip("/"), profile)
    registries = _TABLES.setdefault(spark, {})
    if key not in registries:
        registries[key] = FixtureTables(spark, sf_dir, profile)
    return registries[key]
