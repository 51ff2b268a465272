"""Order jobs: shipping, daily summary, per-user stats, conversion, status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import BatchWindow, day, dsum, ratio, unscale, windowed, windowed_days
from tillroll.operators.changes import apply_changes
from tillroll.operators.sequence import top1_by_count
from tillroll.operators.sizing import join_small
from tillroll.sources.schemas import conform, fields
from tillroll.sources.tables import Tables


def order_shipping(t: Tables, w: BatchWindow, batch_day: str | None = None) -> DataFrame:
    """Shipments of the window with their address text; shipments whose
    address is unknown drop out (inner join). With ``batch_day``, also the
    day the shipment was created, under that name."""
    day_col = [] if batch_day is None else [day("create_time").alias(batch_day)]
    ships = windowed(t["raw_data.shipping_records"], "create_time", w).select(
        "shipment_id", "order_id", "address_id", "shipping_method", "tracking_number", "status", *day_col
    )
    addr = t["user_center.user_addresses"].select(
        "address_id", F.col("full_address").alias("shipping_address")
    )
    out = join_small(addr, ships, "address_id")
    kinds = fields("logistics.shipments")
    return out.select(*[F.col(n).cast(k).alias(n) for n, k in kinds], *([] if batch_day is None else [batch_day]))


def daily_order_summary(t: Tables, w: BatchWindow) -> DataFrame:
    """Per order day: distinct orders, amount total and mean, and a JSON
    object payment_method -> order rows (keys sorted; NULL method is
    reported as "unknown", since a map key cannot be NULL)."""
    o = windowed(t["order_center.orders"], "order_time", w).select(
        day("order_time").alias("date"),
        "order_id",
        "total_amount",
        F.coalesce(F.col("payment_method"), F.lit("unknown")).alias("payment_method"),
    )
    totals = o.groupBy("date").agg(
        F.count_distinct("order_id").alias("total_orders"),
        dsum("total_amount").alias("amount"),
        F.count("total_amount").alias("n_amount"),
    )
    per_method = o.groupBy("date", "payment_method").agg(F.count(F.lit(1)).alias("n"))
    # the list gathered per day holds one (method, count) pair per distinct
    # payment method, not the day's orders: its size is the number of methods
    dist = per_method.groupBy("date").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("payment_method", "n"))))).alias(
            "payment_method_distribution"
        )
    )
    out = totals.join(dist, "date").select(
        "date",
        "total_orders",
        unscale("amount").alias("total_amount"),
        ratio(unscale("amount"), "n_amount").alias("avg_order_value"),
        "payment_method_distribution",
    )
    return conform(out, "analytics.daily_order_summary")


def window_order_stats(t: Tables, w: BatchWindow) -> DataFrame:
    """Per user of the window: orders, what was spent (in limbs), first and
    last order day."""
    return windowed(t["order_center.orders"], "order_time", w).groupBy("user_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        dsum("total_amount").alias("spent"),
        F.min(day("order_time")).alias("first_order_date"),
        F.max(day("order_time")).alias("last_order_date"),
    )


def user_order_stats(t: Tables, w: BatchWindow) -> DataFrame:
    """Window stats per user, plus the category the user bought most often
    over all of their orders (item rows; ties go to the smallest category).
    Written tables keep a state for the second part
    (``states.stats_from_state``)."""
    orders = t["order_center.orders"]
    ow = windowed(orders, "order_time", w)
    stats = window_order_stats(t, w)
    users = ow.where(F.col("user_id").isNotNull()).select("user_id").distinct()
    their_orders = join_small(orders.select("order_id", "user_id"), users, "user_id", "left_semi").distinct()
    items = t["order_center.order_items"].select("order_id", "product_id")
    # all orders of the users are history by construction: not probed. Item
    # rows per (user, product) first, so the product lookup sees one row per
    # pair and a hot order or product is reduced map-side
    per_product = items.join(their_orders, "order_id").groupBy("user_id", "product_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    products = t["product_center.products"].select("product_id", "category")
    per_category = (
        per_product.join(products, "product_id").groupBy("user_id", "category").agg(F.sum("n").alias("n"))
    )
    fav = top1_by_count(per_category, "user_id", "category", "n", "favorite_category")
    out = stats.join(fav, "user_id", "left").select(
        "user_id",
        "total_orders",
        unscale("spent").alias("total_spent"),
        "first_order_date",
        "last_order_date",
        "favorite_category",
    )
    return conform(out, "analytics.user_order_stats")


def _conversion_days(t: Tables, w: BatchWindow) -> DataFrame:
    """Per (user, day) of the window: cart and checkout events, joined with
    the number and the distinct ids of the user's orders of that day. Events
    and orders are each reduced to one row per (user, day) before they meet,
    so neither a bot user's events nor event x order pairs are ever joined.
    Events without a user keep their counts and meet no order."""
    is_kind = lambda kind: F.count(F.when(F.col("event_type") == kind, 1))
    events = (
        windowed(t["raw_data.user_events"], "event_time", w)
        .groupBy("user_id", day("event_time").alias("date"))
        .agg(is_kind("add_to_cart").alias("carts"), is_kind("begin_checkout").alias("checkouts"))
    )
    orders = (
        windowed_days(t["order_center.orders"], "order_time", w)
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id", day("order_time").alias("date"))
        .agg(F.count(F.lit(1)).alias("order_rows"), F.count_distinct("order_id").alias("order_ids"))
    )
    return events.join(orders, ["user_id", "date"], "left")


def _conversion(t: Tables, w: BatchWindow, weight) -> DataFrame:
    # an order has one user, so distinct ids add up over users
    counts = _conversion_days(t, w).groupBy("date").agg(
        F.sum(F.col("carts") * weight).alias("cart_additions"),
        F.sum(F.col("checkouts") * weight).alias("checkout_starts"),
        F.coalesce(F.sum("order_ids"), F.lit(0)).alias("orders_completed"),
    )
    out = counts.select(
        "date", "cart_additions", "checkout_starts", "orders_completed",
        ratio("orders_completed", "checkout_starts").alias("conversion_rate"),
    )
    return conform(out, "analytics.order_conversion")


def order_conversion(t: Tables, w: BatchWindow) -> DataFrame:
    """As written: events LEFT JOIN same-day orders of the user, so an event
    counts once per matching order row."""
    return _conversion(t, w, F.greatest(F.coalesce(F.col("order_rows"), F.lit(0)), F.lit(1)))


def order_conversion_exact(t: Tables, w: BatchWindow) -> DataFrame:
    """Each event counted once; orders counted once per day, restricted to
    users with an event that day."""
    return _conversion(t, w, F.lit(1))


def update_order_status(t: Tables, w: BatchWindow) -> DataFrame:
    """Snapshot of orders where every order with a delivered shipment
    delivered in the window becomes 'delivered'."""
    delivered = (
        windowed(t["logistics.shipments"], "delivery_time", w)
        .where(F.col("status") == "delivered")
        .select("order_id")
        .distinct()
    )
    return apply_changes(t["order_center.orders"], delivered, ["order_id"], {"status": F.lit("delivered")})
