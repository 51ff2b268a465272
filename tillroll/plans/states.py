"""Maintained state: what a daily run needs of history, by batch day.

Lifetime value and favourite category are statements over all history of the
users at hand. Their states hold history reduced, parted by the day of the
batch that brought it. A load that replaces a day replaces that day's part,
which takes back what the earlier version had added; a result merges the
parts of its users, by sums, minima, maxima and distinct ids, and never reads
the rows behind them.

* ``analytics.customer_ltv_state``: per user and revenue day the exact total,
  first and last instant and the order ids. A user with many orders a day has
  a row per ORDERS_PER_ROW or so of them.
* ``analytics.user_product_state``: item rows per user and product. An item
  batch and an order day are accounted for on the later of the two: items
  whose order is of a later day wait as rows with the order's id, and the
  order's day picks them up.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import BatchWindow, Limbs, day, exact, in_window, total, unscale, windowed
from tillroll.operators.sequence import top1_by_count
from tillroll.operators.sizing import join_small
from tillroll.plans.orders import window_order_stats
from tillroll.sources.schemas import BATCH_DAY, conform
from tillroll.sources.tables import Tables

ORDERS_PER_ROW = 1000


def between(df: DataFrame, column: str, first: dt.date, last: dt.date) -> DataFrame:
    return df.where(F.col(column).between(F.lit(first), F.lit(last)))


# -- lifetime value --------------------------------------------------------------


def ltv_state(revenue: DataFrame) -> DataFrame:
    """The state rows of revenue rows (user_id, order_id, amount,
    revenue_date)."""
    per_order = revenue.groupBy("user_id", day("revenue_date").alias(BATCH_DAY), "order_id").agg(
        total(exact("amount")).alias("total"), F.min("revenue_date").alias("first"), F.max("revenue_date").alias("last")
    )
    # a user with a third of all orders is many rows, not one long array
    many = per_order.groupBy("user_id", BATCH_DAY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ORDERS_PER_ROW)
    many = many.select(F.col("user_id").alias("__user"), F.col(BATCH_DAY).alias("__day"), F.ceil(F.col("n") / ORDERS_PER_ROW).alias("parts"))
    same = F.col("user_id").eqNullSafe(F.col("__user")) & F.col(BATCH_DAY).eqNullSafe(F.col("__day"))
    placed = join_small(per_order, many, same, "left")
    part = F.pmod(F.xxhash64("order_id"), F.coalesce("parts", F.lit(1))).alias("part")
    rows = placed.groupBy("user_id", BATCH_DAY, part).agg(
        total("total").alias("total"),
        F.min("first").alias("first_purchase"),
        F.max("last").alias("last_purchase"),
        F.collect_set("order_id").alias("order_ids"),
    )
    return rows.select(
        "user_id", F.col("total.hundredths").alias("total_hundredths"), F.col("total.rest").alias("total_rest"), "first_purchase", "last_purchase", "order_ids", BATCH_DAY
    )


def ltv_from_state(state: DataFrame, w: BatchWindow) -> DataFrame:
    """``finance.customer_lifetime_value`` of the window, from the parts of
    the users that have one in it."""
    in_days = F.col(BATCH_DAY).between(w.first_day, w.last_day)
    active = state.where(in_days).select(F.col("user_id").alias("__uid")).distinct()
    parts = join_small(state, active, F.col("user_id").eqNullSafe(F.col("__uid")), "left_semi")
    sums = parts.groupBy("user_id").agg(
        total(Limbs("total_hundredths", "total_rest")).alias("total"),
        F.min("first_purchase").alias("first_purchase_date"),
        F.max("last_purchase").alias("last_purchase_date"),
    )
    ids = parts.select("user_id", F.explode("order_ids").alias("order_id")).distinct()
    counts = ids.groupBy(F.col("user_id").alias("__uid")).agg(F.count(F.lit(1)).alias("orders"))
    out = sums.where(in_window("last_purchase_date", w)).join(counts, F.col("user_id").eqNullSafe(F.col("__uid")), "left")
    out = out.select("user_id", unscale("total").alias("total_revenue"), "first_purchase_date", "last_purchase_date", F.coalesce("orders", F.lit(0)).alias("purchase_count"))
    return conform(out, "analytics.customer_ltv")


def customer_lifetime_value_merged(t: Tables, w: BatchWindow) -> DataFrame:
    """Lifetime value from a state built of every day of revenue."""
    return ltv_from_state(ltv_state(t["finance.revenue"]), w)


# -- favourite category ------------------------------------------------------------


def _users_of(orders: DataFrame) -> DataFrame:
    """(o_id, user_id, order_day); an order without a time counts as old."""
    known = F.coalesce(day("order_time"), F.lit("0001-01-01").cast("date"))
    return orders.groupBy(F.col("order_id").alias("o_id"), "user_id").agg(F.min(known).alias("order_day"))


def _counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "order_id", "product_id", BATCH_DAY).agg(F.sum("n").alias("n"))


def item_parts(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The state rows of a batch's items (order_id, product_id, batch_day):
    (user_id, null, product_id, batch_day, n) where the order is of the batch
    day or before, else (null, order_id, product_id, batch_day, n)."""
    per_order = items.groupBy("order_id", "product_id", BATCH_DAY).agg(F.count(F.lit(1)).alias("n"))
    users = _users_of(orders)
    met = per_order.join(users, (F.col("order_id") == F.col("o_id")) & (F.col("order_day") <= F.col(BATCH_DAY)), "left")
    waits = F.col("o_id").isNull()
    rows = met.where(waits | F.col("user_id").isNotNull()).select(
        "user_id", F.when(waits, F.col("order_id")).alias("order_id"), "product_id", BATCH_DAY, "n"
    )
    return _counted(rows)


def order_parts(waiting: DataFrame, orders: DataFrame) -> DataFrame:
    """The state rows that orders pick up of the items that wait for them, on
    the orders' own days."""
    users = _users_of(orders)
    rows = waiting.where("user_id is null and order_id is not null").withColumnRenamed("user_id", "__none")
    met = join_small(rows, users, (F.col("order_id") == F.col("o_id")) & (F.col("order_day") > F.col(BATCH_DAY)))
    met = met.where(F.col("user_id").isNotNull())
    return _counted(met.select("user_id", F.lit(None).cast("long").alias("order_id"), "product_id", F.col("order_day").alias(BATCH_DAY), "n"))


def stats_from_state(t: Tables, state: DataFrame, w: BatchWindow) -> DataFrame:
    """``orders.user_order_stats`` of the window: its orders, and of the state
    the parts of its users."""
    stats = window_order_stats(t, w)
    users = stats.where(F.col("user_id").isNotNull()).select("user_id")
    parts = join_small(state.where(F.col("user_id").isNotNull()), users, "user_id", "left_semi")
    per_product = parts.groupBy("user_id", "product_id").agg(F.sum("n").alias("n"))
    products = t["product_center.products"].select("product_id", "category")
    per_category = per_product.join(products, "product_id").groupBy("user_id", "category").agg(F.sum("n").alias("n"))
    favourite = top1_by_count(per_category, "user_id", "category", "n", "favorite_category")
    out = stats.join(favourite, "user_id", "left").withColumn("total_spent", unscale("spent"))
    return conform(out, "analytics.user_order_stats")


def user_order_stats_merged(t: Tables, w: BatchWindow) -> DataFrame:
    """User order stats from a state built of every batch of items."""
    items = t["raw_data.order_item_details"].select("order_id", "product_id", day("create_time").alias(BATCH_DAY))
    orders = t["order_center.orders"].select("order_id", "user_id", "order_time")
    own = item_parts(items, orders)
    return stats_from_state(t, own.unionByName(order_parts(own, orders)), w)


def orders_of(t: Tables, w: BatchWindow) -> DataFrame:
    return windowed(t["order_center.orders"], "order_time", w).select("order_id", "user_id", "order_time")
