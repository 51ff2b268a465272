"""Product jobs: price history, sales, category performance, rating."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import BatchWindow, day, dsum, in_window, ratio, total, unscale, windowed
from tillroll.operators.changes import apply_changes
from tillroll.operators.sequence import lead_time
from tillroll.operators.sizing import join_small
from tillroll.sources.schemas import conform
from tillroll.sources.tables import Tables


def _price_rows(logs: DataFrame) -> DataFrame:
    # changes at one instant: the one that sorts last stays in force
    columns = logs.select("product_id", "new_price", "change_time", "change_reason")
    out = lead_time(columns, "product_id", "change_time", "effective_to", ties=("new_price", "change_reason")).select(
        "product_id",
        F.col("new_price").alias("price"),
        F.col("change_time").alias("effective_from"),
        "effective_to",
        "change_reason",
    )
    return conform(out, "product_center.price_history")


def product_price_history(t: Tables, w: BatchWindow) -> DataFrame:
    """As written: effective_to = next change of the product *within the
    window*, so each product's last change of a batch stays open."""
    logs = windowed(t["raw_data.price_change_logs"], "change_time", w)
    return _price_rows(logs)


def product_price_history_exact(t: Tables, w: BatchWindow) -> DataFrame:
    """Full history (up to the window end) of every product changed in the
    window, with effective_to re-derived over that history, so rows closed
    by this batch are rewritten too."""
    logs = t["raw_data.price_change_logs"]
    changed = windowed(logs, "change_time", w).select("product_id").distinct()
    history = join_small(logs.where(F.col("change_time") < w.hi), changed, "product_id", "left_semi")
    return _price_rows(history)


def price_history_step(logs: DataFrame, stored: DataFrame, w: BatchWindow) -> tuple[DataFrame, DataFrame]:
    """The price history after the window's changes, from the rows that
    ``stored`` holds open or closed on the window's first day or later:
    (rows, products). ``rows`` are all of theirs from that day on, in place of
    those stored.

    A product's change before the window is the one row that starts before it
    and is not closed before it, open or not: no older one is read. It is
    closed by the first change of the window, and the last one of the window
    by the first after it (a rerun of an old day) or not at all."""
    logs = windowed(logs, "change_time", w).where(F.col("product_id").isNotNull())
    starts = in_window("effective_from", w)
    # products that changed in the window, now or in an earlier run of it
    had = stored.where(starts | in_window("effective_to", w))
    products = logs.select("product_id").union(had.select("product_id")).distinct()
    mine = join_small(stored, products, "product_id", "left_semi", proven=False)
    before = mine.where(F.col("effective_from") < w.lo).select(
        "product_id", F.col("price").alias("new_price"), F.col("effective_from").alias("change_time"), "change_reason"
    )
    after = mine.where(F.col("effective_from") >= w.hi)
    next_change = after.groupBy("product_id").agg(F.min("effective_from").alias("next_change"))
    made = _price_rows(before.unionByName(logs.select(*before.columns))).join(next_change, "product_id", "left")
    made = made.withColumn("effective_to", F.coalesce("effective_to", "next_change"))
    table = "product_center.price_history"
    return conform(made, table).unionByName(conform(after, table)), products


def product_price_history_stepped(t: Tables, w: BatchWindow) -> DataFrame:
    """The history of the window's products when it had been written up to
    the window, and the window was added to it."""
    logs = t["raw_data.price_change_logs"]
    written = _price_rows(logs.where(F.col("change_time") < w.lo))
    fresh = F.col("effective_to").isNull() | (F.col("effective_to") >= w.first_day)
    rows, products = price_history_step(logs, written.where(fresh), w)
    older = written.where(~fresh).join(products, "product_id", "left_semi")
    return older.unionByName(rows)


def _window_items(t: Tables, w: BatchWindow, cols: list[str]) -> DataFrame:
    """Order items of orders placed in the window, with the order day. The
    window's orders are broadcast when proven small, so the item table is
    never shuffled by order id."""
    orders = windowed(t["order_center.orders"], "order_time", w).select(
        "order_id", day("order_time").alias("date")
    )
    items = t["order_center.order_items"].select("order_id", *cols)
    return join_small(items, orders, "order_id")


def product_sales(t: Tables, w: BatchWindow) -> DataFrame:
    """Units and revenue per (day, product), with the product's all-time
    mean rating (pre-aggregated reviews, left-joined)."""
    sales = _window_items(t, w, ["product_id", "quantity", "subtotal"]).groupBy("date", "product_id").agg(
        dsum("quantity").alias("units"), dsum("subtotal").alias("revenue")
    )
    # only the products sold: one row per product, from rows already reduced
    sold = sales.select("product_id").distinct()
    ratings = t["product_center.product_reviews"].join(sold, "product_id", "left_semi").groupBy("product_id").agg(
        F.sum("rating").alias("rating_sum"), F.count("rating").alias("rating_n")
    )
    out = sales.join(ratings, "product_id", "left").select(
        "date",
        "product_id",
        unscale("units").alias("units_sold"),
        unscale("revenue").alias("revenue"),
        ratio("rating_sum", "rating_n").alias("avg_rating"),
    )
    return conform(out, "analytics.product_sales")


def category_performance(t: Tables, w: BatchWindow) -> DataFrame:
    """Sales, distinct products and item-weighted mean unit price per
    (day, category). Items are reduced to (day, product) before the product
    lookup; sums and counts re-aggregate exactly."""
    per_product = _window_items(t, w, ["product_id", "unit_price", "subtotal"]).groupBy("date", "product_id").agg(
        dsum("subtotal").alias("sales"),
        dsum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("price_n"),
    )
    products = t["product_center.products"].select("product_id", "category")
    out = (
        per_product.join(products, "product_id")
        .groupBy("date", "category")
        .agg(
            total("sales").alias("sales"),
            F.count_distinct("product_id").alias("product_count"),
            total("price_sum").alias("price_sum"),
            F.sum("price_n").alias("price_n"),
        )
        .select(
            "date",
            "category",
            unscale("sales").alias("total_sales"),
            "product_count",
            ratio(unscale("price_sum"), "price_n").alias("avg_price"),
        )
    )
    return conform(out, "analytics.category_performance")


def update_product_rating(t: Tables, w: BatchWindow) -> DataFrame:
    """Snapshot of products; those reviewed in the window get the mean of
    all their reviews as average_rating."""
    reviews = t["product_center.product_reviews"]
    touched = windowed(reviews, "review_time", w).select("product_id").distinct()
    means = (
        join_small(reviews, touched, "product_id", "left_semi")
        .groupBy("product_id")
        .agg(ratio(F.sum("rating"), F.count("rating")).alias("new_rating"))
    )
    return apply_changes(
        t["product_center.products"], means, ["product_id"], {"average_rating": F.col("new_rating")}
    )
