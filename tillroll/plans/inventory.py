"""Inventory jobs: the daily stock ledger, low-stock alerts, stock update."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import BatchWindow, Limbs, day, dsum, exact, in_window, minus, or_zero, plus, running, since, total, unscale, windowed
from tillroll.operators.changes import apply_changes
from tillroll.operators.sizing import join_small
from tillroll.sources.schemas import BATCH_WINDOW, conform
from tillroll.sources.tables import Tables

# Fixed value: an alert suppresses new alerts for the same stock this long.
ALERT_COOLDOWN_DAYS = 7

MOVES = ("receipts", "sales", "adjustments", "transfers_in", "transfers_out")
PAIR = ["warehouse_id", "product_id"]


def _rows(df: DataFrame, kind: Column, quantity: str) -> DataFrame:
    """(warehouse, product, date, kind, hundredths, rest) rows."""
    return df.select(*PAIR, "date", kind.alias("kind"), exact(quantity).alias("q")).select(*PAIR, "date", "kind", "q.hundredths", "q.rest")


def _item_moves(t: Tables, w: BatchWindow) -> DataFrame:
    """Receipt, sale and transfer items of the window's headers. Headers of
    the three kinds meet their items in one join, on (kind, id)."""

    def headers(table: str, time: str, key: str, source: str, target: str | None = None) -> DataFrame:
        to = F.lit(None).cast("long") if target is None else F.col(target)
        return windowed(t[table], time, w).select(
            F.lit(table).alias("kind"), F.col(key).alias("id"), F.col(source).alias("warehouse"), to.alias("to_warehouse"), day(time).alias("date")
        )

    def items(table: str, header: str, key: str) -> DataFrame:
        return t[table].select(F.lit(header).alias("kind"), F.col(key).alias("id"), "product_id", "quantity")

    receipts, orders, transfers = "inventory.inventory_receipts", "order_center.orders", "inventory.inventory_transfers"
    heads = (
        headers(receipts, "receipt_date", "receipt_id", "warehouse_id")
        .unionByName(headers(orders, "order_time", "order_id", "warehouse_id"))
        .unionByName(headers(transfers, "transfer_date", "transfer_id", "source_warehouse_id", "destination_warehouse_id"))
    )
    lines = (
        items("inventory.receipt_items", receipts, "receipt_id")
        .unionByName(items("order_center.order_items", orders, "order_id"))
        .unionByName(items("inventory.transfer_items", transfers, "transfer_id"))
    )
    met = join_small(lines, heads, ["kind", "id"])

    def leg(warehouse: str, move: str):
        return F.struct(F.col(warehouse).alias("warehouse_id"), F.lit(move).alias("move"))

    # a transfer is an inbound row at its target and an outbound at its source
    legs = (
        F.when(F.col("kind") == receipts, F.array(leg("warehouse", "receipts")))
        .when(F.col("kind") == orders, F.array(leg("warehouse", "sales")))
        .otherwise(F.array(leg("to_warehouse", "transfers_in"), leg("warehouse", "transfers_out")))
    )
    rows = met.select("product_id", "date", "quantity", F.inline(legs))
    return _rows(rows, F.col("move"), "quantity")


def inventory_levels(t: Tables, w: BatchWindow) -> DataFrame:
    """Daily stock ledger over the window's days.

    ending = beginning + receipts - sales + adjustments + transfers_in -
    transfers_out, and a day's beginning is the previous day's ending (the
    prior ledger for the window's first day, else 0).

    Rows: every (warehouse, product) pair of the warehouse and product
    tables that is stocked (``inventory.product_inventory``), carried in the
    prior ledger, or moved in the window, from the first of those days to the
    window's last day. Pairs never stocked or moved are zero throughout and
    are not materialised: the warehouses x products grid is a Cartesian
    product, and the ledger never builds it.

    One relation holds movements, carried balances and stocked pairs. It is
    reduced to one row per (pair, day), so no pair is hot after it, and cut
    to known warehouses and products once. The running balance and the next
    day with a row come from one window per pair, and the days in between are
    spun out of the row before them.
    """
    first, last = w.first_day, w.last_day
    adjustments = windowed(t["inventory.inventory_adjustments"], "adjustment_time", w).select(
        *PAIR, day("adjustment_time").alias("date"), "quantity_change"
    )
    prior = windowed(t["analytics.inventory_levels"], "date", BatchWindow.days_before(w, 1)).select(*PAIR, first.alias("date"), "ending_quantity")
    stocked = t["inventory.product_inventory"].select(*PAIR, first.alias("date"))
    rows = (
        _item_moves(t, w)
        .unionByName(_rows(adjustments, F.lit("adjustments"), "quantity_change"))
        .unionByName(_rows(prior, F.lit("carried"), "ending_quantity"))
        .unionByName(_rows(stocked, F.lit("stocked"), "0D"))
    )

    def of(m: str):
        own = Limbs(*[f"CASE WHEN kind = '{m}' THEN {x} END" for x in Limbs._fields])
        return or_zero(total(own)).alias(m)

    per_day = rows.groupBy(*PAIR, "date").agg(*[of(m) for m in (*MOVES, "carried")])
    # semi-joins ignore duplicate keys, so the dimension ids need no distinct;
    # the last one leaves the rows partitioned by product, which the window
    # per pair needs no further exchange for
    per_day = per_day.join(t["inventory.warehouses"].select("warehouse_id"), "warehouse_id", "left_semi")
    per_day = per_day.join(t["product_center.products"].select("product_id"), "product_id", "left_semi")
    net = minus(plus("receipts", "adjustments", "transfers_in"), "sales", "transfers_out")
    by_day = Window.partitionBy(*PAIR).orderBy("date")
    upto = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    balances = per_day.withColumn("net", net.column).select(
        "*", running(plus("carried", "net"), upto).alias("ending"), F.lead("date").over(by_day).alias("next")
    )
    days = F.sequence("date", F.coalesce(F.date_sub("next", 1), last))
    plain = balances.select(
        *PAIR, "date", "next", *[unscale(m).alias(m) for m in MOVES], unscale(minus("ending", "net")).alias("begun"), unscale("ending").alias("ending")
    )
    spun = plain.select(*PAIR, *MOVES, "begun", "ending", F.posexplode(days).alias("gap", "day"))
    moved = F.col("gap") == 0
    out = spun.select(
        F.col("day").alias("date"),
        *PAIR,
        F.when(moved, F.col("begun")).otherwise(F.col("ending")).alias("beginning_quantity"),
        *[F.when(moved, F.col(m)).otherwise(0.0).alias(m) for m in MOVES],
        F.col("ending").alias("ending_quantity"),
    )
    return conform(out, "analytics.inventory_levels")


def broken_pairs(after: DataFrame, boundary: DataFrame) -> DataFrame:
    """Pairs whose balance does not go on from one ledger day to the next:
    (warehouse, product, base, known). ``after`` is the day that was
    rewritten, ``boundary`` the day behind it; base is the rewritten ending in
    limbs, and ``known`` says that the pair has a row on the rewritten day.

    A row behind it that carries a balance on which nothing rests any more is
    broken too; one that starts from zero is not."""
    own = after.select(*PAIR, exact("ending_quantity").alias("base"))
    behind = boundary.select(*PAIR, exact("beginning_quantity").alias("begun"))
    met = own.join(behind, PAIR, "full_outer")
    known, there = F.col("base").isNotNull(), F.col("begun").isNotNull()
    none = exact("0D").column
    broken = F.when(known & there, F.col("base") != F.col("begun")).when(known, True).otherwise(F.col("begun") != none)
    return met.where(broken).select(*PAIR, F.coalesce("base", none).alias("base"), known.alias("known"))


def repaired_rows(changed: DataFrame, later: DataFrame, days: list[dt.date], proven: bool | None = None) -> DataFrame:
    """The ledger rows of the ``changed`` pairs (``broken_pairs``) on the
    consecutive ``days`` behind the rewritten one, from their movements in
    ``later``: a row a day from the first day the pair is known or moved.
    ``proven`` as in ``join_small``."""
    grid = changed.withColumn("date", F.explode(F.array(*[F.lit(d) for d in days])))
    rows = later.select(*PAIR, "date", *MOVES)
    met = join_small(rows, changed.select(*PAIR), PAIR, "left_semi", proven=proven)
    full = grid.join(met, [*PAIR, "date"], "left")
    full = full.select(*PAIR, "date", "base", "known", *[F.coalesce(m, F.lit(0.0)).alias(m) for m in MOVES])
    moves = {m: exact(m) for m in MOVES}
    net = minus(plus(moves["receipts"], moves["adjustments"], moves["transfers_in"]), moves["sales"], moves["transfers_out"])
    upto = Window.partitionBy(*PAIR).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = full.withColumn("net", net.column).withColumn("sum", running("net", upto))
    moved = F.lit(False)
    for m in MOVES:
        moved = moved | (F.col(m) != 0)
    full = full.withColumn("ending", plus("base", "sum").column).withColumn("begun", F.max(moved).over(upto))
    out = full.where(F.col("known") | F.col("begun")).select(
        "date", *PAIR, unscale(minus("ending", "net")).alias("beginning_quantity"), *MOVES, unscale("ending").alias("ending_quantity")
    )
    return conform(out, "analytics.inventory_levels")


def inventory_levels_repaired(t: Tables, w: BatchWindow) -> DataFrame:
    """The ledger of ``w`` after its first day was run again: it had been
    chained over all days while the first day's adjustments were missing, then
    only that day was rerun, and the days behind it repaired."""
    first = dt.date.fromisoformat(w.date[:10])
    days = [first + dt.timedelta(days=i) for i in range(1, (dt.date.fromisoformat(w.date_next[:10]) - first).days)]
    rerun = BatchWindow(w.date, days[0].isoformat(), w.as_of)
    late = ~in_window("adjustment_time", rerun)
    stale = inventory_levels(t.override(inventory__inventory_adjustments=t["inventory.inventory_adjustments"].where(late)), w)
    after, later = inventory_levels(t, rerun), stale.where(F.col("date") > F.lit(first))
    changed = broken_pairs(after, later.where(F.col("date") == F.lit(days[0])))
    kept = later.join(changed, PAIR, "left_anti")
    return after.unionByName(kept).unionByName(repaired_rows(changed, later, days, proven=False))


def low_stock_alerts(t: Tables, w: BatchWindow) -> DataFrame:
    """Stock at or below its product's reorder threshold, unless the same
    (product, warehouse) was alerted in the last seven days."""
    stock = stock_tables(t).select("product_id", "warehouse_id", "quantity")
    products = t["product_center.products"].select("product_id", "reorder_threshold")
    low = stock.join(products, "product_id").where(F.col("quantity") <= F.col("reorder_threshold"))
    recent = (
        since(t["inventory.low_stock_alerts"], "alert_date", F.date_sub(w.today, ALERT_COOLDOWN_DAYS))
        .select("product_id", "warehouse_id")
    )
    out = low.join(recent, ["product_id", "warehouse_id"], "left_anti").select(
        "product_id",
        "warehouse_id",
        F.col("quantity").alias("current_quantity"),
        F.col("reorder_threshold").alias("threshold"),
        w.today.alias("alert_date"),
    )
    return conform(out, "inventory.low_stock_alerts")


def _sold(t: Tables, w: BatchWindow) -> DataFrame:
    """Quantity of the window's completed orders per (product, order
    warehouse), in limbs."""
    orders = (
        windowed(t["order_center.orders"], "order_time", w)
        .where(F.col("status") == "completed")
        .select("order_id", "warehouse_id")
    )
    items = t["order_center.order_items"].select("order_id", "product_id", "quantity")
    return join_small(items, orders, "order_id").groupBy("product_id", "warehouse_id").agg(dsum("quantity").alias("sold"))


def update_inventory_after_order(t: Tables, w: BatchWindow) -> DataFrame:
    """The statement itself, once: the stock rows of ``t`` with the window's
    completed orders deducted per (product, order warehouse). Repeating it
    would deduct twice; tables that the sinks write keep the deductions apart
    instead (``stock_deductions``, ``stock_on_hand``)."""
    changes = {"quantity": unscale(minus(exact("quantity"), "sold")), "last_updated": w.now}
    return apply_changes(t["inventory.product_inventory"], _sold(t, w), PAIR, changes)


def stock_deductions(t: Tables, w: BatchWindow) -> DataFrame:
    """What the window takes from each (product, warehouse): a row per pair
    sold, which a rerun replaces. Stock rows are not touched."""
    out = _sold(t, w).select("product_id", "warehouse_id", unscale("sold").alias("quantity"), w.now.alias("deducted_at"))
    return conform(out.where("product_id is not null and warehouse_id is not null"), "inventory.stock_deductions")


def stock_on_hand(stock: DataFrame, deductions: DataFrame) -> DataFrame:
    """``stock`` as loaded, less the deductions that are due.

    ``last_updated`` of a loaded row is its watermark: it was measured then,
    so it already lacks what was sold before, and only windows that end after
    it are due (those that end at that instant or earlier are not, whenever
    they are run or rerun). A row without it has every window deducted. The
    result is therefore the same for any order of loads, updates and reruns;
    ``last_updated`` becomes the instant of the latest deduction due.

    ``deductions`` has product_id, warehouse_id, quantity, deducted_at and
    the window's end ``until``. Rows and deductions of a pair meet in one
    running sum, latest first: a pair has a row per load and per window, and
    no load x window pairs are built."""
    row = F.struct(*[F.col(c) for c in stock.columns])
    none = F.lit(None)
    loaded = stock.select(*PAIR, F.col("last_updated").alias("at"), F.lit(0).alias("late"), none.cast("double").alias("taken"), none.cast("timestamp_ntz").alias("taken_at"), row.alias("row"))
    taken = deductions.select(*PAIR, F.col("until").alias("at"), F.lit(1).alias("late"), F.col("quantity").alias("taken"), F.col("deducted_at").alias("taken_at"), none.cast(loaded.schema["row"].dataType).alias("row"))
    # at equal instants the row comes first: a window that ends as the stock
    # is measured is not due
    latest_first = Window.partitionBy(*PAIR).orderBy(F.col("at").desc_nulls_last(), "late").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = loaded.unionByName(taken.where("product_id is not null and warehouse_id is not null"))
    due = met.withColumn("taken", exact("taken").column).withColumn("due", running("taken", latest_first)).withColumn("due_at", F.max("taken_at").over(latest_first))
    rows = due.where(F.col("row").isNotNull())
    changed = {"quantity": unscale(minus(exact("row.quantity"), or_zero("due"))), "last_updated": F.coalesce("due_at", "row.last_updated")}
    return rows.select(*[changed.get(c, F.col(f"row.{c}")).alias(c) for c in stock.columns])


def stock_tables(t: Tables) -> DataFrame:
    """The stock rows of ``t``, with the deductions the sinks have recorded."""
    stock = t["inventory.product_inventory"]
    if "inventory.stock_deductions" not in t:
        return stock
    deductions = t["inventory.stock_deductions"]
    if BATCH_WINDOW not in deductions.columns:  # none recorded yet
        return stock
    until = F.split(BATCH_WINDOW, "_").getItem(1).cast("timestamp_ntz")
    return stock_on_hand(stock, deductions.withColumn("until", until))


def stock_after_days(t: Tables, w: BatchWindow) -> DataFrame:
    """Stock on hand after the updates of each day of ``w``, run one by one
    (in whatever order): loaded rows and a deduction per pair and day."""
    day_end = F.date_add(day("order_time"), 1).cast("timestamp_ntz").alias("until")
    orders = windowed(t["order_center.orders"], "order_time", w).where(F.col("status") == "completed").select("order_id", "warehouse_id", day_end)
    items = t["order_center.order_items"].select("order_id", "product_id", "quantity")
    sold = join_small(items, orders, "order_id").groupBy(*PAIR, "until").agg(dsum("quantity").alias("sold"))
    deductions = sold.select(*PAIR, "until", unscale("sold").alias("quantity"), w.now.alias("deducted_at"))
    return conform(stock_on_hand(t["inventory.product_inventory"], deductions), "inventory.product_inventory")
