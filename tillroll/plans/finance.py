"""Finance jobs: revenue, expenses, profit, lifetime value, payment mix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import BatchWindow, dsum, in_window, minus, or_zero, ratio, unscale, windowed
from tillroll.operators.sizing import is_small, join_small
from tillroll.plans.loads import JOBS as _LOADS
from tillroll.sources.schemas import conform
from tillroll.sources.tables import Tables

refund_expense = _LOADS["refund_expense"]
shipping_expense = _LOADS["shipping_expense"]
marketing_expense = _LOADS["marketing_expense"]
tax_calculations = _LOADS["tax_calculations"]


def _completed_payments(t: Tables) -> DataFrame:
    return t["payment_center.payments"].where(F.col("status") == "completed")


def _revenue_rows(t: Tables, paid: DataFrame, proven: bool | None = None) -> DataFrame:
    """paid: (order_id, revenue_date) -> revenue rows with the order's
    fields. The paid side is the windowed one and is broadcast when small."""
    orders = t["order_center.orders"].select(
        "order_id", "user_id", F.col("total_amount").alias("amount"), "payment_method"
    )
    return conform(join_small(orders, paid, "order_id", proven=proven), "finance.revenue")


def revenue_recognition(t: Tables, w: BatchWindow) -> DataFrame:
    """As written: one row per completed payment in the window, booking the
    order's total at the payment time (n payments book it n times)."""
    paid = windowed(_completed_payments(t), "payment_time", w).select(
        "order_id", F.col("payment_time").alias("revenue_date")
    )
    return _revenue_rows(t, paid)


def revenue_recognition_exact(t: Tables, w: BatchWindow) -> DataFrame:
    """One row per order, at its first completed payment ever, kept only
    when that payment falls in the window."""
    payments = _completed_payments(t)
    first = F.min("payment_time").alias("revenue_date")
    paid = windowed(payments, "payment_time", w).groupBy("order_id").agg(first)
    small = is_small(paid)
    if small:
        # the window's orders are broadcast, so history is never shuffled
        paid_before = join_small(
            payments.where(F.col("payment_time") < w.lo).select("order_id"),
            paid.select("order_id"), "order_id", "left_semi", proven=True,
        )
        paid = paid.join(paid_before.distinct(), "order_id", "left_anti")
    else:
        # one read and one aggregate: semi- and anti-join by order would hold
        # their sorts in the memory of the same task
        paid = payments.where(F.col("payment_time") < w.hi).groupBy("order_id").agg(first)
        paid = paid.where(F.col("revenue_date") >= w.lo)
    # paid is a subset of the side just measured, so the bound holds for it too
    return _revenue_rows(t, paid, proven=small)


def inventory_expense(t: Tables, w: BatchWindow) -> DataFrame:
    """Cost of goods per receipt received in the window."""
    receipts = windowed(t["inventory.inventory_receipts"], "receipt_date", w).select(
        "receipt_id", "receipt_date", "supplier_id"
    )
    items = t["inventory.receipt_items"].select(
        "receipt_id", (F.col("quantity") * F.col("unit_cost")).alias("cost")
    )
    out = (
        join_small(items, receipts, "receipt_id")
        .groupBy("receipt_id", "receipt_date", "supplier_id")
        .agg(dsum("cost").alias("amount"))
        .select(
            F.col("receipt_id").cast("string").alias("expense_id"),
            F.lit("inventory").alias("expense_type"),
            unscale("amount").alias("amount"),
            F.col("receipt_date").alias("expense_date"),
            F.col("supplier_id").cast("string").alias("reference_id"),
        )
    )
    return conform(out, "finance.expenses")


def monthly_profit(t: Tables, w: BatchWindow) -> DataFrame:
    """Revenue per calendar month of the window, less that month's expenses
    (0 if none). Months with expenses but no revenue do not appear."""
    rev = (
        windowed(t["finance.revenue"], "revenue_date", w)
        .groupBy(F.month("revenue_date").alias("month"), F.year("revenue_date").alias("year"))
        .agg(dsum("amount").alias("revenue"))
    )
    exp = (
        windowed(t["finance.expenses"], "expense_date", w)
        .groupBy(F.month("expense_date").alias("month"), F.year("expense_date").alias("year"))
        .agg(dsum("amount").alias("total_expenses"))
    )
    expenses = or_zero("total_expenses")
    profit = minus("revenue", expenses)
    out = rev.join(exp, ["month", "year"], "left").select(
        "month",
        "year",
        unscale("revenue").alias("revenue"),
        unscale(expenses).alias("expenses"),
        unscale(profit).alias("profit"),
        (ratio(unscale(profit), unscale("revenue")) * 100).alias("profit_margin"),
    )
    return conform(out, "finance.profit_summary")


def customer_lifetime_value(t: Tables, w: BatchWindow) -> DataFrame:
    """All-history revenue per user, for users whose latest revenue falls in
    the window (HAVING). Only users with revenue in the window can qualify,
    so history is first cut to them by a semi-join."""
    revenue = t["finance.revenue"]
    active = windowed(revenue, "revenue_date", w).select(F.col("user_id").alias("__uid")).distinct()
    history = join_small(revenue, active, F.col("user_id").eqNullSafe(F.col("__uid")), "left_semi")
    out = (
        history.groupBy("user_id")
        .agg(
            dsum("amount").alias("total"),
            F.min("revenue_date").alias("first_purchase_date"),
            F.max("revenue_date").alias("last_purchase_date"),
            F.count_distinct("order_id").alias("purchase_count"),
        )
        .where(in_window("last_purchase_date", w))
        .select(
            "user_id",
            unscale("total").alias("total_revenue"),
            "first_purchase_date",
            "last_purchase_date",
            "purchase_count",
        )
    )
    return conform(out, "analytics.customer_ltv")


def payment_methods_summary(t: Tables, w: BatchWindow) -> DataFrame:
    out = (
        windowed(t["finance.revenue"], "revenue_date", w)
        .groupBy(
            "payment_method",
            F.month("revenue_date").alias("month"),
            F.year("revenue_date").alias("year"),
        )
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            dsum("amount").alias("total"),
            F.count("amount").alias("n_amount"),
        )
        .select(
            "payment_method",
            "transaction_count",
            unscale("total").alias("total_amount"),
            ratio(unscale("total"), "n_amount").alias("average_amount"),
            "month",
            "year",
        )
    )
    return conform(out, "analytics.payment_method_summary")
