"""Every job by name, with the fixture window and profile it is checked on.

Names are the reference job names without ``process_``, plus ``_exact``
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillroll.functions.window import BatchWindow
from tillroll.plans import finance, inventory, loads, marketing, orders, products, states, users
from tillroll.sources.tables import Tables

# The fixture test windows (FIXTURES.md section 3).
AS_OF = "2024-01-30"
W_ORD = BatchWindow("1996-01-01", "1997-01-01", AS_OF)
W_LEDGER = BatchWindow("1996-06-03", "1996-07-03", AS_OF)
W_EVT = BatchWindow("2024-01-08", "2024-01-15", AS_OF)
W_COHORT = BatchWindow("2024-01-01", "2024-01-05", AS_OF)
W_JANUARY = BatchWindow("2024-01-01", "2024-02-01", AS_OF)
# lifetime value reports users whose latest revenue falls in the window, so it
# is checked on the last year of the order history
W_LAST_YEAR = BatchWindow("2001-01-01", "2002-01-01", AS_OF)


@dataclass(frozen=True)
class Job:
    name: str
    fn: Callable[[Tables, BatchWindow], DataFrame]
    window: BatchWindow
    profile: str = "default"
    kind: str = "insert"  # insert | update | view (of stored tables)

    @property
    def target(self) -> str:
        """The table the job writes (INSERT INTO / UPDATE)."""
        return TARGET[self.name.removesuffix("_exact").removesuffix("_carried").removesuffix("_repaired").removesuffix("_merged").removesuffix("_stepped")]


def _load(name: str, window: BatchWindow, profile: str = "default") -> Job:
    return Job(name, loads.JOBS[name], window, profile)


# The target table of every non-load job.
TARGET: dict[str, str] = {
    **{spec.name: spec.target for spec in loads.SPECS},
    "order_shipping": "logistics.shipments",
    "daily_order_summary": "analytics.daily_order_summary",
    "user_order_stats": "analytics.user_order_stats",
    "order_conversion": "analytics.order_conversion",
    "update_order_status": "order_center.orders",
    "revenue_recognition": "finance.revenue",
    "inventory_expense": "finance.expenses",
    "monthly_profit": "finance.profit_summary",
    "customer_lifetime_value": "analytics.customer_ltv",
    "payment_methods_summary": "analytics.payment_method_summary",
    "inventory_levels": "analytics.inventory_levels",
    "low_stock_alerts": "inventory.low_stock_alerts",
    "update_inventory_after_order": "inventory.product_inventory",
    "stock_after_days": "inventory.product_inventory",
    "email_metrics": "analytics.email_performance",
    "campaign_performance": "analytics.campaign_performance",
    "user_acquisition": "analytics.user_acquisition",
    "update_campaign_status": "marketing.campaigns",
    "product_price_history": "product_center.price_history",
    "product_sales": "analytics.product_sales",
    "category_performance": "analytics.category_performance",
    "update_product_rating": "product_center.products",
    "user_activity": "analytics.user_activity_summary",
    "user_retention": "analytics.user_retention",
    "user_segments": "marketing.user_segments",
    "user_deletion": "user_center.registered_users",
}

# jobs that read the table they write (the sink cuts lineage first)
READS_OWN_TARGET = {"low_stock_alerts", "inventory_levels", "inventory_levels_carried"}

# updates that must not be applied twice: what a window takes is written to a
# table of its own (its name, and the job that gives its rows)
RECORDED_AS = {"update_inventory_after_order": ("inventory.stock_deductions", inventory.stock_deductions)}

# jobs whose rows are those of today (``as_of``), added to the day's rows
ADDS_TO_TODAY = {"low_stock_alerts"}

# The source value of jobs that share a table with others.
SOURCE_OF = {
    "refund_expense": "refund",
    "shipping_expense": "shipping",
    "marketing_expense": "marketing",
    "inventory_expense": "inventory",
}


JOBS: tuple[Job, ...] = (
    # orders
    _load("order_creation", W_ORD),
    _load("order_items", W_ORD),
    _load("order_payment", W_ORD),
    Job("order_shipping", orders.order_shipping, W_ORD),
    _load("order_refund", W_ORD),
    Job("daily_order_summary", orders.daily_order_summary, W_ORD),
    Job("user_order_stats", orders.user_order_stats, W_ORD),
    # the same statement from maintained state
    Job("user_order_stats_merged", states.user_order_stats_merged, W_ORD, kind="view"),
    Job("order_conversion", orders.order_conversion, W_EVT, "events"),
    Job("order_conversion_exact", orders.order_conversion_exact, W_EVT, "events"),
    Job("update_order_status", orders.update_order_status, W_ORD, kind="update"),
    # finance
    Job("revenue_recognition", finance.revenue_recognition, W_ORD),
    Job("revenue_recognition_exact", finance.revenue_recognition_exact, W_ORD),
    _load("refund_expense", W_ORD),
    _load("shipping_expense", W_ORD),
    Job("inventory_expense", finance.inventory_expense, W_ORD),
    _load("marketing_expense", W_EVT),
    Job("monthly_profit", finance.monthly_profit, W_ORD),
    Job("customer_lifetime_value", finance.customer_lifetime_value, W_LAST_YEAR),
    Job("customer_lifetime_value_merged", states.customer_lifetime_value_merged, W_LAST_YEAR, kind="view"),
    _load("tax_calculations", W_ORD),
    Job("payment_methods_summary", finance.payment_methods_summary, W_ORD),
    # inventory
    _load("warehouse_creation", W_EVT),
    _load("inventory_receipt", W_ORD),
    _load("receipt_items", W_ORD),
    _load("inventory_adjustments", W_ORD),
    _load("inventory_transfers", W_ORD),
    _load("transfer_items", W_ORD),
    Job("inventory_levels", inventory.inventory_levels, W_LEDGER),
    # the same job on a day after the first: a ledger with carried balances
    Job("inventory_levels_carried", inventory.inventory_levels, W_LEDGER, "carried"),
    # a rerun of one day and the repair of those behind it
    Job("inventory_levels_repaired", inventory.inventory_levels_repaired, W_LEDGER, kind="view"),
    Job("low_stock_alerts", inventory.low_stock_alerts, W_EVT),
    Job("update_inventory_after_order", inventory.update_inventory_after_order, W_ORD, kind="update"),
    # stock as readers see it: loaded rows less the deductions that are due
    Job("stock_after_days", inventory.stock_after_days, W_EVT, "events", kind="view"),
    # marketing
    _load("campaign_creation", W_EVT),
    _load("campaign_channels", W_EVT),
    _load("promotion_codes", W_EVT),
    _load("promotion_usage", W_EVT),
    _load("email_campaigns", W_EVT),
    Job("email_metrics", marketing.email_metrics, W_JANUARY),
    Job("campaign_performance", marketing.campaign_performance, W_EVT, "events"),
    Job("campaign_performance_exact", marketing.campaign_performance_exact, W_EVT, "events"),
    Job("user_acquisition", marketing.user_acquisition, W_COHORT, "events"),
    Job("user_acquisition_exact", marketing.user_acquisition_exact, W_COHORT, "events"),
    Job("update_campaign_status", marketing.update_campaign_status, W_EVT, kind="update"),
    # products
    _load("product_creation", W_EVT),
    _load("product_images", W_EVT),
    _load("product_attributes", W_EVT),
    _load("product_inventory", W_EVT),
    Job("product_price_history", products.product_price_history, W_EVT),
    Job("product_price_history_exact", products.product_price_history_exact, W_EVT),
    Job("product_price_history_stepped", products.product_price_history_stepped, W_EVT, kind="view"),
    _load("product_reviews", W_EVT),
    Job("product_sales", products.product_sales, W_ORD),
    Job("category_performance", products.category_performance, W_ORD),
    Job("update_product_rating", products.update_product_rating, W_EVT, kind="update"),
    # users
    _load("user_registration", W_EVT),
    _load("user_profile", W_EVT),
    _load("user_login", W_EVT),
    Job("user_activity", users.user_activity, W_EVT),
    Job("user_retention", users.user_retention, W_COHORT),
    Job("user_segments", users.user_segments, W_EVT),
    _load("user_preferences", W_EVT),
    _load("user_devices", W_EVT),
    Job("user_deletion", users.user_deletion, W_EVT, kind="update"),
)

BY_NAME: dict[str, Job] = {j.name: j for j in JOBS}
