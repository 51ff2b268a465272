"""The 29 single-table load jobs, declared as data.

Each spec: source table, target table, window column, and the output
columns in target order (target name -> source column or expression).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.window import BatchWindow
from tillroll.operators.load import LoadSpec, load, load_job
from tillroll.sources.tables import Tables

# Fixed value: the sales-tax rate the tax job applies by default, in percent.
TAX_RATE_PERCENT = 10


def _same(*names: str) -> tuple[tuple[str, str], ...]:
    return tuple((n, n) for n in names)


def tax_spec(rate_percent: int = TAX_RATE_PERCENT) -> LoadSpec:
    """The tax load at a rate in percent."""
    return LoadSpec(
        "tax_calculations", "finance.revenue", "finance.tax_records", "revenue_date",
        (("order_id", "order_id"),
         ("tax_amount", lambda _w: F.col("amount") * (rate_percent / 100)),
         ("tax_rate", lambda _w: F.lit(rate_percent)),
         ("tax_category", lambda _w: F.lit("sales_tax")),
         ("tax_date", "revenue_date")),
    )


SPECS: tuple[LoadSpec, ...] = (
    # orders
    LoadSpec(
        "order_creation", "raw_data.order_logs", "order_center.orders", "create_time",
        _same("order_id", "user_id")
        + (("order_time", "create_time"), ("total_amount", "total_price"),
           ("status", "order_status"), ("payment_method", "payment_type")),
    ),
    LoadSpec(
        "order_items", "raw_data.order_item_details", "order_center.order_items", "create_time",
        _same("order_id", "product_id", "quantity")
        + (("unit_price", "price"), ("subtotal", lambda _w: F.col("quantity") * F.col("price"))),
    ),
    LoadSpec(
        "order_payment", "raw_data.payment_logs", "payment_center.payments", "payment_time",
        _same("payment_id", "order_id", "user_id")
        + (("amount", "payment_amount"), ("payment_time", "payment_time"), ("status", "payment_status")),
    ),
    LoadSpec(
        "order_refund", "raw_data.refund_logs", "payment_center.refunds", "refund_time",
        _same("refund_id", "order_id", "payment_id")
        + (("amount", "refund_amount"), ("refund_time", "refund_time"),
           ("reason", "refund_reason"), ("status", "refund_status")),
    ),
    # products
    LoadSpec(
        "product_creation", "raw_data.product_logs", "product_center.products", "create_time",
        (("product_id", "product_id"), ("name", "product_name"), ("description", "product_description"),
         ("category", "category"), ("price", "price"), ("stock", "stock_quantity"),
         ("status", "product_status")),
    ),
    LoadSpec(
        "product_images", "raw_data.product_images", "product_center.product_images", "upload_time",
        _same("image_id", "product_id", "image_url")
        + (("is_primary", "is_main"), ("sort_order", "display_order")),
    ),
    LoadSpec(
        "product_attributes", "raw_data.product_attributes", "product_center.product_attributes", "update_time",
        (("product_id", "product_id"), ("attribute_name", "attribute_key"), ("attribute_value", "attribute_value")),
    ),
    LoadSpec(
        "product_inventory", "raw_data.inventory_logs", "inventory.product_inventory", "update_time",
        _same("product_id", "warehouse_id")
        + (("quantity", "stock_quantity"), ("last_updated", "update_time")),
    ),
    LoadSpec(
        "product_reviews", "raw_data.product_reviews", "product_center.product_reviews", "create_time",
        _same("review_id", "product_id", "user_id", "rating")
        + (("review_text", "comment"), ("review_time", "create_time")),
    ),
    # users
    LoadSpec(
        "user_registration", "raw_data.user_signup_logs", "user_center.registered_users", "create_time",
        (("user_id", "id"), ("username", "username"), ("email", "email"), ("phone", "phone_number"),
         ("register_time", "create_time"), ("status", lambda _w: F.lit(1))),
    ),
    LoadSpec(
        "user_profile", "raw_data.user_profile_updates", "user_center.user_profiles", "update_time",
        _same("user_id", "nickname") + (("avatar", "avatar_url"),) + _same("gender", "birthday", "region"),
    ),
    LoadSpec(
        "user_login", "raw_data.login_logs", "user_center.login_history", "login_time",
        _same("user_id", "login_time", "ip_address", "device_type", "app_version"),
    ),
    LoadSpec(
        "user_preferences", "raw_data.user_settings", "user_center.user_preferences", "update_time",
        (("user_id", "user_id"), ("preference_key", "preference_name"),
         ("preference_value", "preference_value"), ("last_updated", "update_time")),
    ),
    LoadSpec(
        "user_devices", "raw_data.device_registry", "user_center.user_devices", "register_time",
        _same("user_id", "device_id", "device_name")
        + (("platform", "os_type"), ("last_used", "last_login_time")),
    ),
    # inventory
    LoadSpec(
        "warehouse_creation", "raw_data.warehouse_records", "inventory.warehouses", "create_time",
        (("warehouse_id", "warehouse_id"), ("name", "warehouse_name"), ("location", "warehouse_location"),
         ("capacity", "storage_capacity"), ("status", "operational_status")),
    ),
    LoadSpec(
        "inventory_receipt", "raw_data.inventory_receipts", "inventory.inventory_receipts", "receive_date",
        _same("receipt_id", "warehouse_id", "supplier_id")
        + (("receipt_date", "receive_date"), ("total_items", "item_count")),
    ),
    LoadSpec(
        "receipt_items", "raw_data.receipt_item_details", "inventory.receipt_items", "create_time",
        _same("receipt_id", "product_id") + (("quantity", "received_quantity"), ("unit_cost", "cost_per_unit")),
    ),
    LoadSpec(
        "inventory_adjustments", "raw_data.inventory_adjustments", "inventory.inventory_adjustments",
        "adjustment_time",
        _same("adjustment_id", "warehouse_id", "product_id")
        + (("quantity_change", "quantity_delta"), ("reason", "adjustment_reason"),
           ("adjustment_time", "adjustment_time")),
    ),
    LoadSpec(
        "inventory_transfers", "raw_data.inventory_transfers", "inventory.inventory_transfers", "transfer_date",
        (("transfer_id", "transfer_id"), ("source_warehouse_id", "from_warehouse_id"),
         ("destination_warehouse_id", "to_warehouse_id"), ("transfer_date", "transfer_date"),
         ("status", "transfer_status")),
    ),
    LoadSpec(
        "transfer_items", "raw_data.transfer_item_details", "inventory.transfer_items", "create_time",
        _same("transfer_id", "product_id") + (("quantity", "transfer_quantity"),),
    ),
    # marketing
    LoadSpec(
        "campaign_creation", "raw_data.marketing_campaigns", "marketing.campaigns", "create_time",
        (("campaign_id", "campaign_id"), ("name", "campaign_name"), ("description", "campaign_description"),
         ("start_date", "start_date"), ("end_date", "end_date"), ("budget", "budget_amount"),
         ("status", "campaign_status")),
    ),
    LoadSpec(
        "campaign_channels", "raw_data.campaign_channels", "marketing.campaign_channels", "create_time",
        (("campaign_id", "campaign_id"), ("channel", "channel_name"), ("budget_allocation", "allocated_budget"),
         ("start_date", "channel_start_date"), ("end_date", "channel_end_date")),
    ),
    LoadSpec(
        "promotion_codes", "raw_data.promotion_codes", "marketing.promotion_codes", "create_time",
        (("code", "promo_code"), ("campaign_id", "campaign_id"), ("discount_type", "discount_type"),
         ("discount_value", "discount_amount"), ("start_date", "valid_from"), ("end_date", "valid_to"),
         ("usage_limit", "max_uses")),
    ),
    LoadSpec(
        "promotion_usage", "raw_data.promotion_usage_logs", "marketing.promotion_usage", "apply_time",
        (("code", "promo_code"), ("order_id", "order_id"), ("user_id", "user_id"),
         ("usage_time", "apply_time"), ("discount_amount", "discount_amount")),
    ),
    LoadSpec(
        "email_campaigns", "raw_data.email_campaigns", "marketing.email_campaigns", "send_time",
        (("campaign_id", "campaign_id"), ("subject", "email_subject"), ("content", "email_content"),
         ("sent_time", "send_time"), ("recipient_count", "recipient_count")),
    ),
    # finance: curated -> finance tables
    LoadSpec(
        "refund_expense", "payment_center.refunds", "finance.expenses", "refund_time",
        (("expense_id", lambda _w: F.col("refund_id").cast("string")), ("expense_type", lambda _w: F.lit("refund")),
         ("amount", "amount"), ("expense_date", "refund_time"),
         ("reference_id", lambda _w: F.col("order_id").cast("string"))),
        where=lambda: F.col("status") == "completed",
    ),
    LoadSpec(
        "shipping_expense", "logistics.shipments", "finance.expenses", "shipping_date",
        (("expense_id", lambda _w: F.col("shipment_id").cast("string")), ("expense_type", lambda _w: F.lit("shipping")),
         ("amount", "shipping_cost"), ("expense_date", "shipping_date"),
         ("reference_id", lambda _w: F.col("order_id").cast("string"))),
    ),
    LoadSpec(
        "marketing_expense", "marketing.campaigns", "finance.expenses", "end_date",
        (("expense_id", lambda _w: F.col("campaign_id").cast("string")), ("expense_type", lambda _w: F.lit("marketing")),
         ("amount", "budget_spent"), ("expense_date", lambda _w: F.col("end_date").cast("timestamp_ntz")),
         ("reference_id", lambda _w: F.col("channel_id").cast("string"))),
    ),
    tax_spec(),
)

SPEC_BY_NAME = {s.name: s for s in SPECS}
JOBS = {s.name: load_job(s) for s in SPECS}


def tax_calculations(tables: Tables, w: BatchWindow, rate_percent: int = TAX_RATE_PERCENT) -> DataFrame:
    """finance.revenue -> finance.tax_records at ``rate_percent``."""
    return load(tax_spec(rate_percent), tables, w)


JOBS["tax_calculations"] = tax_calculations
