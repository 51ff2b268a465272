"""Target table schemas: the column list of each INSERT, with Spark types.

Ids are BIGINT (expense ids and references are STRING because four id
domains share ``finance.expenses``); money and quantities are DOUBLE on the
way out (they are summed exactly in 1/1,000,000 units inside jobs); timestamps are
TIMESTAMP_NTZ and calendar days DATE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The column list, in order, of every table the jobs write.
TARGETS: dict[str, str] = {
    "analytics.campaign_performance": "campaign_id bigint, date date, impressions bigint, clicks bigint, conversions bigint, spend double, revenue double, roi double",
    "analytics.category_performance": "date date, category string, total_sales double, product_count bigint, avg_price double",
    "analytics.customer_ltv": "user_id bigint, total_revenue double, first_purchase_date timestamp_ntz, last_purchase_date timestamp_ntz, purchase_count bigint",
    "analytics.daily_order_summary": "date date, total_orders bigint, total_amount double, avg_order_value double, payment_method_distribution string",
    "analytics.email_performance": "campaign_id bigint, date date, emails_sent bigint, open_count bigint, click_count bigint, open_rate double, click_rate double",
    "analytics.inventory_levels": "date date, warehouse_id bigint, product_id bigint, beginning_quantity double, receipts double, sales double, adjustments double, transfers_in double, transfers_out double, ending_quantity double",
    "analytics.order_conversion": "date date, cart_additions bigint, checkout_starts bigint, orders_completed bigint, conversion_rate double",
    "analytics.payment_method_summary": "payment_method string, transaction_count bigint, total_amount double, average_amount double, month int, year int",
    "analytics.product_sales": "date date, product_id bigint, units_sold double, revenue double, avg_rating double",
    "analytics.user_acquisition": "date date, source string, new_users bigint, conversion_rate double, acquisition_cost double",
    "analytics.user_activity_summary": "user_id bigint, date date, login_count bigint, active_minutes double, feature_usage string",
    "analytics.user_order_stats": "user_id bigint, total_orders bigint, total_spent double, first_order_date date, last_order_date date, favorite_category string",
    "analytics.user_retention": "cohort_date date, days_since_signup int, user_count bigint, retention_rate double",
    "finance.expenses": "expense_id string, expense_type string, amount double, expense_date timestamp_ntz, reference_id string",
    "finance.profit_summary": "month int, year int, revenue double, expenses double, profit double, profit_margin double",
    "finance.revenue": "order_id bigint, user_id bigint, amount double, revenue_date timestamp_ntz, payment_method string",
    "finance.tax_records": "order_id bigint, tax_amount double, tax_rate int, tax_category string, tax_date timestamp_ntz",
    "inventory.inventory_adjustments": "adjustment_id bigint, warehouse_id bigint, product_id bigint, quantity_change double, reason string, adjustment_time timestamp_ntz",
    "inventory.inventory_receipts": "receipt_id bigint, warehouse_id bigint, supplier_id bigint, receipt_date timestamp_ntz, total_items bigint",
    "inventory.inventory_transfers": "transfer_id bigint, source_warehouse_id bigint, destination_warehouse_id bigint, transfer_date timestamp_ntz, status string",
    "inventory.low_stock_alerts": "product_id bigint, warehouse_id bigint, current_quantity double, threshold double, alert_date date",
    "inventory.product_inventory": "product_id bigint, warehouse_id bigint, quantity double, last_updated timestamp_ntz",
    "inventory.receipt_items": "receipt_id bigint, product_id bigint, quantity double, unit_cost double",
    "inventory.transfer_items": "transfer_id bigint, product_id bigint, quantity double",
    "inventory.warehouses": "warehouse_id bigint, name string, location string, capacity bigint, status string",
    "logistics.shipments": "shipment_id bigint, order_id bigint, shipping_address string, shipping_method string, tracking_number string, status string",
    "marketing.campaign_channels": "campaign_id bigint, channel string, budget_allocation double, start_date date, end_date date",
    "marketing.campaigns": "campaign_id bigint, name string, description string, start_date date, end_date date, budget double, status string",
    "marketing.email_campaigns": "campaign_id bigint, subject string, content string, sent_time timestamp_ntz, recipient_count bigint",
    "marketing.promotion_codes": "code string, campaign_id bigint, discount_type string, discount_value double, start_date date, end_date date, usage_limit bigint",
    "marketing.promotion_usage": "code string, order_id bigint, user_id bigint, usage_time timestamp_ntz, discount_amount double",
    "marketing.user_segments": "user_id bigint, segment_name string, added_date date, score double",
    "order_center.order_items": "order_id bigint, product_id bigint, quantity double, unit_price double, subtotal double",
    "order_center.orders": "order_id bigint, user_id bigint, order_time timestamp_ntz, total_amount double, status string, payment_method string",
    "payment_center.payments": "payment_id bigint, order_id bigint, user_id bigint, amount double, payment_time timestamp_ntz, status string",
    "payment_center.refunds": "refund_id bigint, order_id bigint, payment_id bigint, amount double, refund_time timestamp_ntz, reason string, status string",
    "product_center.price_history": "product_id bigint, price double, effective_from timestamp_ntz, effective_to timestamp_ntz, change_reason string",
    "product_center.product_attributes": "product_id bigint, attribute_name string, attribute_value string",
    "product_center.product_images": "image_id bigint, product_id bigint, image_url string, is_primary int, sort_order int",
    "product_center.product_reviews": "review_id bigint, product_id bigint, user_id bigint, rating int, review_text string, review_time timestamp_ntz",
    "product_center.products": "product_id bigint, name string, description string, category string, price double, stock bigint, status string",
    "user_center.login_history": "user_id bigint, login_time timestamp_ntz, ip_address string, device_type string, app_version string",
    "user_center.registered_users": "user_id bigint, username string, email string, phone string, register_time timestamp_ntz, status int",
    "user_center.user_devices": "user_id bigint, device_id bigint, device_name string, platform string, last_used timestamp_ntz",
    "user_center.user_preferences": "user_id bigint, preference_key string, preference_value string, last_updated timestamp_ntz",
    "user_center.user_profiles": "user_id bigint, nickname string, avatar string, gender string, birthday date, region string",
}

# Columns that jobs read or update but no INSERT loads.
EXTRA_COLUMNS: dict[str, str] = {
    "order_center.orders": "warehouse_id bigint",
    "logistics.shipments": "shipping_cost double, shipping_date timestamp_ntz, delivery_time timestamp_ntz",
    "marketing.campaigns": "budget_spent double, channel_id bigint",
    "product_center.products": "reorder_threshold double, average_rating double",
    "user_center.registered_users": "referral_source string, deletion_time timestamp_ntz",
}

# Tables that jobs maintain beside their targets, so that a run
# reads its own day and what they hold instead of all history.
STATES: dict[str, str] = {
    "inventory.stock_deductions": "product_id bigint, warehouse_id bigint, quantity double, deducted_at timestamp_ntz",
    "analytics.customer_ltv_state": "user_id bigint, total_hundredths bigint, total_rest bigint, first_purchase timestamp_ntz, last_purchase timestamp_ntz, order_ids array<bigint>, batch_day date",
    "analytics.user_product_state": "user_id bigint, order_id bigint, product_id bigint, n bigint, batch_day date",
}

# The partition columns of tables without a day of their own.
BATCH_DAY = "batch_day"
BATCH_WINDOW = "batch_window"


# The time column whose calendar day partitions each table the
# sinks write (partition column ``<column>__day``). Loaded tables not listed
# keep the day of the source's window column as ``batch_day``, and marts not
# listed are partitioned by the batch window. A column is listed only if no
# job rewrites it later (stock ``last_updated`` is, so stock is not listed).
PARTITION_TIME: dict[str, str] = {
    "order_center.orders": "order_time",
    "payment_center.payments": "payment_time",
    "payment_center.refunds": "refund_time",
    "product_center.product_reviews": "review_time",
    "product_center.price_history": "effective_from",
    "user_center.registered_users": "register_time",
    "user_center.login_history": "login_time",
    "user_center.user_preferences": "last_updated",
    "inventory.inventory_adjustments": "adjustment_time",
    "inventory.inventory_receipts": "receipt_date",
    "inventory.inventory_transfers": "transfer_date",
    "inventory.low_stock_alerts": "alert_date",
    "marketing.promotion_usage": "usage_time",
    "marketing.email_campaigns": "sent_time",
    "finance.revenue": "revenue_date",
    "finance.expenses": "expense_date",
    "finance.tax_records": "tax_date",
    "analytics.campaign_performance": "date",
    "analytics.category_performance": "date",
    "analytics.customer_ltv": "last_purchase_date",
    "analytics.daily_order_summary": "date",
    "analytics.email_performance": "date",
    "analytics.inventory_levels": "date",
    "analytics.order_conversion": "date",
    "analytics.product_sales": "date",
    "analytics.user_acquisition": "date",
    "analytics.user_activity_summary": "date",
    "analytics.user_retention": "cohort_date",
}


# Tables filled by several jobs are also partitioned by the
# column that tells the jobs apart, so one job's rerun replaces only its own
# rows (the four expense jobs all write finance.expenses).
PARTITION_BY_SOURCE: dict[str, str] = {
    "finance.expenses": "expense_type",
}


# Tables whose days are also partitioned by a hash of some
# columns, so that rows of few keys can be rewritten without the others of
# their day: partition column, key columns, number of parts.
PARTITION_BY_HASH: dict[str, tuple[str, tuple[str, ...], int]] = {
    "analytics.inventory_levels": ("pair_bucket", ("warehouse_id", "product_id"), 8),
    "product_center.price_history": ("product_bucket", ("product_id",), 8),
}


# Price rows are kept by the day that closed them, open ones
# under a day of their own, so that a batch meets them without older history.
CLOSED_DAY = "closed__day"
OPEN_DAY = "9999-12-31"


def with_bucket(df: DataFrame, table: str) -> DataFrame:
    """``df`` with its partition column by hash, if the table has one."""
    if table not in PARTITION_BY_HASH:
        return df
    part, keys, parts = PARTITION_BY_HASH[table]
    return df.withColumn(part, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))


def fields(table: str, with_extra: bool = False) -> list[tuple[str, str]]:
    ddl = TARGETS[table] if table in TARGETS else STATES[table]
    if with_extra and table in EXTRA_COLUMNS:
        ddl = ddl + ", " + EXTRA_COLUMNS[table]
    out = []
    for part in ddl.split(","):
        name, typ = part.strip().split(" ", 1)
        out.append((name, typ.strip()))
    return out


def with_extra(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the target's columns that no INSERT loads as typed NULLs,
    where it does not have them."""
    extra = [(n, t) for n, t in fields(table, with_extra=True) if n not in df.columns]
    return df.select("*", *[F.lit(None).cast(t).alias(n) for n, t in extra])


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """A known target that has not been written yet."""
    return spark.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in fields(table, with_extra=True)))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the target's columns by name, in order, cast to its types."""
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in fields(table)])
