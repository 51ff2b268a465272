"""The fixture views again, written independently as DuckDB SQL.

Only the physical tables are registered on the DuckDB side, so each oracle
statement inlines the views it needs as CTEs. Names are the logical names
with ``.`` replaced by ``__``; profile variants get their own names.
"""

from __future__ import annotations

import re

JAN = "DATE '2024-01-01'"


def jan(n: str) -> str:
    return f"({JAN} + CAST({n} AS INTEGER))"


def jan_ts(n: str) -> str:
    return f"CAST({JAN} + CAST({n} AS INTEGER) AS TIMESTAMP)"


LINE_ID = "(l_orderkey * 10 + l_linenumber)"
DONE_IF_F = "CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'pending' END"
DELIVERED_IF_A = "CASE WHEN l_returnflag = 'A' THEN 'delivered' ELSE 'in_transit' END"
PART_TS = jan_ts("p_partkey % 30")
EV_CUST = "events e JOIN customer c ON c.c_custkey = e.user_id"

VIEWS: dict[str, str] = {
    # orders and money
    "raw_data__order_logs": """SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS create_time,
        o_totalprice AS total_price, o_orderstatus AS order_status, o_orderpriority AS payment_type FROM orders""",
    "order_center__orders": """SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_time,
        o_totalprice AS total_amount,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'processing' END AS status,
        o_orderpriority AS payment_method, o_custkey % 10 AS warehouse_id FROM orders""",
    "ev_orders": """SELECT event_id AS order_id, user_id, ts AS order_time, value AS total_amount, user_id % 10 AS warehouse_id
        FROM events WHERE event_type = 'purchase'""",
    "raw_data__order_item_details": """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity,
        l_extendedprice AS price, l_shipdate AS create_time FROM lineitem""",
    "order_center__order_items": """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity,
        l_extendedprice AS unit_price, l_quantity * l_extendedprice AS subtotal FROM lineitem""",
    "prior_ledger": """SELECT DATE '1996-06-02' AS date, p_partkey % 10 AS warehouse_id, p_partkey AS product_id,
        CAST(p_size AS DOUBLE) AS ending_quantity FROM part
        UNION ALL SELECT DATE '1996-06-02', (p_partkey + 3) % 10, p_partkey, CAST(p_size AS DOUBLE) FROM part""",
    "payment_center__payments": f"""SELECT {LINE_ID} AS payment_id, l_orderkey AS order_id, o.o_custkey AS user_id,
        l_extendedprice AS amount, l_shipdate AS payment_time, {DONE_IF_F} AS status
        FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey""",
    "raw_data__payment_logs": """SELECT payment_id, order_id, user_id, amount AS payment_amount, payment_time,
        status AS payment_status FROM payment_center__payments""",
    "payment_center__refunds": f"""SELECT {LINE_ID} AS refund_id, l_orderkey AS order_id, {LINE_ID} AS payment_id,
        l_extendedprice AS amount, l_shipdate AS refund_time, l_returnflag AS reason, {DONE_IF_F} AS status
        FROM lineitem WHERE l_returnflag = 'R'""",
    "raw_data__refund_logs": """SELECT refund_id, order_id, payment_id, amount AS refund_amount, refund_time,
        reason AS refund_reason, status AS refund_status FROM payment_center__refunds""",
    "raw_data__shipping_records": f"""SELECT {LINE_ID} AS shipment_id, l_orderkey AS order_id, l_suppkey AS address_id,
        l_linestatus AS shipping_method, CAST(l_linenumber AS VARCHAR) AS tracking_number,
        {DELIVERED_IF_A} AS status, l_shipdate AS create_time FROM lineitem""",
    "logistics__shipments": f"""SELECT {LINE_ID} AS shipment_id, l_orderkey AS order_id, {DELIVERED_IF_A} AS status,
        l_extendedprice * l_tax AS shipping_cost, l_shipdate AS shipping_date, l_shipdate AS delivery_time
        FROM lineitem""",
    "user_center__user_addresses": """SELECT s.s_suppkey AS address_id, s.s_name || ', ' || n.n_name AS full_address
        FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    # products
    "raw_data__product_logs": f"""SELECT p_partkey AS product_id, p_name AS product_name,
        p_name AS product_description, p_type AS category, p_retailprice AS price, p_size AS stock_quantity,
        p_brand AS product_status, {PART_TS} AS create_time FROM part""",
    "product_center__products": """SELECT p_partkey AS product_id, p_name AS name, p_name AS description,
        p_type AS category, p_retailprice AS price, CAST(p_size AS BIGINT) AS stock, p_brand AS status,
        CAST(p_size AS DOUBLE) AS reorder_threshold, CAST(NULL AS DOUBLE) AS average_rating FROM part""",
    "raw_data__product_images": f"""SELECT p_partkey AS image_id, p_partkey AS product_id,
        'img/' || CAST(p_partkey AS VARCHAR) AS image_url, CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END AS is_main,
        p_size % 5 AS display_order, {PART_TS} AS upload_time FROM part""",
    "raw_data__product_attributes": f"""SELECT p_partkey AS product_id, 'brand' AS attribute_key,
        p_brand AS attribute_value, {PART_TS} AS update_time FROM part
        UNION ALL SELECT p_partkey, 'type', p_type, {PART_TS} FROM part""",
    "raw_data__inventory_logs": f"""SELECT p_partkey AS product_id, p_partkey % 10 AS warehouse_id,
        p_partkey % 60 AS stock_quantity, {PART_TS} AS update_time FROM part""",
    "inventory__product_inventory": f"""SELECT p_partkey AS product_id, p_partkey % 10 AS warehouse_id,
        CAST(p_partkey % 60 AS DOUBLE) AS quantity, {PART_TS} AS last_updated FROM part""",
    "raw_data__price_change_logs": """SELECT user_id AS product_id, value AS new_price, ts AS change_time,
        event_type AS change_reason FROM events""",
    "raw_data__product_reviews": """SELECT event_id AS review_id, user_id AS product_id, user_id,
        CAST(1 + event_id % 5 AS INTEGER) AS rating, props AS comment, ts AS create_time
        FROM events WHERE event_type = 'view'""",
    "product_center__product_reviews": """SELECT review_id, product_id, user_id, rating, comment AS review_text,
        create_time AS review_time FROM raw_data__product_reviews""",
    # users
    "raw_data__user_signup_logs": f"""SELECT e.user_id AS id, c.c_name AS username, c.c_name AS email,
        CAST(c.c_nationkey AS VARCHAR) AS phone_number, e.ts AS create_time
        FROM {EV_CUST} WHERE e.event_type = 'signup'""",
    "user_center__registered_users": """SELECT s.user_id, c.c_name AS username, c.c_name AS email,
        CAST(c.c_nationkey AS VARCHAR) AS phone, s.register_time, 1 AS status, c.c_mktsegment AS referral_source,
        CAST(NULL AS TIMESTAMP) AS deletion_time
        FROM (SELECT user_id, MIN(ts) AS register_time FROM events WHERE event_type = 'signup' GROUP BY user_id) s
        JOIN customer c ON c.c_custkey = s.user_id""",
    "raw_data__login_logs": """SELECT user_id, ts AS login_time, props AS ip_address, event_type AS device_type,
        '1' AS app_version FROM events WHERE event_type = 'view'""",
    "user_center__login_history": "SELECT * FROM raw_data__login_logs",
    "raw_data__user_profile_updates": f"""SELECT e.user_id, c.c_name AS nickname, c.c_name AS avatar_url,
        e.event_type AS gender, CAST(e.ts AS DATE) AS birthday, c.c_mktsegment AS region, e.ts AS update_time
        FROM {EV_CUST}""",
    "raw_data__user_settings": f"""SELECT e.user_id, e.event_type AS preference_name,
        c.c_mktsegment AS preference_value, e.ts AS update_time FROM {EV_CUST}""",
    "raw_data__device_registry": f"""SELECT e.user_id, e.event_id AS device_id, c.c_name AS device_name,
        e.event_type AS os_type, e.ts AS last_login_time, e.ts AS register_time FROM {EV_CUST}""",
    "raw_data__user_sessions": """SELECT user_id, ts AS login_time, value * 30 AS session_duration,
        event_id % 10 AS pages_visited, event_id % 5 AS actions FROM events""",
    "raw_data__account_deletion_requests": """SELECT user_id, ts AS request_time,
        CASE WHEN event_id % 2 = 0 THEN 'approved' ELSE 'pending' END AS status
        FROM events WHERE event_type = 'error'""",
    "raw_data__user_events": """SELECT user_id, ts AS event_time,
        CASE event_type WHEN 'click' THEN 'add_to_cart' WHEN 'view' THEN 'begin_checkout' ELSE event_type END
        AS event_type FROM events""",
    # marketing
    "raw_data__marketing_campaigns": f"""SELECT CAST(n_nationkey AS BIGINT) AS campaign_id,
        n_name AS campaign_name, n_name AS campaign_description, {JAN} AS start_date,
        {jan('n_nationkey')} AS end_date, CAST(1000 AS DOUBLE) AS budget_amount,
        CASE WHEN n_nationkey % 2 = 1 THEN 'active' ELSE 'draft' END AS campaign_status,
        {jan_ts('n_nationkey')} AS create_time FROM nation""",
    "marketing__campaigns": f"""SELECT CAST(n_nationkey AS BIGINT) AS campaign_id, n_name AS name,
        n_name AS description, {JAN} AS start_date, {jan('n_nationkey')} AS end_date,
        CAST(1000 AS DOUBLE) AS budget, CASE WHEN n_nationkey % 2 = 1 THEN 'active' ELSE 'draft' END AS status,
        CAST(n_nationkey * 100 AS DOUBLE) AS budget_spent, CAST(n_regionkey AS BIGINT) AS channel_id FROM nation""",
    "raw_data__campaign_channels": f"""SELECT CAST(n_nationkey AS BIGINT) AS campaign_id,
        'channel_' || CAST(n_regionkey AS VARCHAR) AS channel_name,
        CAST(n_nationkey * 100 AS DOUBLE) AS allocated_budget, {JAN} AS channel_start_date,
        {jan('n_nationkey')} AS channel_end_date, {jan_ts('n_nationkey')} AS create_time FROM nation""",
    "raw_data__promotion_codes": f"""SELECT 'PROMO' || CAST(n_nationkey AS VARCHAR) AS promo_code,
        CAST(n_nationkey AS BIGINT) AS campaign_id,
        CASE WHEN n_nationkey % 2 = 0 THEN 'percent' ELSE 'fixed' END AS discount_type,
        CAST(n_nationkey AS DOUBLE) AS discount_amount, {JAN} AS valid_from, {jan('n_nationkey')} AS valid_to,
        CAST(n_nationkey * 10 AS BIGINT) AS max_uses, {jan_ts('n_nationkey')} AS create_time FROM nation""",
    "raw_data__promotion_usage_logs": """SELECT 'PROMO' || CAST(user_id % 25 AS VARCHAR) AS promo_code,
        event_id AS order_id, user_id, ts AS apply_time, value AS discount_amount
        FROM events WHERE event_type = 'purchase'""",
    "raw_data__email_campaigns": f"""SELECT CAST(n_nationkey AS BIGINT) AS campaign_id, n_name AS email_subject,
        n_name AS email_content, {jan_ts('n_nationkey')} AS send_time,
        CAST(n_nationkey * 10 AS BIGINT) AS recipient_count FROM nation""",
    "marketing__email_campaigns": """SELECT campaign_id, email_subject AS subject, email_content AS content,
        send_time AS sent_time, recipient_count FROM raw_data__email_campaigns""",
    "raw_data__email_events": """SELECT user_id % 25 AS campaign_id, user_id,
        CASE WHEN event_type = 'view' THEN 'open' ELSE event_type END AS event_type FROM events""",
    "raw_data__marketing_metrics": f"""SELECT e.user_id % 25 AS campaign_id, e.user_id, e.ts AS event_date,
        CASE WHEN e.event_type = 'view' THEN 'impression' ELSE e.event_type END AS event_type,
        CAST(1 AS BIGINT) AS event_count, e.value AS cost, c.c_mktsegment AS source
        FROM {EV_CUST} WHERE e.event_type IN ('view', 'click')""",
    # inventory
    "raw_data__warehouse_records": f"""SELECT s_suppkey AS warehouse_id, s_name AS warehouse_name,
        CAST(s_nationkey AS VARCHAR) AS warehouse_location, CAST(1000 AS BIGINT) AS storage_capacity,
        'open' AS operational_status, {jan_ts('s_suppkey')} AS create_time FROM supplier""",
    "inventory__warehouses": """SELECT warehouse_id, warehouse_name AS name, warehouse_location AS location,
        storage_capacity AS capacity, operational_status AS status FROM raw_data__warehouse_records""",
    "raw_data__inventory_receipts": """SELECT o_orderkey AS receipt_id, o_custkey % 10 AS warehouse_id,
        o_custkey AS supplier_id, o_orderdate AS receive_date, o_orderkey % 7 AS item_count FROM orders""",
    "inventory__inventory_receipts": """SELECT receipt_id, warehouse_id, supplier_id, receive_date AS receipt_date,
        item_count AS total_items FROM raw_data__inventory_receipts""",
    "raw_data__receipt_item_details": """SELECT l_orderkey AS receipt_id, l_partkey AS product_id,
        l_quantity AS received_quantity, l_extendedprice AS cost_per_unit, l_shipdate AS create_time
        FROM lineitem""",
    "inventory__receipt_items": """SELECT l_orderkey AS receipt_id, l_partkey AS product_id, l_quantity AS quantity,
        l_extendedprice AS unit_cost FROM lineitem""",
    "raw_data__inventory_adjustments": f"""SELECT {LINE_ID} AS adjustment_id, l_suppkey % 10 AS warehouse_id,
        l_partkey AS product_id, l_quantity - 25 AS quantity_delta, l_linestatus AS adjustment_reason,
        l_shipdate AS adjustment_time FROM lineitem""",
    "inventory__inventory_adjustments": """SELECT adjustment_id, warehouse_id, product_id,
        quantity_delta AS quantity_change, adjustment_reason AS reason, adjustment_time
        FROM raw_data__inventory_adjustments""",
    "raw_data__inventory_transfers": """SELECT o_orderkey AS transfer_id, o_custkey % 10 AS from_warehouse_id,
        (o_custkey + 3) % 10 AS to_warehouse_id, o_orderdate AS transfer_date, o_orderstatus AS transfer_status
        FROM orders""",
    "inventory__inventory_transfers": """SELECT transfer_id, from_warehouse_id AS source_warehouse_id,
        to_warehouse_id AS destination_warehouse_id, transfer_date, transfer_status AS status
        FROM raw_data__inventory_transfers""",
    "raw_data__transfer_item_details": """SELECT l_orderkey AS transfer_id, l_partkey AS product_id,
        l_quantity AS transfer_quantity, l_shipdate AS create_time FROM lineitem""",
    "inventory__transfer_items": """SELECT transfer_id, product_id, transfer_quantity AS quantity
        FROM raw_data__transfer_item_details""",
    "inventory__low_stock_alerts": """SELECT user_id AS product_id, user_id % 10 AS warehouse_id,
        CAST(ts AS DATE) AS alert_date FROM events WHERE event_type = 'error'""",
    # tables other jobs fill, over all history
    "finance__revenue": """SELECT o.order_id, o.user_id, o.total_amount AS amount, p.payment_time AS revenue_date,
        o.payment_method FROM order_center__orders o JOIN payment_center__payments p ON o.order_id = p.order_id
        WHERE p.status = 'completed'""",
    "finance__expenses": """SELECT CAST(refund_id AS VARCHAR) AS expense_id, 'refund' AS expense_type, amount,
            refund_time AS expense_date, CAST(order_id AS VARCHAR) AS reference_id
            FROM payment_center__refunds WHERE status = 'completed'
        UNION ALL SELECT CAST(shipment_id AS VARCHAR), 'shipping', shipping_cost, shipping_date,
            CAST(order_id AS VARCHAR) FROM logistics__shipments
        UNION ALL SELECT CAST(r.receipt_id AS VARCHAR), 'inventory',
            CAST(SUM(CAST(i.quantity * i.unit_cost AS DECIMAL(38,6))) AS DOUBLE), r.receipt_date,
            CAST(r.supplier_id AS VARCHAR)
            FROM inventory__inventory_receipts r JOIN inventory__receipt_items i ON i.receipt_id = r.receipt_id
            GROUP BY r.receipt_id, r.receipt_date, r.supplier_id
        UNION ALL SELECT CAST(campaign_id AS VARCHAR), 'marketing', budget_spent, CAST(end_date AS TIMESTAMP),
            CAST(channel_id AS VARCHAR) FROM marketing__campaigns""",
    "analytics__user_activity_summary": """SELECT user_id, CAST(login_time AS DATE) AS date,
        CAST(SUM(CAST(session_duration AS DECIMAL(38,6))) AS DOUBLE) / 60 AS active_minutes
        FROM raw_data__user_sessions GROUP BY user_id, CAST(login_time AS DATE)""",
}

_NAME = re.compile(r"\b[a-z_]+__[a-z_]+\b|\b(?:ev_orders|prior_ledger)\b")


def _deps(sql: str) -> list[str]:
    return [m for m in dict.fromkeys(_NAME.findall(sql)) if m in VIEWS]


def with_views(body: str) -> str:
    """Prefix ``body`` with CTEs for every view it (transitively) uses.

    ``body`` may start with its own ``WITH``; its CTEs follow the views."""
    order: list[str] = []

    def visit(name: str, seen: set[str]) -> None:
        if name in order or name in seen:
            return
        seen.add(name)
        for dep in _deps(VIEWS[name]):
            visit(dep, seen)
        order.append(name)

    for name in _deps(body):
        visit(name, set())
    ctes = [f"{n} AS ({VIEWS[n]})" for n in order]
    stripped = body.strip()
    if stripped[:4].upper() == "WITH":
        return "WITH " + ",\n".join(ctes + [stripped[4:].strip()]) if ctes else stripped
    return ("WITH " + ",\n".join(ctes) + "\n" + stripped) if ctes else stripped
