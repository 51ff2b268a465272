"""One DuckDB statement per registered job, written from the SQL meaning.

Statements follow the as-written reference queries where DuckDB can run them
(fan-out joins included), so they check the Spark jobs' fan-out-free
re-weighting. Every computed column is cast to the Spark output type; money
is summed as DECIMAL(38,6) and ratios divide DOUBLEs, as the jobs do.
"""

from __future__ import annotations

import datetime as dt

from oracle.views import with_views
from tillroll.plans.registry import AS_OF, W_COHORT, W_EVT, W_JANUARY, W_LAST_YEAR, W_LEDGER, W_ORD

D = "DECIMAL(38,6)"


def _ts(s: str) -> str:
    return f"TIMESTAMP '{s} 00:00:00'"


def win(col: str, w) -> str:
    return f"{col} >= {_ts(w.date)} AND {col} < {_ts(w.date_next)}"


def dsum(expr: str) -> str:
    return f"SUM(CAST({expr} AS {D}))"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def div(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0)"


TODAY = f"DATE '{AS_OF}'"
NOW = _ts(AS_OF)
COOLDOWN_START = (dt.date.fromisoformat(AS_OF) - dt.timedelta(days=7)).isoformat()


def _load(view: str, time_col: str, w, cols: str, where: str = "") -> str:
    extra = f" AND {where}" if where else ""
    return f"SELECT {cols} FROM {view} WHERE {win(time_col, w)}{extra}"


LOADS = {
    "order_creation": _load(
        "raw_data__order_logs", "create_time", W_ORD,
        "order_id, user_id, create_time AS order_time, total_price AS total_amount, order_status AS status, "
        "payment_type AS payment_method"),
    "order_items": _load(
        "raw_data__order_item_details", "create_time", W_ORD,
        "order_id, product_id, quantity, price AS unit_price, quantity * price AS subtotal"),
    "order_payment": _load(
        "raw_data__payment_logs", "payment_time", W_ORD,
        "payment_id, order_id, user_id, payment_amount AS amount, payment_time, payment_status AS status"),
    "order_refund": _load(
        "raw_data__refund_logs", "refund_time", W_ORD,
        "refund_id, order_id, payment_id, refund_amount AS amount, refund_time, refund_reason AS reason, "
        "refund_status AS status"),
    "product_creation": _load(
        "raw_data__product_logs", "create_time", W_EVT,
        "product_id, product_name AS name, product_description AS description, category, price, "
        "CAST(stock_quantity AS BIGINT) AS stock, product_status AS status"),
    "product_images": _load(
        "raw_data__product_images", "upload_time", W_EVT,
        "image_id, product_id, image_url, is_main AS is_primary, display_order AS sort_order"),
    "product_attributes": _load(
        "raw_data__product_attributes", "update_time", W_EVT,
        "product_id, attribute_key AS attribute_name, attribute_value"),
    "product_inventory": _load(
        "raw_data__inventory_logs", "update_time", W_EVT,
        "product_id, warehouse_id, CAST(stock_quantity AS DOUBLE) AS quantity, update_time AS last_updated"),
    "product_reviews": _load(
        "raw_data__product_reviews", "create_time", W_EVT,
        "review_id, product_id, user_id, rating, comment AS review_text, create_time AS review_time"),
    "user_registration": _load(
        "raw_data__user_signup_logs", "create_time", W_EVT,
        "id AS user_id, username, email, phone_number AS phone, create_time AS register_time, 1 AS status"),
    "user_profile": _load(
        "raw_data__user_profile_updates", "update_time", W_EVT,
        "user_id, nickname, avatar_url AS avatar, gender, birthday, region"),
    "user_login": _load(
        "raw_data__login_logs", "login_time", W_EVT,
        "user_id, login_time, ip_address, device_type, app_version"),
    "user_preferences": _load(
        "raw_data__user_settings", "update_time", W_EVT,
        "user_id, preference_name AS preference_key, preference_value, update_time AS last_updated"),
    "user_devices": _load(
        "raw_data__device_registry", "register_time", W_EVT,
        "user_id, device_id, device_name, os_type AS platform, last_login_time AS last_used"),
    "warehouse_creation": _load(
        "raw_data__warehouse_records", "create_time", W_EVT,
        "warehouse_id, warehouse_name AS name, warehouse_location AS location, storage_capacity AS capacity, "
        "operational_status AS status"),
    "inventory_receipt": _load(
        "raw_data__inventory_receipts", "receive_date", W_ORD,
        "receipt_id, warehouse_id, supplier_id, receive_date AS receipt_date, item_count AS total_items"),
    "receipt_items": _load(
        "raw_data__receipt_item_details", "create_time", W_ORD,
        "receipt_id, product_id, received_quantity AS quantity, cost_per_unit AS unit_cost"),
    "inventory_adjustments": _load(
        "raw_data__inventory_adjustments", "adjustment_time", W_ORD,
        "adjustment_id, warehouse_id, product_id, quantity_delta AS quantity_change, adjustment_reason AS reason, "
        "adjustment_time"),
    "inventory_transfers": _load(
        "raw_data__inventory_transfers", "transfer_date", W_ORD,
        "transfer_id, from_warehouse_id AS source_warehouse_id, to_warehouse_id AS destination_warehouse_id, "
        "transfer_date, transfer_status AS status"),
    "transfer_items": _load(
        "raw_data__transfer_item_details", "create_time", W_ORD,
        "transfer_id, product_id, transfer_quantity AS quantity"),
    "campaign_creation": _load(
        "raw_data__marketing_campaigns", "create_time", W_EVT,
        "campaign_id, campaign_name AS name, campaign_description AS description, start_date, end_date, "
        "budget_amount AS budget, campaign_status AS status"),
    "campaign_channels": _load(
        "raw_data__campaign_channels", "create_time", W_EVT,
        "campaign_id, channel_name AS channel, allocated_budget AS budget_allocation, "
        "channel_start_date AS start_date, channel_end_date AS end_date"),
    "promotion_codes": _load(
        "raw_data__promotion_codes", "create_time", W_EVT,
        "promo_code AS code, campaign_id, discount_type, discount_amount AS discount_value, "
        "valid_from AS start_date, valid_to AS end_date, max_uses AS usage_limit"),
    "promotion_usage": _load(
        "raw_data__promotion_usage_logs", "apply_time", W_EVT,
        "promo_code AS code, order_id, user_id, apply_time AS usage_time, discount_amount"),
    "email_campaigns": _load(
        "raw_data__email_campaigns", "send_time", W_EVT,
        "campaign_id, email_subject AS subject, email_content AS content, send_time AS sent_time, recipient_count"),
    "refund_expense": _load(
        "payment_center__refunds", "refund_time", W_ORD,
        "CAST(refund_id AS VARCHAR) AS expense_id, 'refund' AS expense_type, amount, refund_time AS expense_date, "
        "CAST(order_id AS VARCHAR) AS reference_id",
        "status = 'completed'"),
    "shipping_expense": _load(
        "logistics__shipments", "shipping_date", W_ORD,
        "CAST(shipment_id AS VARCHAR) AS expense_id, 'shipping' AS expense_type, shipping_cost AS amount, "
        "shipping_date AS expense_date, CAST(order_id AS VARCHAR) AS reference_id"),
    "marketing_expense": _load(
        "marketing__campaigns", "end_date", W_EVT,
        "CAST(campaign_id AS VARCHAR) AS expense_id, 'marketing' AS expense_type, budget_spent AS amount, "
        "CAST(end_date AS TIMESTAMP) AS expense_date, CAST(channel_id AS VARCHAR) AS reference_id"),
    "tax_calculations": _load(
        "finance__revenue", "revenue_date", W_ORD,
        "order_id, amount * CAST(0.1 AS DOUBLE) AS tax_amount, 10 AS tax_rate, 'sales_tax' AS tax_category, "
        "revenue_date AS tax_date"),
}

ORDER_DAY = "CAST(o.order_time AS DATE)"

JOBS = {
    "order_shipping": f"""
SELECT s.shipment_id, s.order_id, a.full_address AS shipping_address, s.shipping_method, s.tracking_number, s.status
FROM raw_data__shipping_records s JOIN user_center__user_addresses a ON s.address_id = a.address_id
WHERE {win('s.create_time', W_ORD)}""",
    "daily_order_summary": f"""
WITH o AS (SELECT CAST(order_time AS DATE) AS d, order_id, total_amount,
                  COALESCE(payment_method, 'unknown') AS pm
           FROM order_center__orders WHERE {win('order_time', W_ORD)}),
m AS (SELECT d, pm, COUNT(*) AS n FROM o GROUP BY d, pm),
j AS (SELECT d, '{{' || string_agg('"' || pm || '":' || CAST(n AS VARCHAR), ',' ORDER BY pm) || '}}' AS dist
      FROM m GROUP BY d)
SELECT o.d AS date, COUNT(DISTINCT o.order_id) AS total_orders, {dbl(dsum('o.total_amount'))} AS total_amount,
       {div(dsum('o.total_amount'), 'COUNT(o.total_amount)')} AS avg_order_value,
       j.dist AS payment_method_distribution
FROM o JOIN j ON o.d = j.d GROUP BY o.d, j.dist""",
    "user_order_stats": f"""
WITH ow AS (SELECT * FROM order_center__orders WHERE {win('order_time', W_ORD)}),
stats AS (SELECT user_id, COUNT(DISTINCT order_id) AS total_orders, {dbl(dsum('total_amount'))} AS total_spent,
                 MIN(CAST(order_time AS DATE)) AS first_order_date, MAX(CAST(order_time AS DATE)) AS last_order_date
          FROM ow GROUP BY user_id),
uo AS (SELECT DISTINCT user_id, order_id FROM order_center__orders WHERE user_id IN (SELECT user_id FROM ow)),
cat AS (SELECT uo.user_id, p.category, COUNT(*) AS n
        FROM order_center__order_items oi JOIN product_center__products p ON oi.product_id = p.product_id
        JOIN uo ON uo.order_id = oi.order_id GROUP BY uo.user_id, p.category),
fav AS (SELECT user_id, category FROM (
          SELECT user_id, category, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n DESC, category ASC) AS rn
          FROM cat) WHERE rn = 1)
SELECT s.user_id, s.total_orders, s.total_spent, s.first_order_date, s.last_order_date,
       f.category AS favorite_category
FROM stats s LEFT JOIN fav f ON s.user_id = f.user_id""",
    "order_conversion": f"""
SELECT CAST(e.event_time AS DATE) AS date,
       CAST(SUM(CASE WHEN e.event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS cart_additions,
       CAST(SUM(CASE WHEN e.event_type = 'begin_checkout' THEN 1 ELSE 0 END) AS BIGINT) AS checkout_starts,
       COUNT(DISTINCT o.order_id) AS orders_completed,
       {div('COUNT(DISTINCT o.order_id)', "SUM(CASE WHEN e.event_type = 'begin_checkout' THEN 1 ELSE 0 END)")}
         AS conversion_rate
FROM raw_data__user_events e
LEFT JOIN ev_orders o ON e.user_id = o.user_id AND CAST(e.event_time AS DATE) = CAST(o.order_time AS DATE)
WHERE {win('e.event_time', W_EVT)}
GROUP BY CAST(e.event_time AS DATE)""",
    "order_conversion_exact": f"""
WITH e AS (SELECT user_id, CAST(event_time AS DATE) AS d, event_type FROM raw_data__user_events
           WHERE {win('event_time', W_EVT)}),
c AS (SELECT d, SUM(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS ca,
             SUM(CASE WHEN event_type = 'begin_checkout' THEN 1 ELSE 0 END) AS cs FROM e GROUP BY d),
oc AS (SELECT {ORDER_DAY} AS d, COUNT(DISTINCT o.order_id) AS n FROM ev_orders o
       WHERE EXISTS (SELECT 1 FROM e WHERE e.user_id = o.user_id AND e.d = {ORDER_DAY}) GROUP BY 1)
SELECT c.d AS date, CAST(c.ca AS BIGINT) AS cart_additions, CAST(c.cs AS BIGINT) AS checkout_starts,
       COALESCE(oc.n, 0) AS orders_completed, {div('COALESCE(oc.n, 0)', 'c.cs')} AS conversion_rate
FROM c LEFT JOIN oc ON c.d = oc.d""",
    "update_order_status": f"""
SELECT o.order_id, o.user_id, o.order_time, o.total_amount,
       CASE WHEN o.order_id IN (SELECT order_id FROM logistics__shipments
                                WHERE status = 'delivered' AND {win('delivery_time', W_ORD)})
            THEN 'delivered' ELSE o.status END AS status,
       o.payment_method, o.warehouse_id
FROM order_center__orders o""",
    "revenue_recognition": f"""
SELECT o.order_id, o.user_id, o.total_amount AS amount, p.payment_time AS revenue_date, o.payment_method
FROM order_center__orders o JOIN payment_center__payments p ON o.order_id = p.order_id
WHERE p.status = 'completed' AND {win('p.payment_time', W_ORD)}""",
    "revenue_recognition_exact": f"""
WITH f AS (SELECT order_id, MIN(payment_time) AS first_paid FROM payment_center__payments
           WHERE status = 'completed' GROUP BY order_id)
SELECT o.order_id, o.user_id, o.total_amount AS amount, f.first_paid AS revenue_date, o.payment_method
FROM order_center__orders o JOIN f ON o.order_id = f.order_id
WHERE {win('f.first_paid', W_ORD)}""",
    "inventory_expense": f"""
SELECT CAST(r.receipt_id AS VARCHAR) AS expense_id, 'inventory' AS expense_type,
       {dbl(dsum('ri.quantity * ri.unit_cost'))} AS amount, r.receipt_date AS expense_date,
       CAST(r.supplier_id AS VARCHAR) AS reference_id
FROM inventory__inventory_receipts r JOIN inventory__receipt_items ri ON r.receipt_id = ri.receipt_id
WHERE {win('r.receipt_date', W_ORD)}
GROUP BY r.receipt_id, r.receipt_date, r.supplier_id""",
    "monthly_profit": f"""
WITH e AS (SELECT CAST(month(expense_date) AS INTEGER) AS mo, CAST(year(expense_date) AS INTEGER) AS yr,
                  {dsum('amount')} AS total_expenses
           FROM finance__expenses WHERE {win('expense_date', W_ORD)} GROUP BY 1, 2),
r AS (SELECT CAST(month(revenue_date) AS INTEGER) AS mo, CAST(year(revenue_date) AS INTEGER) AS yr,
             {dsum('amount')} AS revenue
      FROM finance__revenue WHERE {win('revenue_date', W_ORD)} GROUP BY 1, 2)
SELECT r.mo AS month, r.yr AS year, {dbl('r.revenue')} AS revenue,
       {dbl('COALESCE(e.total_expenses, 0)')} AS expenses,
       {dbl('r.revenue - COALESCE(e.total_expenses, 0)')} AS profit,
       {div('r.revenue - COALESCE(e.total_expenses, 0)', 'r.revenue')} * 100 AS profit_margin
FROM r LEFT JOIN e ON r.mo = e.mo AND r.yr = e.yr""",
    "customer_lifetime_value": f"""
SELECT user_id, {dbl(dsum('amount'))} AS total_revenue, MIN(revenue_date) AS first_purchase_date,
       MAX(revenue_date) AS last_purchase_date, COUNT(DISTINCT order_id) AS purchase_count
FROM finance__revenue GROUP BY user_id
HAVING {win('MAX(revenue_date)', W_LAST_YEAR)}""",
    "payment_methods_summary": f"""
SELECT payment_method, COUNT(*) AS transaction_count, {dbl(dsum('amount'))} AS total_amount,
       {div(dsum('amount'), 'COUNT(amount)')} AS average_amount,
       CAST(month(revenue_date) AS INTEGER) AS month, CAST(year(revenue_date) AS INTEGER) AS year
FROM finance__revenue WHERE {win('revenue_date', W_ORD)}
GROUP BY payment_method, month(revenue_date), year(revenue_date)""",
    "inventory_levels": f"""
WITH mv AS (
  SELECT ir.warehouse_id, ri.product_id, CAST(ir.receipt_date AS DATE) AS d, ri.quantity AS rc,
         CAST(0 AS DOUBLE) AS sl, CAST(0 AS DOUBLE) AS aj, CAST(0 AS DOUBLE) AS ti, CAST(0 AS DOUBLE) AS tto
  FROM inventory__receipt_items ri JOIN inventory__inventory_receipts ir ON ri.receipt_id = ir.receipt_id
  WHERE {win('ir.receipt_date', W_LEDGER)}
  UNION ALL
  SELECT o.warehouse_id, oi.product_id, CAST(o.order_time AS DATE), 0, oi.quantity, 0, 0, 0
  FROM order_center__order_items oi JOIN order_center__orders o ON oi.order_id = o.order_id
  WHERE {win('o.order_time', W_LEDGER)}
  UNION ALL
  SELECT warehouse_id, product_id, CAST(adjustment_time AS DATE), 0, 0, quantity_change, 0, 0
  FROM inventory__inventory_adjustments WHERE {win('adjustment_time', W_LEDGER)}
  UNION ALL
  SELECT it.destination_warehouse_id, t.product_id, CAST(it.transfer_date AS DATE), 0, 0, 0, t.quantity, 0
  FROM inventory__transfer_items t JOIN inventory__inventory_transfers it ON t.transfer_id = it.transfer_id
  WHERE {win('it.transfer_date', W_LEDGER)}
  UNION ALL
  SELECT it.source_warehouse_id, t.product_id, CAST(it.transfer_date AS DATE), 0, 0, 0, 0, t.quantity
  FROM inventory__transfer_items t JOIN inventory__inventory_transfers it ON t.transfer_id = it.transfer_id
  WHERE {win('it.transfer_date', W_LEDGER)}),
m AS (SELECT warehouse_id, product_id, d, {dsum('rc')} AS rc, {dsum('sl')} AS sl, {dsum('aj')} AS aj,
             {dsum('ti')} AS ti, {dsum('tto')} AS tto FROM mv GROUP BY 1, 2, 3),
firsts AS (SELECT warehouse_id, product_id, MIN(f) AS f FROM (
             SELECT warehouse_id, product_id, MIN(d) AS f FROM m GROUP BY 1, 2
             UNION ALL SELECT warehouse_id, product_id, DATE '{W_LEDGER.date}' FROM inventory__product_inventory)
           WHERE warehouse_id IN (SELECT warehouse_id FROM inventory__warehouses)
             AND product_id IN (SELECT product_id FROM product_center__products)
           GROUP BY 1, 2),
grid AS (SELECT f.warehouse_id, f.product_id, CAST(g.d AS DATE) AS d
         FROM firsts f, LATERAL (SELECT unnest(generate_series(CAST(f.f AS TIMESTAMP),
                                   TIMESTAMP '{W_LEDGER.date_next} 00:00:00' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d) g),
led AS (SELECT g.warehouse_id, g.product_id, g.d,
               COALESCE(m.rc, 0) AS rc, COALESCE(m.sl, 0) AS sl, COALESCE(m.aj, 0) AS aj,
               COALESCE(m.ti, 0) AS ti, COALESCE(m.tto, 0) AS tto
        FROM grid g LEFT JOIN m ON m.warehouse_id = g.warehouse_id AND m.product_id = g.product_id AND m.d = g.d),
run AS (SELECT *, rc - sl + aj + ti - tto AS net,
               SUM(rc - sl + aj + ti - tto) OVER (PARTITION BY warehouse_id, product_id ORDER BY d
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ending
        FROM led)
SELECT d AS date, warehouse_id, product_id, {dbl('ending - net')} AS beginning_quantity,
       {dbl('rc')} AS receipts, {dbl('sl')} AS sales, {dbl('aj')} AS adjustments, {dbl('ti')} AS transfers_in,
       {dbl('tto')} AS transfers_out, {dbl('ending')} AS ending_quantity
FROM run""",
    "inventory_levels_carried": f"""
WITH mv AS (
  SELECT ir.warehouse_id, ri.product_id, CAST(ir.receipt_date AS DATE) AS d, ri.quantity AS rc,
         CAST(0 AS DOUBLE) AS sl, CAST(0 AS DOUBLE) AS aj, CAST(0 AS DOUBLE) AS ti, CAST(0 AS DOUBLE) AS tto
  FROM inventory__receipt_items ri JOIN inventory__inventory_receipts ir ON ri.receipt_id = ir.receipt_id
  WHERE {win('ir.receipt_date', W_LEDGER)}
  UNION ALL
  SELECT o.warehouse_id, oi.product_id, CAST(o.order_time AS DATE), 0, oi.quantity, 0, 0, 0
  FROM order_center__order_items oi JOIN order_center__orders o ON oi.order_id = o.order_id
  WHERE {win('o.order_time', W_LEDGER)}
  UNION ALL
  SELECT warehouse_id, product_id, CAST(adjustment_time AS DATE), 0, 0, quantity_change, 0, 0
  FROM inventory__inventory_adjustments WHERE {win('adjustment_time', W_LEDGER)}
  UNION ALL
  SELECT it.destination_warehouse_id, t.product_id, CAST(it.transfer_date AS DATE), 0, 0, 0, t.quantity, 0
  FROM inventory__transfer_items t JOIN inventory__inventory_transfers it ON t.transfer_id = it.transfer_id
  WHERE {win('it.transfer_date', W_LEDGER)}
  UNION ALL
  SELECT it.source_warehouse_id, t.product_id, CAST(it.transfer_date AS DATE), 0, 0, 0, 0, t.quantity
  FROM inventory__transfer_items t JOIN inventory__inventory_transfers it ON t.transfer_id = it.transfer_id
  WHERE {win('it.transfer_date', W_LEDGER)}),
m AS (SELECT warehouse_id, product_id, d, {dsum('rc')} AS rc, {dsum('sl')} AS sl, {dsum('aj')} AS aj,
             {dsum('ti')} AS ti, {dsum('tto')} AS tto FROM mv GROUP BY 1, 2, 3),
firsts AS (SELECT warehouse_id, product_id, MIN(f) AS f FROM (
             SELECT warehouse_id, product_id, MIN(d) AS f FROM m GROUP BY 1, 2
             UNION ALL SELECT warehouse_id, product_id, DATE '{W_LEDGER.date}' FROM inventory__product_inventory
             UNION ALL SELECT warehouse_id, product_id, DATE '{W_LEDGER.date}' FROM prior_ledger)
           WHERE warehouse_id IN (SELECT warehouse_id FROM inventory__warehouses)
             AND product_id IN (SELECT product_id FROM product_center__products)
           GROUP BY 1, 2),
grid AS (SELECT f.warehouse_id, f.product_id, CAST(g.d AS DATE) AS d
         FROM firsts f, LATERAL (SELECT unnest(generate_series(CAST(f.f AS TIMESTAMP),
                                   TIMESTAMP '{W_LEDGER.date_next} 00:00:00' - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d) g),
carried AS (SELECT warehouse_id, product_id, {dsum('ending_quantity')} AS q FROM prior_ledger
            WHERE date = DATE '{W_LEDGER.date}' - 1 GROUP BY 1, 2),
led AS (SELECT g.warehouse_id, g.product_id, g.d,
               COALESCE(m.rc, 0) AS rc, COALESCE(m.sl, 0) AS sl, COALESCE(m.aj, 0) AS aj,
               COALESCE(m.ti, 0) AS ti, COALESCE(m.tto, 0) AS tto,
               CASE WHEN g.d = DATE '{W_LEDGER.date}' THEN COALESCE(c.q, 0) ELSE 0 END AS carried
        FROM grid g LEFT JOIN m ON m.warehouse_id = g.warehouse_id AND m.product_id = g.product_id AND m.d = g.d
        LEFT JOIN carried c ON c.warehouse_id = g.warehouse_id AND c.product_id = g.product_id),
run AS (SELECT *, rc - sl + aj + ti - tto AS net,
               SUM(carried + rc - sl + aj + ti - tto) OVER (PARTITION BY warehouse_id, product_id ORDER BY d
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ending
        FROM led)
SELECT d AS date, warehouse_id, product_id, {dbl('ending - net')} AS beginning_quantity,
       {dbl('rc')} AS receipts, {dbl('sl')} AS sales, {dbl('aj')} AS adjustments, {dbl('ti')} AS transfers_in,
       {dbl('tto')} AS transfers_out, {dbl('ending')} AS ending_quantity
FROM run""",
    "low_stock_alerts": f"""
SELECT i.product_id, i.warehouse_id, i.quantity AS current_quantity, p.reorder_threshold AS threshold,
       {TODAY} AS alert_date
FROM inventory__product_inventory i JOIN product_center__products p ON i.product_id = p.product_id
WHERE i.quantity <= p.reorder_threshold
  AND NOT EXISTS (SELECT 1 FROM inventory__low_stock_alerts a
                  WHERE a.product_id = i.product_id AND a.warehouse_id = i.warehouse_id
                    AND a.alert_date >= DATE '{COOLDOWN_START}')""",
    "update_inventory_after_order": f"""
WITH sold AS (SELECT oi.product_id, o.warehouse_id, {dsum('oi.quantity')} AS q
              FROM order_center__order_items oi JOIN order_center__orders o ON oi.order_id = o.order_id
              WHERE {win('o.order_time', W_ORD)} AND o.status = 'completed' GROUP BY 1, 2)
SELECT i.product_id, i.warehouse_id,
       CASE WHEN s.product_id IS NOT NULL THEN {dbl(f'CAST(i.quantity AS {D}) - s.q')} ELSE i.quantity END
         AS quantity,
       CASE WHEN s.product_id IS NOT NULL THEN {NOW} ELSE i.last_updated END AS last_updated
FROM inventory__product_inventory i
LEFT JOIN sold s ON i.product_id = s.product_id AND i.warehouse_id = s.warehouse_id""",
    "stock_after_days": f"""
WITH taken AS (SELECT oi.product_id, o.warehouse_id, CAST(CAST(o.order_time AS DATE) + 1 AS TIMESTAMP) AS until,
                      {dsum('oi.quantity')} AS q
               FROM order_center__order_items oi JOIN ev_orders o ON oi.order_id = o.order_id
               WHERE {win('o.order_time', W_EVT)} GROUP BY 1, 2, 3)
SELECT i.product_id, i.warehouse_id, {dbl(f'CAST(i.quantity AS {D}) - COALESCE(SUM(s.q), 0)')} AS quantity,
       CASE WHEN COUNT(s.q) > 0 THEN {NOW} ELSE i.last_updated END AS last_updated
FROM inventory__product_inventory i
LEFT JOIN taken s ON i.product_id = s.product_id AND i.warehouse_id = s.warehouse_id AND s.until > i.last_updated
GROUP BY i.product_id, i.warehouse_id, i.quantity, i.last_updated""",
    "email_metrics": f"""
WITH s AS (SELECT campaign_id, CAST(sent_time AS DATE) AS d, SUM(recipient_count) AS sent
           FROM marketing__email_campaigns WHERE {win('sent_time', W_JANUARY)} GROUP BY 1, 2)
SELECT s.campaign_id, s.d AS date, CAST(s.sent AS BIGINT) AS emails_sent,
       COUNT(DISTINCT CASE WHEN m.event_type = 'open' THEN m.user_id END) AS open_count,
       COUNT(DISTINCT CASE WHEN m.event_type = 'click' THEN m.user_id END) AS click_count,
       {div("COUNT(DISTINCT CASE WHEN m.event_type = 'open' THEN m.user_id END)", 's.sent')} AS open_rate,
       {div("COUNT(DISTINCT CASE WHEN m.event_type = 'click' THEN m.user_id END)", 's.sent')} AS click_rate
FROM s LEFT JOIN raw_data__email_events m ON s.campaign_id = m.campaign_id
GROUP BY s.campaign_id, s.d, s.sent""",
    "campaign_performance": f"""
SELECT c.campaign_id, CAST(m.event_date AS DATE) AS date,
       CAST(SUM(CASE WHEN m.event_type = 'impression' THEN m.event_count ELSE 0 END) AS BIGINT) AS impressions,
       CAST(SUM(CASE WHEN m.event_type = 'click' THEN m.event_count ELSE 0 END) AS BIGINT) AS clicks,
       COUNT(DISTINCT o.order_id) AS conversions,
       {dbl(dsum('m.cost'))} AS spend,
       {dbl(dsum('o.total_amount'))} AS revenue,
       CASE WHEN {dsum('m.cost')} > 0 THEN {div(dsum('o.total_amount'), dsum('m.cost'))} ELSE 0 END AS roi
FROM marketing__campaigns c
JOIN raw_data__marketing_metrics m ON c.campaign_id = m.campaign_id
LEFT JOIN ev_orders o ON m.user_id = o.user_id AND CAST(m.event_date AS DATE) = CAST(o.order_time AS DATE)
WHERE {win('m.event_date', W_EVT)}
GROUP BY c.campaign_id, CAST(m.event_date AS DATE)""",
    "campaign_performance_exact": f"""
WITH m AS (SELECT campaign_id, CAST(event_date AS DATE) AS d, user_id, event_type, event_count, cost
           FROM raw_data__marketing_metrics
           WHERE {win('event_date', W_EVT)} AND campaign_id IN (SELECT campaign_id FROM marketing__campaigns)),
t AS (SELECT campaign_id, d, SUM(CASE WHEN event_type = 'impression' THEN event_count ELSE 0 END) AS imp,
             SUM(CASE WHEN event_type = 'click' THEN event_count ELSE 0 END) AS clk, {dsum('cost')} AS spend
      FROM m GROUP BY 1, 2),
a AS (SELECT DISTINCT m.campaign_id, m.d, o.order_id, o.total_amount
      FROM m JOIN ev_orders o ON o.user_id = m.user_id AND CAST(o.order_time AS DATE) = m.d),
c AS (SELECT campaign_id, d, COUNT(DISTINCT order_id) AS conv, {dsum('total_amount')} AS rev FROM a GROUP BY 1, 2)
SELECT t.campaign_id, t.d AS date, CAST(t.imp AS BIGINT) AS impressions, CAST(t.clk AS BIGINT) AS clicks,
       COALESCE(c.conv, 0) AS conversions, {dbl('t.spend')} AS spend, {dbl('c.rev')} AS revenue,
       CASE WHEN t.spend > 0 THEN {div('c.rev', 't.spend')} ELSE 0 END AS roi
FROM t LEFT JOIN c ON c.campaign_id = t.campaign_id AND c.d = t.d""",
    "user_acquisition": f"""
SELECT CAST(u.register_time AS DATE) AS date, u.referral_source AS source,
       COUNT(DISTINCT u.user_id) AS new_users,
       {div('COUNT(DISTINCT o.order_id)', 'COUNT(DISTINCT u.user_id)')} AS conversion_rate,
       {div(dsum('m.cost'), 'COUNT(DISTINCT u.user_id)')} AS acquisition_cost
FROM user_center__registered_users u
LEFT JOIN ev_orders o ON u.user_id = o.user_id AND CAST(u.register_time AS DATE) = CAST(o.order_time AS DATE)
LEFT JOIN raw_data__marketing_metrics m
  ON u.referral_source = m.source AND CAST(u.register_time AS DATE) = CAST(m.event_date AS DATE)
WHERE {win('u.register_time', W_COHORT)}
GROUP BY CAST(u.register_time AS DATE), u.referral_source""",
    "user_acquisition_exact": f"""
WITH u AS (SELECT user_id, CAST(register_time AS DATE) AS d, referral_source AS source
           FROM user_center__registered_users WHERE {win('register_time', W_COHORT)}),
g AS (SELECT d, source, COUNT(DISTINCT user_id) AS nu FROM u GROUP BY 1, 2),
oc AS (SELECT u.d, u.source, COUNT(DISTINCT o.order_id) AS n
       FROM u JOIN ev_orders o ON o.user_id = u.user_id AND CAST(o.order_time AS DATE) = u.d GROUP BY 1, 2),
mc AS (SELECT source, CAST(event_date AS DATE) AS d, {dsum('cost')} AS c FROM raw_data__marketing_metrics
       GROUP BY 1, 2)
SELECT g.d AS date, g.source, g.nu AS new_users, {div('COALESCE(oc.n, 0)', 'g.nu')} AS conversion_rate,
       {div('mc.c', 'g.nu')} AS acquisition_cost
FROM g LEFT JOIN oc ON oc.d = g.d AND oc.source = g.source
LEFT JOIN mc ON mc.source = g.source AND mc.d = g.d""",
    "update_campaign_status": f"""
SELECT campaign_id, name, description, start_date, end_date, budget,
       CASE WHEN status = 'active' AND end_date < {TODAY} THEN 'completed' ELSE status END AS status,
       budget_spent, channel_id
FROM marketing__campaigns""",
    "product_price_history": f"""
SELECT product_id, new_price AS price, change_time AS effective_from,
       LEAD(change_time) OVER (PARTITION BY product_id ORDER BY change_time) AS effective_to, change_reason
FROM raw_data__price_change_logs WHERE {win('change_time', W_EVT)}""",
    "product_price_history_exact": f"""
SELECT product_id, new_price AS price, change_time AS effective_from,
       LEAD(change_time) OVER (PARTITION BY product_id ORDER BY change_time) AS effective_to, change_reason
FROM raw_data__price_change_logs
WHERE change_time < {_ts(W_EVT.date_next)}
  AND product_id IN (SELECT product_id FROM raw_data__price_change_logs WHERE {win('change_time', W_EVT)})""",
    "product_sales": f"""
WITH r AS (SELECT product_id, {div('SUM(rating)', 'COUNT(rating)')} AS avg_rating
           FROM product_center__product_reviews GROUP BY product_id)
SELECT CAST(o.order_time AS DATE) AS date, i.product_id, {dbl(dsum('i.quantity'))} AS units_sold,
       {dbl(dsum('i.subtotal'))} AS revenue,
       (SELECT r.avg_rating FROM r WHERE r.product_id = i.product_id) AS avg_rating
FROM order_center__orders o JOIN order_center__order_items i ON o.order_id = i.order_id
WHERE {win('o.order_time', W_ORD)}
GROUP BY CAST(o.order_time AS DATE), i.product_id""",
    "category_performance": f"""
SELECT CAST(o.order_time AS DATE) AS date, p.category, {dbl(dsum('i.subtotal'))} AS total_sales,
       COUNT(DISTINCT i.product_id) AS product_count,
       {div(dsum('i.unit_price'), 'COUNT(i.unit_price)')} AS avg_price
FROM order_center__orders o
JOIN order_center__order_items i ON o.order_id = i.order_id
JOIN product_center__products p ON i.product_id = p.product_id
WHERE {win('o.order_time', W_ORD)}
GROUP BY CAST(o.order_time AS DATE), p.category""",
    "update_product_rating": f"""
SELECT p.product_id, p.name, p.description, p.category, p.price, p.stock, p.status, p.reorder_threshold,
       CASE WHEN EXISTS (SELECT 1 FROM product_center__product_reviews r
                         WHERE r.product_id = p.product_id AND {win('r.review_time', W_EVT)})
            THEN (SELECT {div('SUM(r2.rating)', 'COUNT(r2.rating)')} FROM product_center__product_reviews r2
                  WHERE r2.product_id = p.product_id)
            ELSE p.average_rating END AS average_rating
FROM product_center__products p""",
    "user_activity": f"""
SELECT user_id, CAST(login_time AS DATE) AS date, COUNT(*) AS login_count,
       {dbl(dsum('session_duration'))} / 60 AS active_minutes,
       '{{"pages_visited":' || COALESCE(CAST(SUM(pages_visited) AS VARCHAR), 'null')
         || ',"actions":' || COALESCE(CAST(SUM(actions) AS VARCHAR), 'null') || '}}' AS feature_usage
FROM raw_data__user_sessions WHERE {win('login_time', W_EVT)}
GROUP BY user_id, CAST(login_time AS DATE)""",
    "user_retention": f"""
WITH fd AS (SELECT CAST(register_time AS DATE) AS signup_date, COUNT(DISTINCT user_id) AS total_users
            FROM user_center__registered_users GROUP BY 1)
SELECT CAST(u.register_time AS DATE) AS cohort_date,
       CAST(date_diff('day', CAST(u.register_time AS DATE), CAST(l.login_time AS DATE)) AS INTEGER)
         AS days_since_signup,
       COUNT(DISTINCT u.user_id) AS user_count,
       {div('COUNT(DISTINCT u.user_id)', 'fd.total_users')} AS retention_rate
FROM user_center__registered_users u
JOIN user_center__login_history l ON u.user_id = l.user_id
JOIN fd ON CAST(u.register_time AS DATE) = fd.signup_date
WHERE {win('u.register_time', W_COHORT)}
GROUP BY 1, 2, fd.total_users""",
    "user_segments": f"""
SELECT u.user_id,
       CASE WHEN a.active_minutes > 120 THEN 'power_user' WHEN a.active_minutes > 30 THEN 'active_user'
            ELSE 'casual_user' END AS segment_name,
       {TODAY} AS added_date, a.active_minutes / 10 AS score
FROM user_center__registered_users u JOIN analytics__user_activity_summary a ON u.user_id = a.user_id
WHERE {win('a.date', W_EVT)}""",
    "user_deletion": f"""
WITH hit AS (SELECT DISTINCT user_id FROM raw_data__account_deletion_requests
             WHERE {win('request_time', W_EVT)} AND status = 'approved')
SELECT u.user_id, u.username, u.email, u.phone, u.register_time,
       CASE WHEN h.user_id IS NOT NULL THEN 0 ELSE u.status END AS status, u.referral_source,
       CASE WHEN h.user_id IS NOT NULL THEN {NOW} ELSE u.deletion_time END AS deletion_time
FROM user_center__registered_users u LEFT JOIN hit h ON h.user_id = u.user_id""",
}

# the same rows by another route
JOBS["inventory_levels_repaired"] = JOBS["inventory_levels"]
JOBS["customer_lifetime_value_merged"] = JOBS["customer_lifetime_value"]
JOBS["product_price_history_stepped"] = JOBS["product_price_history_exact"]
JOBS["user_order_stats_merged"] = JOBS["user_order_stats"]

ORACLE_SQL: dict[str, str] = {name: with_views(sql) for name, sql in {**LOADS, **JOBS}.items()}
