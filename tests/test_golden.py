
import datetime as dt

from tillroll.functions.window import BatchWindow
from tillroll.plans import finance, inventory, marketing, orders, users
from tillroll.plans.loads import JOBS as LOADS

W = BatchWindow("2024-01-08", "2024-01-09", "2024-01-30")
T = dt.datetime
D = dt.date

ORDERS = "order_id bigint, user_id bigint, order_time timestamp_ntz, total_amount double, status string, payment_method string"
EVENTS = "user_id bigint, event_time timestamp_ntz, event_type string"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_window_is_half_open(tables):
    t = tables(
        raw_data__order_logs=(
            "order_id bigint, user_id bigint, create_time timestamp_ntz, total_price double, order_status string, payment_type string",
            [
                (1, 1, T(2024, 1, 8, 0, 0, 0), 1.0, "F", "a"),  # at date: in
                (2, 1, T(2024, 1, 8, 23, 59, 59, 999999), 1.0, "F", "a"),  # in
                (3, 1, T(2024, 1, 9, 0, 0, 0), 1.0, "F", "a"),  # at date_next: out
                (4, 1, None, 1.0, "F", "a"),  # NULL never matches
            ],
        )
    )
    assert rows(LOADS["order_creation"](t, W), "order_id") == [(1,), (2,)]


def test_adjacent_windows_union_to_two_day_window(tables):
    t = tables(
        raw_data__order_logs=(
            "order_id bigint, user_id bigint, create_time timestamp_ntz, total_price double, order_status string, payment_type string",
            [(i, 1, T(2024, 1, 7) + dt.timedelta(hours=7 * i), 1.0, "F", "a") for i in range(12)],
        )
    )
    day1 = LOADS["order_creation"](t, BatchWindow("2024-01-08", "2024-01-09"))
    day2 = LOADS["order_creation"](t, BatchWindow("2024-01-09", "2024-01-10"))
    both = LOADS["order_creation"](t, BatchWindow("2024-01-08", "2024-01-10"))
    assert rows(day1.unionByName(day2), "order_id") == rows(both, "order_id")


def test_null_payment_method_is_reported_as_unknown(tables):
    t = tables(
        order_center__orders=(
            ORDERS,
            [
                (1, 1, T(2024, 1, 8, 1), 10.0, "completed", None),
                (2, 1, T(2024, 1, 8, 2), 20.0, "completed", "card"),
                (3, 2, T(2024, 1, 8, 3), 30.0, "completed", "card"),
            ],
        )
    )
    (r,) = orders.daily_order_summary(t, W).collect()
    assert r["total_orders"] == 3 and r["total_amount"] == 60.0 and r["avg_order_value"] == 20.0
    assert r["payment_method_distribution"] == '{"card":2,"unknown":1}'


def test_conversion_zero_checkouts_is_null_and_fanout_as_written(tables):
    t = tables(
        raw_data__user_events=(
            EVENTS,
            [
                (1, T(2024, 1, 8, 1), "add_to_cart"),
                (1, T(2024, 1, 8, 2), "add_to_cart"),
                (2, T(2024, 1, 8, 3), "view"),
            ],
        ),
        order_center__orders=(
            ORDERS,
            [
                (10, 1, T(2024, 1, 8, 5), 5.0, "completed", "x"),
                (11, 1, T(2024, 1, 8, 6), 5.0, "completed", "x"),
                (12, 3, T(2024, 1, 8, 6), 5.0, "completed", "x"),  # user without events: not counted
            ],
        ),
    )
    (r,) = orders.order_conversion(t, W).collect()
    # each of user 1's two cart events meets two same-day orders
    assert (r["cart_additions"], r["checkout_starts"], r["orders_completed"]) == (4, 0, 2)
    assert r["conversion_rate"] is None
    (e,) = orders.order_conversion_exact(t, W).collect()
    assert (e["cart_additions"], e["orders_completed"], e["conversion_rate"]) == (2, 2, None)


def test_favourite_category_ties_go_to_smallest(tables):
    t = tables(
        order_center__orders=(
            ORDERS,
            [
                (1, 7, T(2024, 1, 8, 1), 1.0, "completed", "x"),
                (2, 7, T(2020, 1, 1), 1.0, "completed", "x"),  # older order still counts
            ],
        ),
        order_center__order_items=(
            "order_id bigint, product_id bigint, quantity double, unit_price double, subtotal double",
            [(1, 100, 1.0, 1.0, 1.0), (2, 200, 1.0, 1.0, 1.0), (2, 300, 1.0, 1.0, 1.0)],
        ),
        product_center__products=(
            "product_id bigint, category string",
            [(100, "toys"), (200, "books"), (300, "toys")],
        ),
    )
    (r,) = orders.user_order_stats(t, W).collect()
    assert r["favorite_category"] == "toys" and r["total_orders"] == 1
    t2 = tables(
        order_center__orders=(ORDERS, [(1, 7, T(2024, 1, 8, 1), 1.0, "completed", "x")]),
        order_center__order_items=(
            "order_id bigint, product_id bigint, quantity double, unit_price double, subtotal double",
            [(1, 100, 1.0, 1.0, 1.0), (1, 200, 1.0, 1.0, 1.0)],
        ),
        product_center__products=("product_id bigint, category string", [(100, "toys"), (200, "books")]),
    )
    (r2,) = orders.user_order_stats(t2, W).collect()
    assert r2["favorite_category"] == "books"


def test_two_payments_per_order(tables):
    t = tables(
        order_center__orders=(ORDERS, [(1, 5, T(2024, 1, 1), 100.0, "completed", "card")]),
        payment_center__payments=(
            "payment_id bigint, order_id bigint, user_id bigint, amount double, payment_time timestamp_ntz, status string",
            [
                (1, 1, 5, 60.0, T(2024, 1, 8, 1), "completed"),
                (2, 1, 5, 40.0, T(2024, 1, 8, 2), "completed"),
                (3, 1, 5, 40.0, T(2024, 1, 8, 3), "pending"),
            ],
        ),
    )
    assert len(finance.revenue_recognition(t, W).collect()) == 2  # books the total twice
    (r,) = finance.revenue_recognition_exact(t, W).collect()
    assert r["revenue_date"] == T(2024, 1, 8, 1) and r["amount"] == 100.0
    # an earlier completed payment moves the order out of this window
    later = BatchWindow("2024-01-08 02:00:00", "2024-01-09")
    assert finance.revenue_recognition_exact(t, later).count() == 0


def test_update_order_status_with_two_shipments_keeps_rows(tables):
    t = tables(
        order_center__orders=(
            ORDERS,
            [(1, 5, T(2024, 1, 1), 1.0, "pending", "x"), (2, 5, T(2024, 1, 1), 1.0, "pending", "x")],
        ),
        logistics__shipments=(
            "order_id bigint, status string, delivery_time timestamp_ntz",
            [(1, "delivered", T(2024, 1, 8, 1)), (1, "delivered", T(2024, 1, 8, 2)), (2, "in_transit", T(2024, 1, 8))],
        ),
    )
    out = orders.update_order_status(t, W)
    assert rows(out, "order_id", "status") == [(1, "delivered"), (2, "pending")]


def test_alert_cooldown_boundary(tables):
    t = tables(
        inventory__product_inventory=(
            "product_id bigint, warehouse_id bigint, quantity double",
            [(1, 1, 0.0), (2, 1, 0.0), (3, 1, 50.0)],
        ),
        product_center__products=("product_id bigint, reorder_threshold double", [(1, 5.0), (2, 5.0), (3, 5.0)]),
        inventory__low_stock_alerts=(
            "product_id bigint, warehouse_id bigint, alert_date date",
            [(1, 1, D(2024, 1, 23)), (2, 1, D(2024, 1, 22))],  # 7 days old (suppresses), 8 days old
        ),
    )
    out = inventory.low_stock_alerts(t, W)
    assert rows(out, "product_id", "alert_date") == [(2, D(2024, 1, 30))]


def test_segment_thresholds_are_strict(tables):
    t = tables(
        analytics__user_activity_summary=(
            "user_id bigint, date date, active_minutes double",
            [(1, D(2024, 1, 8), 120.0), (2, D(2024, 1, 8), 30.0), (3, D(2024, 1, 8), 120.5), (4, D(2024, 1, 8), None)],
        ),
        user_center__registered_users=("user_id bigint", [(1,), (2,), (3,), (4,)]),
    )
    out = users.user_segments(t, W)
    assert rows(out, "user_id", "segment_name") == [
        (1, "active_user"),
        (2, "casual_user"),
        (3, "power_user"),
        (4, "casual_user"),
    ]


def test_campaign_status_end_date_equal_today_unchanged(tables):
    t = tables(
        marketing__campaigns=(
            "campaign_id bigint, end_date date, status string",
            [(1, D(2024, 1, 30), "active"), (2, D(2024, 1, 29), "active"), (3, D(2024, 1, 1), "draft")],
        )
    )
    out = marketing.update_campaign_status(t, W)
    assert rows(out, "campaign_id", "status") == [(1, "active"), (2, "completed"), (3, "draft")]


def test_campaign_performance_reweighting_matches_brute_force(spark, tables):
    metrics = [
        (1, 7, T(2024, 1, 8, 1), "impression", 2, 1.25),
        (1, 7, T(2024, 1, 8, 2), "click", 1, 0.5),
        (1, 7, T(2024, 1, 8, 3), "impression", 3, 0.25),
        (1, 8, T(2024, 1, 8, 3), "impression", 1, 0.0),
        (2, 7, T(2024, 1, 8, 4), "click", 1, 2.0),
    ]
    order_rows = [(50, 7, T(2024, 1, 8, 9), 10.0), (51, 7, T(2024, 1, 8, 10), 20.0), (52, 9, T(2024, 1, 8, 10), 5.0)]
    t = tables(
        marketing__campaigns=("campaign_id bigint", [(1,), (2,), (2,)]),  # campaign 2 listed twice
        raw_data__marketing_metrics=(
            "campaign_id bigint, user_id bigint, event_date timestamp_ntz, event_type string, event_count bigint, cost double",
            metrics,
        ),
        order_center__orders=(
            "order_id bigint, user_id bigint, order_time timestamp_ntz, total_amount double",
            order_rows,
        ),
    )
    got = {r["campaign_id"]: r for r in marketing.campaign_performance(t, W).collect()}
    # brute force: literally build the joined rows
    camps = [1, 2, 2]
    joined = []
    for c in camps:
        for m in metrics:
            if m[0] != c:
                continue
            partners = [o for o in order_rows if o[1] == m[1] and o[2].date() == m[2].date()]
            for o in partners or [None]:
                joined.append((c, m, o))
    for c in (1, 2):
        js = [j for j in joined if j[0] == c]
        imp = sum(m[4] for _, m, _o in js if m[3] == "impression")
        clk = sum(m[4] for _, m, _o in js if m[3] == "click")
        conv = len({o[0] for _, _m, o in js if o})
        spend = sum(m[5] for _, m, _o in js)
        revs = [o[3] for _, _m, o in js if o]
        rev = sum(revs) if revs else None
        r = got[c]
        assert (r["impressions"], r["clicks"], r["conversions"]) == (imp, clk, conv)
        assert abs(r["spend"] - spend) < 1e-9
        assert (r["revenue"] is None) == (rev is None) and (rev is None or abs(r["revenue"] - rev) < 1e-9)


def test_user_deletion_twice_requested_keeps_rows(tables):
    t = tables(
        user_center__registered_users=(
            "user_id bigint, status int, deletion_time timestamp_ntz",
            [(1, 1, None), (2, 1, None)],
        ),
        raw_data__account_deletion_requests=(
            "user_id bigint, request_time timestamp_ntz, status string",
            [(1, T(2024, 1, 8, 1), "approved"), (1, T(2024, 1, 8, 2), "approved"), (2, T(2024, 1, 8), "pending")],
        ),
    )
    out = users.user_deletion(t, W)
    assert rows(out, "user_id", "status", "deletion_time") == [(1, 0, T(2024, 1, 30)), (2, 1, None)]


def test_email_zero_recipients_gives_null_rate(tables):
    t = tables(
        marketing__email_campaigns=(
            "campaign_id bigint, sent_time timestamp_ntz, recipient_count bigint",
            [(1, T(2024, 1, 8, 1), 0), (2, T(2024, 1, 8, 1), 4)],
        ),
        raw_data__email_events=(
            "campaign_id bigint, user_id bigint, event_type string",
            [(1, 1, "open"), (2, 1, "open"), (2, 1, "open"), (2, 2, "click")],
        ),
    )
    got = {r["campaign_id"]: r for r in marketing.email_metrics(t, W).collect()}
    assert got[1]["open_count"] == 1 and got[1]["open_rate"] is None
    assert got[2]["open_count"] == 1 and got[2]["open_rate"] == 0.25 and got[2]["click_rate"] == 0.25


def test_monthly_profit_zero_revenue_margin_is_null(tables):
    t = tables(
        finance__revenue=(
            "order_id bigint, amount double, revenue_date timestamp_ntz",
            [(1, 0.0, T(2024, 1, 8, 1))],
        ),
        finance__expenses=("amount double, expense_date timestamp_ntz", [(5.0, T(2024, 1, 8, 2))]),
    )
    (r,) = finance.monthly_profit(t, W).collect()
    assert (r["revenue"], r["expenses"], r["profit"], r["profit_margin"]) == (0.0, 5.0, -5.0, None)


ITEMS = "order_id bigint, product_id bigint, quantity double, unit_price double, subtotal double"


def test_product_sales_rating_over_all_reviews_or_null(tables):
    t = tables(
        order_center__orders=(ORDERS, [(1, 1, T(2024, 1, 8, 1), 9.0, "completed", "x")]),
        order_center__order_items=(ITEMS, [(1, 10, 2.0, 3.0, 6.0), (1, 10, 1.0, 3.0, 3.0), (1, 11, 1.0, 5.0, 5.0)]),
        product_center__product_reviews=(
            "product_id bigint, rating int, review_time timestamp_ntz",
            [(10, 5, T(2020, 1, 1)), (10, 2, T(2024, 1, 8))],
        ),
    )
    from tillroll.plans import products

    got = {r.product_id: r for r in products.product_sales(t, W).collect()}
    assert (got[10].units_sold, got[10].revenue, got[10].avg_rating) == (3.0, 9.0, 3.5)
    assert got[11].avg_rating is None


def test_category_performance_item_weighted_mean(tables):
    t = tables(
        order_center__orders=(ORDERS, [(1, 1, T(2024, 1, 8, 1), 0.0, "completed", "x")]),
        order_center__order_items=(ITEMS, [(1, 10, 1.0, 1.0, 1.0), (1, 10, 1.0, 1.0, 1.0), (1, 11, 1.0, 4.0, 4.0)]),
        product_center__products=("product_id bigint, category string", [(10, "a"), (11, "a")]),
    )
    from tillroll.plans import products

    (r,) = products.category_performance(t, W).collect()
    assert (r.total_sales, r.product_count, r.avg_price) == (6.0, 2, 2.0)


def test_retention_keeps_logins_before_signup(tables):
    t = tables(
        user_center__registered_users=(
            "user_id bigint, register_time timestamp_ntz",
            [(1, T(2024, 1, 8, 10)), (2, T(2024, 1, 8, 11)), (3, T(2024, 1, 9, 1))],
        ),
        user_center__login_history=(
            "user_id bigint, login_time timestamp_ntz",
            [(1, T(2024, 1, 7, 23)), (1, T(2024, 1, 10)), (1, T(2024, 1, 10, 5)), (2, T(2024, 1, 10))],
        ),
    )
    got = {(r.cohort_date, r.days_since_signup): (r.user_count, r.retention_rate) for r in users.user_retention(t, W).collect()}
    assert got == {(D(2024, 1, 8), -1): (1, 0.5), (D(2024, 1, 8), 2): (2, 1.0)}


def test_lifetime_value_having_boundary(tables):
    t = tables(
        finance__revenue=(
            "order_id bigint, user_id bigint, amount double, revenue_date timestamp_ntz",
            [
                (1, 1, 10.0, T(2023, 5, 1)),
                (2, 1, 20.0, T(2024, 1, 8, 3)),
                (3, 2, 5.0, T(2024, 1, 8, 4)),
                (4, 2, 5.0, T(2024, 1, 9)),  # later purchase: user 2's max is outside
                (2, 1, 20.0, T(2024, 1, 8, 5)),  # second payment of order 2
            ],
        )
    )
    (r,) = finance.customer_lifetime_value(t, W).collect()
    assert (r.user_id, r.total_revenue, r.purchase_count) == (1, 50.0, 2)
    assert (r.first_purchase_date, r.last_purchase_date) == (T(2023, 5, 1), T(2024, 1, 8, 5))


def test_exact_price_history_closes_the_previous_batch(tables):
    from tillroll.plans import products

    t = tables(
        raw_data__price_change_logs=(
            "product_id bigint, new_price double, change_time timestamp_ntz, change_reason string",
            [(1, 10.0, T(2024, 1, 7, 12), "a"), (1, 11.0, T(2024, 1, 8, 1), "b"), (1, 12.0, T(2024, 1, 8, 2), "c"),
             (2, 5.0, T(2024, 1, 6), "d"), (1, 13.0, T(2024, 1, 9, 5), "future")],
        )
    )
    as_written = {(r.price, r.effective_to) for r in products.product_price_history(t, W).collect()}
    assert as_written == {(11.0, T(2024, 1, 8, 2)), (12.0, None)}
    exact = {(r.price, r.effective_to) for r in products.product_price_history_exact(t, W).collect()}
    assert exact == {(10.0, T(2024, 1, 8, 1)), (11.0, T(2024, 1, 8, 2)), (12.0, None)}


def test_user_acquisition_reweighting_matches_brute_force(tables):
    users_rows = [(1, T(2024, 1, 8, 1), "web"), (2, T(2024, 1, 8, 2), "web"), (3, T(2024, 1, 8, 3), "ads")]
    order_rows = [(10, 1, T(2024, 1, 8, 5), 1.0), (11, 1, T(2024, 1, 8, 6), 1.0), (12, 3, T(2024, 1, 9), 1.0)]
    metric_rows = [("web", T(2024, 1, 8, 1), 2.5), ("web", T(2024, 1, 8, 9), 0.25), ("ads", T(2024, 1, 7), 9.0)]
    t = tables(
        user_center__registered_users=("user_id bigint, register_time timestamp_ntz, referral_source string", users_rows),
        order_center__orders=("order_id bigint, user_id bigint, order_time timestamp_ntz, total_amount double", order_rows),
        raw_data__marketing_metrics=("source string, event_date timestamp_ntz, cost double", metric_rows),
    )
    got = {r.source: r for r in marketing.user_acquisition(t, W).collect()}
    for source in ("web", "ads"):
        us = [u for u in users_rows if u[2] == source]
        rows = []
        for u in us:
            os_ = [o for o in order_rows if o[1] == u[0] and o[2].date() == u[1].date()] or [None]
            ms = [m for m in metric_rows if m[0] == source and m[1].date() == u[1].date()] or [None]
            rows += [(u, o, m) for o in os_ for m in ms]
        n = len({u[0] for u in us})
        conv = len({o[0] for _u, o, _m in rows if o}) / n
        costs = [m[2] for _u, _o, m in rows if m]
        cost = (sum(costs) / n) if costs else None
        r = got[source]
        assert r.new_users == n and abs(r.conversion_rate - conv) < 1e-12
        assert (r.acquisition_cost is None and cost is None) or abs(r.acquisition_cost - cost) < 1e-12
    exact = {r.source: r for r in marketing.user_acquisition_exact(t, W).collect()}
    assert exact["web"].acquisition_cost == 2.75 / 2 and exact["ads"].acquisition_cost is None


def test_stock_update_deducts_completed_orders_only(tables):
    t = tables(
        order_center__orders=(
            "order_id bigint, order_time timestamp_ntz, status string, warehouse_id bigint",
            [(1, T(2024, 1, 8, 1), "completed", 7), (2, T(2024, 1, 8, 2), "pending", 7), (3, T(2024, 1, 8), "completed", 8)],
        ),
        order_center__order_items=(ITEMS, [(1, 5, 2.0, 1.0, 2.0), (1, 5, 1.0, 1.0, 1.0), (2, 5, 4.0, 1.0, 4.0), (3, 6, 1.0, 1.0, 1.0)]),
        inventory__product_inventory=(
            "product_id bigint, warehouse_id bigint, quantity double, last_updated timestamp_ntz",
            [(5, 7, 10.0, T(2020, 1, 1)), (5, 8, 10.0, T(2020, 1, 1)), (6, 7, 1.0, T(2020, 1, 1))],
        ),
    )
    got = rows(inventory.update_inventory_after_order(t, W), "product_id", "warehouse_id", "quantity", "last_updated")
    assert got == [(5, 7, 7.0, T(2024, 1, 30)), (5, 8, 10.0, T(2020, 1, 1)), (6, 7, 1.0, T(2020, 1, 1))]


def test_updates_preserve_rows_and_columns(spark):
    from tests.conftest import SF_SMALL
    from tillroll.plans.registry import JOBS
    from tillroll.sources.fixtures import fixture_tables

    for job in (j for j in JOBS if j.kind == "update"):
        t = fixture_tables(spark, SF_SMALL, job.profile)
        before = t[job.target]
        after = job.fn(t, job.window)
        assert after.columns == before.columns, job.name
        assert after.count() == before.count(), job.name
        # rows the update does not touch keep every value
        key = before.columns[0] if job.name != "update_inventory_after_order" else None
        changed = after.exceptAll(before).count()
        assert changed <= before.count(), job.name
        assert changed > 0, job.name  # each fixture window changes something
        if key:
            assert after.select(key).distinct().count() == before.select(key).distinct().count()


def test_exact_variants_equal_as_written_without_fanout(tables):
    # one order per (user, day), one campaign row, one payment per order
    t = tables(
        raw_data__user_events=(EVENTS, [(1, T(2024, 1, 8, 1), "add_to_cart"), (2, T(2024, 1, 8, 2), "begin_checkout")]),
        order_center__orders=(ORDERS, [(10, 1, T(2024, 1, 8, 5), 5.0, "completed", "x")]),
        marketing__campaigns=("campaign_id bigint", [(1,)]),
        raw_data__marketing_metrics=(
            "campaign_id bigint, user_id bigint, event_date timestamp_ntz, event_type string, event_count bigint, cost double",
            [(1, 1, T(2024, 1, 8, 1), "impression", 3, 1.5), (1, 2, T(2024, 1, 8, 1), "click", 1, 0.5)],
        ),
        payment_center__payments=(
            "payment_id bigint, order_id bigint, user_id bigint, amount double, payment_time timestamp_ntz, status string",
            [(1, 10, 1, 5.0, T(2024, 1, 8, 6), "completed")],
        ),
    )

    def same(a, b):
        return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))

    assert same(orders.order_conversion(t, W), orders.order_conversion_exact(t, W))
    assert same(marketing.campaign_performance(t, W), marketing.campaign_performance_exact(t, W))
    assert same(finance.revenue_recognition(t, W), finance.revenue_recognition_exact(t, W))
