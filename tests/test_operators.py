"""Operators against brute force: bucketed LEAD, size-checked joins, top-1,
snapshot updates, and the stock-ledger invariants."""

import datetime as dt
import random
import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.functions.window import BatchWindow
from tillroll.operators.changes import apply_changes
from tillroll.operators.sequence import lead_time, top1_by_count
from tillroll.operators.sizing import MAX_BYTES_CONF, MAX_ROWS_CONF, is_small, join_small, measure, probe_seconds
from tillroll.plans import inventory
from tillroll.plans.registry import BY_NAME
from tillroll.sources.fixtures import fixture_tables

T = dt.datetime


def test_lead_time_equals_plain_lead_with_a_hot_key(spark):
    rnd = random.Random(7)
    base = T(2024, 1, 1)
    data = []
    for i in range(600):
        key = 1 if i < 300 else rnd.choice([2, 3, None])  # key 1 holds half the rows
        # a burst: most of the hot key's rows fall in one minute
        burst = key == 1 and i < 200
        ts = base + dt.timedelta(seconds=rnd.randint(0, 59) if burst else rnd.randint(0, 5 * 86400))
        data.append((i, key, ts))
    data.append((1000, 1, None))  # a NULL instant
    df = spark.createDataFrame(data, "id long, k long, ts timestamp_ntz")
    plain = df.withColumn("nxt", F.lead("ts").over(Window.partitionBy("k").orderBy("ts")))
    bucketed = lead_time(df, "k", "ts", "nxt")
    want = sorted(tuple(r) for r in plain.select("id", "nxt").collect())
    got = sorted(tuple(r) for r in bucketed.select("id", "nxt").collect())
    assert got == want
    wide = lead_time(df, "k", "ts", "nxt", bucket_minutes=(7 * 60,))
    assert sorted(tuple(r) for r in wide.select("id", "nxt").collect()) == want
    odd = lead_time(df, "k", "ts", "nxt", bucket_minutes=(5, 45, 600))
    assert sorted(tuple(r) for r in odd.select("id", "nxt").collect()) == want


def test_join_small_paths_agree(spark):
    big = spark.range(0, 5000).select((F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    small = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = sorted(tuple(r) for r in join_small(big, small, "k", how, proven=True).collect())
        b = sorted(tuple(r) for r in join_small(big, small, "k", how, proven=False).collect())
        assert a == b
    plan = join_small(big, small, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_broadcast_bound_is_measured(spark):
    rows = [(i, "x" * 1000, None if i % 2 else [i] * 10) for i in range(50)]
    df = spark.createDataFrame(rows, "k long, s string, a array<int>")
    n, size = measure(df)
    assert n == 50 and 50 * 1000 < size < 50 * 1300  # long strings count in full
    probe_seconds(reset=True)
    try:
        for conf, value, want in ((MAX_ROWS_CONF, "50", True), (MAX_ROWS_CONF, "49", False), (MAX_BYTES_CONF, "40000", False), (MAX_BYTES_CONF, str(size), True)):
            spark.conf.set(conf, value)
            assert is_small(df) is want
            spark.conf.unset(conf)
        assert probe_seconds()[1] == 4
        spark.conf.set(MAX_ROWS_CONF, "0")
        assert not is_small(df) and probe_seconds()[1] == 4  # off: no probe
    finally:
        spark.conf.unset(MAX_ROWS_CONF)
        spark.conf.unset(MAX_BYTES_CONF)


def test_no_job_probes_more_than_twice(spark):
    for job in BY_NAME.values():
        t = fixture_tables(spark, SF_SMALL, job.profile)
        for name in ("finance.revenue", "finance.expenses", "analytics.user_activity_summary"):
            t[name]  # filled by other jobs: their probes are not this job's
        probe_seconds(reset=True)
        job.fn(t, job.window)
        assert probe_seconds()[1] <= 2, job.name


def test_sums_equal_decimal_sums(spark):
    from decimal import Decimal

    from tillroll.functions.scalars import dsum, unscale

    values = ["16917783.19", "-98765432101.12", "0.00004", "12.345678", "-0.00005", "-7.654321", "0.1", "0.2", "-0.000001", "123456789.123456"]
    want = float(sum(map(Decimal, values)))
    df = spark.createDataFrame([(float(v), Decimal(v), 3) for v in values] + [(None, None, None)], "d double, n decimal(20,6), i int")
    got = df.agg(unscale(dsum("d")).alias("d"), unscale(dsum("n")).alias("n"), unscale(dsum("i")).alias("i")).first()
    assert (got.d, got.n, got.i) == (want, want, 3.0 * len(values))


def test_wide_sums_equal_decimal_sums(spark):
    """Values and sums of any size against Python's decimals: up to nine
    decimals and 15 digits, what has more is rounded half up."""
    from decimal import ROUND_HALF_UP, Decimal

    from tillroll.functions.scalars import dsum, exact, minus, plus, times, unscale

    rnd = random.Random(11)
    values = [0.0, -0.0, 1e15, -1e15, 9.3e12, 1234567890123.45, 0.123456789, 0.12345678951, 0.12345678849, -0.0000000006, 3 * 0.1, 7 * 19.99, 2.0**53, 1e16, 123456789012.123, 1048575.999999999, 1048577.123456789, 0.29, 1.005, -1.005]
    for _ in range(2000):
        whole = rnd.randint(0, 13)
        values.append(float(f"{rnd.uniform(-1, 1) * 10**whole:.{rnd.randint(0, 9 if whole <= 6 else 6 if whole <= 9 else 3 if whole <= 12 else 1)}f}"))
    values += [0.1 * 3, 45.0 * 104949.5, 50 * 104949.51, 7 * 1234567.89, 1e-9, 4e-10, 6e-10, 123456.7, 99999999.9999999]

    def unit(v):
        decimals = next((d for below, d in ((1e6, 9), (1e9, 6), (1e12, 3)) if abs(v) < below), 2)
        return Decimal(repr(v)).quantize(Decimal(1).scaleb(-decimals), ROUND_HALF_UP)

    units = [unit(v) for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double")
    got = df.select("i", exact("v").alias("x")).select("i", "x.*").orderBy("i").collect()
    assert [Decimal(r.hundredths).scaleb(-2) + Decimal(r.rest).scaleb(-9) for r in got] == units
    assert all(0 <= r.rest < 10**7 for r in got)
    back = df.select("i", unscale(exact("v")).alias("x")).orderBy("i").collect()
    assert [r.x for r in back] == [float(u) for u in units]
    sums = df.groupBy((df.i % 7).alias("k")).agg(dsum("v").alias("s"), dsum("-v").alias("t"))
    sums = sums.select("k", unscale("s").alias("s"), unscale(plus("s", times("3", "s"))).alias("four"), unscale(minus("s", "t")).alias("two"))
    for r in sums.collect():
        want = sum(u for i, u in enumerate(units) if i % 7 == r.k)
        assert (r.s, r.four, r.two) == (float(want), float(4 * want), float(2 * want))
    month = spark.range(2_000_000).select(F.lit(8_388_608.07).alias("v")).agg(unscale(dsum("v")).alias("s")).first()
    assert month.s == float(Decimal("8388608.07") * 2_000_000)


def test_lead_time_breaks_ties_by_the_given_columns(spark):
    at = T(2024, 1, 1, 5)
    rows = [(1, at, 3.0), (1, at, 1.0), (1, at, 2.0), (1, at + dt.timedelta(days=40), 0.5)]
    for order in (rows, rows[::-1], [rows[1], rows[3], rows[0], rows[2]]):
        df = spark.createDataFrame(order, "k long, ts timestamp_ntz, p double").repartition(3)
        got = {r.p: r.nxt for r in lead_time(df, "k", "ts", "nxt", ties=("p",)).collect()}
        assert got == {1.0: at, 2.0: at, 3.0: rows[3][1], 0.5: None}


def test_conversion_with_a_third_of_all_events_on_one_user(spark, tables):
    from tillroll.plans import orders

    rnd = random.Random(8)
    kinds = ("add_to_cart", "begin_checkout", "view")
    when = lambda: T(2024, 1, 8 + rnd.randint(0, 2), rnd.randint(0, 23))
    events = [(7 if i % 3 == 0 else rnd.choice([None, 1, 2, 3, 4]), when(), rnd.choice(kinds)) for i in range(3000)]
    placed = [(i % 90, 7 if i % 3 == 0 else rnd.choice([None, 1, 2, 9]), when()) for i in range(120)]
    placed = [(i, u, d) for (i, u), d in {(i, u): d for i, u, d in placed}.items()]
    placed = list({i: (i, u, d) for i, u, d in placed}.values())
    t = tables(
        raw_data__user_events=("user_id bigint, event_time timestamp_ntz, event_type string", events),
        order_center__orders=("order_id bigint, user_id bigint, order_time timestamp_ntz", placed),
    )
    w = BatchWindow("2024-01-08", "2024-01-11")
    want = {}
    for u, at, kind in events:
        same = [o for o, x, d in placed if x is not None and x == u and d.date() == at.date()]
        day = want.setdefault(at.date(), [0, 0, 0, 0, set()])
        for k, name in enumerate(kinds[:2]):
            day[k] += (kind == name) * max(1, len(same))
            day[2 + k] += kind == name
        day[4] |= set(same)
    written = {r.date: (r.cart_additions, r.checkout_starts, r.orders_completed) for r in orders.order_conversion(t, w).collect()}
    exact = {r.date: (r.cart_additions, r.checkout_starts, r.orders_completed) for r in orders.order_conversion_exact(t, w).collect()}
    assert written == {d: (v[0], v[1], len(v[4])) for d, v in want.items()}
    assert exact == {d: (v[2], v[3], len(v[4])) for d, v in want.items()}


def test_top1_by_count_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "b", 3), (1, "a", 3), (1, "c", 1), (2, "z", 1), (3, None, 5), (3, "q", 2)],
        "g long, v string, n long",
    )
    got = dict(tuple(r) for r in top1_by_count(df, "g", "v", "n", "best").collect())
    assert got == {1: "a", 2: "z", 3: None}


def test_apply_changes_preserves_untouched_rows(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "c", 30)], "id long, s string, q long")
    changes = spark.createDataFrame([(1, 5), (9, 1)], "id long, d long")
    out = apply_changes(target, changes, ["id"], {"q": F.col("q") - F.col("d"), "s": F.lit("x")})
    assert out.columns == ["id", "s", "q"]
    assert sorted(out.collect(), key=repr) == sorted(
        [(1, "x", 5), (2, "b", 20), (None, "c", 30)], key=repr
    )


def _ledger(spark, window, prior=None):
    t = fixture_tables(spark, SF_SMALL)
    if prior is not None:
        t = t.override(analytics__inventory_levels=prior)
    return inventory.inventory_levels(t, window)


def test_ledger_balances_and_chains(spark):
    w = BY_NAME["inventory_levels"].window
    rows = _ledger(spark, w).collect()
    assert rows
    by_pair = {}
    for r in rows:
        assert abs(
            r.beginning_quantity + r.receipts - r.sales + r.adjustments + r.transfers_in - r.transfers_out
            - r.ending_quantity
        ) < 1e-6
        by_pair.setdefault((r.warehouse_id, r.product_id), []).append(r)
    for seq in by_pair.values():
        seq.sort(key=lambda r: r.date)
        for prev, nxt in zip(seq, seq[1:]):
            assert (nxt.date - prev.date).days == 1
            assert nxt.beginning_quantity == prev.ending_quantity


def test_single_day_chain_equals_backfill(spark):
    backfill = BatchWindow("1996-06-03", "1996-06-07", "2024-01-30")
    want = sorted(tuple(r) for r in _ledger(spark, backfill).collect())
    prior = None
    got = []
    for day in range(3, 7):
        w = BatchWindow(f"1996-06-{day:02d}", f"1996-06-{day + 1:02d}", "2024-01-30")
        today = _ledger(spark, w, prior)
        today = spark.createDataFrame(today.collect(), today.schema)  # the stored day, as a sink would hold it
        got.extend(tuple(r) for r in today.collect())
        prior = today
    assert sorted(got) == want


def test_transfers_balance_inside_the_grid(spark):
    rows = _ledger(spark, BY_NAME["inventory_levels"].window).collect()
    assert abs(sum(r.transfers_in for r in rows) - sum(r.transfers_out for r in rows)) < 1e-6


def test_broadcast_cap_can_force_shuffle_joins(spark):
    job = BY_NAME["category_performance"]
    want = sorted(tuple(r) for r in job.fn(fixture_tables(spark, SF_SMALL), job.window).collect())
    spark.conf.set(MAX_ROWS_CONF, "0")
    try:
        got = sorted(tuple(r) for r in job.fn(fixture_tables(spark, SF_SMALL), job.window).collect())
    finally:
        spark.conf.unset(MAX_ROWS_CONF)
    assert got == want


def test_first_payments_beyond_the_broadcast_cap_come_from_one_aggregate(spark, tables):
    """Whatever the window's size, the first completed payment decides; when
    the window's orders cannot be broadcast, payments are read once and only
    the orders are joined (each more join holds two sorts in every task)."""
    from tillroll.plans import finance

    rnd = random.Random(5)
    w = BatchWindow("2024-01-08", "2024-01-09", "2024-01-30")
    pays = [
        (i, rnd.choice([None, *range(40)]), rnd.choice([None, T(2024, 1, 7, 23), T(2024, 1, 8), T(2024, 1, 8, rnd.randrange(24)), T(2024, 1, 9), T(2024, 1, 9, 5)]),
         rnd.choice(["completed", "completed", "pending", None]))
        for i in range(120)
    ]
    placed = [(o, None if o is None else o % 7, None if o is None else o * 1.5, "card") for o in [None, *range(35), 3, 4, 4]]
    t = tables(
        payment_center__payments=("payment_id bigint, order_id bigint, payment_time timestamp_ntz, status string", pays),
        order_center__orders=("order_id bigint, user_id bigint, total_amount double, payment_method string", placed),
    )
    first = {}
    for _, order, at, status in pays:
        if order is not None and at is not None and status == "completed":
            first[order] = min(at, first.get(order, at))
    want = sorted((o, u, x, first[o], m) for o, u, x, m in placed if o in first and T(2024, 1, 8) <= first[o] < T(2024, 1, 9))
    assert want and any(at < T(2024, 1, 8) for at in first.values())

    def got():
        df = finance.revenue_recognition_exact(t, w).select("order_id", "user_id", "amount", "revenue_date", "payment_method")
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return sorted(map(tuple, df.collect())), len(re.findall(r"\bJoin\b", plan))

    assert got()[0] == want
    spark.conf.set(MAX_ROWS_CONF, "0")
    try:
        assert got() == (want, 1)
    finally:
        spark.conf.unset(MAX_ROWS_CONF)


def test_hot_key_on_the_shuffle_path_matches_brute_force(spark, tables):
    """One receipt holds most items; broadcast disabled and AQE told to treat
    tiny partitions as skewed, so the split-join path really runs."""
    from tillroll.plans import finance

    rnd = random.Random(3)
    items = [(0, float(rnd.randint(1, 5)), rnd.randint(1, 999) / 100.0) for _ in range(3000)]
    items += [(r, float(rnd.randint(1, 5)), rnd.randint(1, 999) / 100.0) for r in range(1, 200) for _ in range(3)]
    receipts = [(r, T(2024, 1, 8, r % 24), 100 + r % 7) for r in range(200)]
    t = tables(
        inventory__receipt_items=("receipt_id bigint, quantity double, unit_cost double", items),
        inventory__inventory_receipts=("receipt_id bigint, receipt_date timestamp_ntz, supplier_id bigint", receipts),
    )
    w = BatchWindow("2024-01-08", "2024-01-09")
    want = {}
    for r, q, c in items:
        want[str(r)] = want.get(str(r), 0) + round(q * c * 10000)
    conf = {
        MAX_ROWS_CONF: "0",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = finance.inventory_expense(t, w)
        got = {r.expense_id: r.amount for r in df.collect()}
        final_plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "skew=true" in final_plan, final_plan
    assert got.keys() == want.keys()
    assert all(got[k] == want[k] / 10000 for k in want)
    broadcast = {r.expense_id: r.amount for r in finance.inventory_expense(t, w).collect()}
    assert broadcast == got
