"""Run a job into its target table: the INSERT / UPDATE half of each
reference statement.

INSERT jobs replace what their batch states (see ``sources.sinks``), so a
rerun repeats the result; UPDATE jobs rewrite the partitions they change.
Loads also write the target's columns that only later jobs fill, as NULLs.
"""

from __future__ import annotations

import datetime as dt
import inspect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.scalars import day
from tillroll.functions.window import BatchWindow, day_partition, windowed
from tillroll.operators.sizing import join_small
from tillroll.plans.inventory import PAIR, broken_pairs, repaired_rows
from tillroll.plans.registry import ADDS_TO_TODAY, BY_NAME, READS_OWN_TARGET, RECORDED_AS, SOURCE_OF, Job
from tillroll.plans.products import price_history_step
from tillroll.plans.states import between, item_parts, ltv_from_state, ltv_state, order_parts, orders_of, stats_from_state
from tillroll.session import ensure_checkpoint_dir
from tillroll.sources.schemas import CLOSED_DAY, OPEN_DAY, PARTITION_BY_HASH, PARTITION_BY_SOURCE, PARTITION_TIME, empty_table, with_extra
from tillroll.sources.sinks import (
    BATCH_DAY,
    ParquetStore,
    Store,
    replace_keys,
    rewrite_partitions,
    whole_days,
    write_days,
    write_window,
)
from tillroll.sources.tables import Tables


def _has_batch_day(job: Job) -> bool:
    """Whether the job can name its source's window day (loads and
    shipping do); other jobs without a day column are marts of a window."""
    return "batch_day" in inspect.signature(job.fn).parameters


def run_job(name: str, tables: Tables, window: BatchWindow, store: Store | str, **params) -> None:
    """Compute job ``name`` for ``window`` and write it to ``store`` (a root
    folder means Parquet folders below it). ``params`` go to the job, such as
    ``rate_percent`` of tax_calculations."""
    job = BY_NAME[name]
    table = job.target
    if isinstance(store, str):
        store = ParquetStore(tables.spark, store)
    if name in RECORDED_AS:
        table, rows_of = RECORDED_AS[name]
        write_window(store, table, rows_of(tables, window), window)
        return
    if name == "product_price_history_exact":
        _step_price_history(tables, window, store)
        return
    if job.kind == "view":
        raise ValueError(f"{name} is a view of stored tables and writes none")
    if job.kind == "update":
        rewrite_partitions(store, table, job.fn(tables, window, **params))
        return
    first, last = whole_days(window)
    day_of = PARTITION_TIME.get(table)
    if day_of is None and _has_batch_day(job):
        params["batch_day"] = BATCH_DAY
    rows = _from_state(name, tables, window, store)
    if rows is None:
        rows = job.fn(tables, window, **params)
    rows = with_extra(rows, table)
    if day_of is None and BATCH_DAY not in rows.columns:
        write_window(store, table, rows, window)
    else:
        if name in ADDS_TO_TODAY:
            first = last = _today(tables, window)
        source = (PARTITION_BY_SOURCE[table], SOURCE_OF[name]) if table in PARTITION_BY_SOURCE else None
        write_days(store, table, rows, first, last, day_of, source, name in READS_OWN_TARGET, name in ADDS_TO_TODAY)
        if table == LEDGER:
            _repair_ledger(store, last)
        if table in MAINTAINS:
            _follow(MAINTAINS[table], store, first, last)


LEDGER = "analytics.inventory_levels"
LTV_STATE, PRODUCT_STATE = "analytics.customer_ltv_state", "analytics.user_product_state"

# the state that follows a table: days of the one replace days of the other
MAINTAINS = {"finance.revenue": LTV_STATE, "order_center.orders": PRODUCT_STATE, "order_center.order_items": PRODUCT_STATE}


def _follow(state: str, store: Store, first: dt.date, last: dt.date) -> None:
    if _whole_state(state, store):
        return
    if state == PRODUCT_STATE:
        # late items tie a day to orders of earlier ones: after a rerun of an
        # old day, the parts behind it are made anew too
        latest = store.read(state).agg(F.max(BATCH_DAY)).first()[0]
        last = max(last, latest or last)
    _maintain(state, store, first, last)


def _maintain(state: str, store: Store, first: dt.date, last: dt.date) -> None:
    """Bring ``state`` up to its tables on the days ``first`` to ``last``."""
    # another registry: it reads the tables as they are now
    t = Tables.stored(store)
    w = BatchWindow(first.isoformat(), (last + dt.timedelta(days=1)).isoformat())
    if state == LTV_STATE:
        rows = ltv_state(windowed(t["finance.revenue"], "revenue_date", w))
    else:
        items = t["order_center.order_items"]
        if BATCH_DAY not in items.columns:
            return
        items = between(items.select("order_id", "product_id", BATCH_DAY), BATCH_DAY, first, last)
        orders = orders_of(t, w)
        # orders of other days are only read if a batch has items of theirs
        others = join_small(items, orders.select("order_id"), "order_id", "left_anti")
        known = orders if others.isEmpty() else t["order_center.orders"].select("order_id", "user_id", "order_time")
        own = item_parts(items, known)
        earlier = t[state].where(F.col(BATCH_DAY) < F.lit(first))
        waiting = earlier.select("user_id", "order_id", "product_id", "n", BATCH_DAY).unionByName(own)
        rows = own.unionByName(order_parts(waiting, orders))
    write_days(store, state, rows, first, last, reads_own_target=True)


def _whole_state(state: str, store: Store) -> bool:
    """A state that no load has maintained yet is built from all days; says
    whether it was."""
    if store.read(state) is not None:
        return False
    t = Tables.stored(store)
    column = day("revenue_date") if state == LTV_STATE else F.col(BATCH_DAY)
    of = t["finance.revenue" if state == LTV_STATE else "order_center.order_items"]
    if state == PRODUCT_STATE and BATCH_DAY not in of.columns:
        return True
    span = [of.agg(F.min(column).alias("a"), F.max(column).alias("b")).first()]
    if state == PRODUCT_STATE:  # orders may be later than their items
        span.append(t["order_center.orders"].agg(F.min(day("order_time")).alias("a"), F.max(day("order_time")).alias("b")).first())
    days = [x for r in span for x in r if x is not None]
    if days:
        _maintain(state, store, min(days), max(days))
    return True


def _from_state(name: str, tables: Tables, window: BatchWindow, store: Store) -> DataFrame | None:
    """The rows of a job that has a maintained state; None for others, and
    where the tables it would follow were not written by the loads."""
    if name == "customer_lifetime_value":
        state = LTV_STATE
    elif name == "user_order_stats" and BATCH_DAY in tables["order_center.order_items"].columns:
        state = PRODUCT_STATE
    else:
        return None
    _whole_state(state, store)
    stored = store.read(state)
    if stored is None:
        return None
    return ltv_from_state(stored, window) if state == LTV_STATE else stats_from_state(tables, stored, window)



def _repair_ledger(store: Store, last: dt.date) -> None:
    """After a rerun of an earlier day: the days behind ``last`` go on from
    its new balances, for the pairs whose balance there is another. Only days
    in unbroken sequence are chained (the day after a gap starts anew)."""
    ledger = store.read(LEDGER)
    part = day_partition("date")
    # the days of the table, not rows
    stored = sorted(r[0] for r in ledger.where(F.col(part) > F.lit(last)).select(part).distinct().collect())
    days = [d for i, d in enumerate(stored) if d == last + dt.timedelta(days=i + 1)]
    if not days:
        return
    changed = broken_pairs(ledger.where(F.col(part) == F.lit(last)), ledger.where(F.col(part) == F.lit(days[0])))
    ensure_checkpoint_dir(store.spark)
    changed = changed.checkpoint(eager=True)
    if changed.isEmpty():
        return
    rows = repaired_rows(changed, ledger.where(F.col(part).isin(days)), days)
    # the first day last: a rerun after a crash finds it as it was and goes on
    first = F.col(part) == F.lit(days[0])
    replace_keys(store, LEDGER, rows.withColumn(part, F.col("date")), changed, PAIR, [part, PARTITION_BY_HASH[LEDGER][0]], F.col(part).isin(days), [~first, first])


PRICES = "product_center.price_history"


def _step_price_history(tables: Tables, window: BatchWindow, store: Store) -> None:
    """Add a window to the price history, or do it again. The first run takes
    in all changes up to the window's end."""
    first, _ = whole_days(window)
    parts = [CLOSED_DAY, PARTITION_BY_HASH[PRICES][0]]
    logs, stored = tables["raw_data.price_change_logs"], store.read(PRICES)
    if stored is None:
        past = BatchWindow("0001-01-01", window.date_next)
        rows, products = price_history_step(logs, empty_table(store.spark, PRICES), past)
    elif CLOSED_DAY not in stored.columns:
        raise ValueError(f"{PRICES} was written by product_price_history; run one of the two per table")
    else:
        rows, products = price_history_step(logs, stored.where(F.col(CLOSED_DAY) >= F.lit(first)), window)
    closed = F.coalesce(F.to_date("effective_to"), F.lit(OPEN_DAY).cast("date"))
    ensure_checkpoint_dir(store.spark)
    replace_keys(store, PRICES, rows.withColumn(CLOSED_DAY, closed), products, ["product_id"], parts, F.col(CLOSED_DAY) >= F.lit(first))


def _today(tables: Tables, window: BatchWindow) -> dt.date:
    return tables.spark.range(1).select(window.today.alias("d")).first()["d"]


def main(argv: list[str] | None = None) -> None:
    """``python -m tillroll.plans.run JOB ROOT DATE DATE_NEXT [AS_OF]``; ROOT
    is a folder, or ``catalog`` for the session catalog's tables."""
    import argparse

    from pyspark.sql import SparkSession

    from tillroll.session import CLUSTER_CONF
    from tillroll.sources.sinks import CatalogStore

    parser = argparse.ArgumentParser(description="run one job into its target table")
    parser.add_argument("job", choices=sorted(BY_NAME))
    parser.add_argument("root", help="warehouse root holding <schema.table> Parquet directories, or 'catalog'")
    parser.add_argument("date")
    parser.add_argument("date_next")
    parser.add_argument("as_of", nargs="?", default=None, help="instant standing in for NOW() (default: now)")
    parser.add_argument("--tax-rate-percent", type=int, default=None)
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"tillroll-{args.job}").getOrCreate()
    for key, value in CLUSTER_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)
    store = CatalogStore(spark) if args.root == "catalog" else ParquetStore(spark, args.root)
    params = {} if args.tax_rate_percent is None else {"rate_percent": args.tax_rate_percent}
    run_job(args.job, Tables.stored(store), BatchWindow(args.date, args.date_next, args.as_of), store, **params)


if __name__ == "__main__":
    main()
