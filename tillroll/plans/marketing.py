"""Marketing jobs: email metrics, campaign performance, acquisition, status.

The as-written campaign and acquisition queries join event rows to every
same-day order of the user (and acquisition also to every same-day metric
row of the source), then aggregate, so each measure is counted once per
partner row. Those products are never built here: each side is reduced to
one row per join key first (row count, distinct ids, summed money), and the
measures are re-weighted by the partner counts, which gives the same sums.
Distinct order counts rely on order_id being the key of orders (an order
has one user and one order time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import BatchWindow, day, dsum, exact, ratio, times, total, unscale, windowed, windowed_days
from tillroll.operators.changes import apply_where
from tillroll.operators.sizing import join_small
from tillroll.sources.schemas import conform
from tillroll.sources.tables import Tables


def email_metrics(t: Tables, w: BatchWindow) -> DataFrame:
    """Per (campaign, send day): recipients, distinct openers and clickers
    of the campaign (events are joined on campaign only), and rates."""
    sends = (
        windowed(t["marketing.email_campaigns"], "sent_time", w)
        .groupBy("campaign_id", day("sent_time").alias("date"))
        .agg(F.sum("recipient_count").alias("emails_sent"))
    )
    campaigns = sends.where(F.col("campaign_id").isNotNull()).select("campaign_id").distinct()
    events = join_small(t["raw_data.email_events"], campaigns, "campaign_id", "left_semi")
    user_if = lambda kind: F.when(F.col("event_type") == kind, F.col("user_id"))
    reach = events.groupBy("campaign_id").agg(
        F.count_distinct(user_if("open")).alias("opens"),
        F.count_distinct(user_if("click")).alias("clicks"),
    )
    opens = F.coalesce(F.col("opens"), F.lit(0))
    clicks = F.coalesce(F.col("clicks"), F.lit(0))
    out = sends.join(reach, "campaign_id", "left").select(
        "campaign_id",
        "date",
        "emails_sent",
        opens.alias("open_count"),
        clicks.alias("click_count"),
        ratio(opens, "emails_sent").alias("open_rate"),
        ratio(clicks, "emails_sent").alias("click_rate"),
    )
    return conform(out, "analytics.email_performance")


def _same_day_orders(t: Tables, w: BatchWindow) -> DataFrame:
    """Per (user, day) of the window's days: order rows, distinct order ids,
    summed order amount."""
    return (
        windowed_days(t["order_center.orders"], "order_time", w)
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id", day("order_time").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("order_rows"),
            F.count_distinct("order_id").alias("order_ids"),
            dsum("total_amount").alias("order_revenue"),
        )
    )


def _metrics(t: Tables, w: BatchWindow) -> DataFrame:
    return windowed(t["raw_data.marketing_metrics"], "event_date", w).select(
        "campaign_id", "user_id", day("event_date").alias("date"), "event_type", "event_count", "cost"
    )


def _performance(out: DataFrame) -> DataFrame:
    spend = unscale("spend")
    roi = F.when(spend > 0, ratio(unscale("revenue"), spend)).otherwise(F.lit(0.0))
    return conform(
        out.select(
            "campaign_id",
            "date",
            "impressions",
            "clicks",
            F.coalesce(F.col("conversions"), F.lit(0)).alias("conversions"),
            spend.alias("spend"),
            unscale("revenue").alias("revenue"),
            roi.alias("roi"),
        ),
        "analytics.campaign_performance",
    )


# rows of the fan-out for each row before it
MULT = "greatest(coalesce(order_rows, 0), 1)"


def _kind(kind: str):
    return F.when(F.col("event_type") == kind, F.col("event_count")).otherwise(F.lit(0))


def campaign_performance(t: Tables, w: BatchWindow) -> DataFrame:
    """As written: campaigns JOIN metrics LEFT JOIN same-day orders of the
    user, grouped by (campaign, day)."""
    campaign_rows = t["marketing.campaigns"].groupBy("campaign_id").agg(F.count(F.lit(1)).alias("k"))
    metrics = _metrics(t, w).join(campaign_rows, "campaign_id")
    k = F.col("k")
    per_user = metrics.groupBy("campaign_id", "date", "user_id").agg(
        F.sum(k * _kind("impression")).alias("imp"),
        F.sum(k * _kind("click")).alias("clk"),
        total(times("k", exact("cost"))).alias("cost"),
        F.sum(k).alias("rows"),
    )
    orders = _same_day_orders(t, w)
    joined = per_user.join(orders, ["user_id", "date"], "left")
    mult = F.expr(MULT)
    out = joined.groupBy("campaign_id", "date").agg(
        F.sum(F.col("imp") * mult).alias("impressions"),
        F.sum(F.col("clk") * mult).alias("clicks"),
        F.sum("order_ids").alias("conversions"),
        total(times(MULT, "cost")).alias("spend"),
        total(times("rows", "order_revenue")).alias("revenue"),
    )
    return _performance(out)


def campaign_performance_exact(t: Tables, w: BatchWindow) -> DataFrame:
    """Metrics summed once per (campaign, day); each same-day order of an
    active user attributed once per (campaign, day)."""
    campaigns = t["marketing.campaigns"].select("campaign_id")
    metrics = _metrics(t, w).join(campaigns, "campaign_id", "left_semi")
    totals = metrics.groupBy("campaign_id", "date").agg(
        F.sum(_kind("impression")).alias("impressions"),
        F.sum(_kind("click")).alias("clicks"),
        dsum("cost").alias("spend"),
    )
    users = metrics.where(F.col("user_id").isNotNull()).select("campaign_id", "date", "user_id").distinct()
    attributed = (
        users.join(_same_day_orders(t, w), ["user_id", "date"])
        .groupBy("campaign_id", "date")
        .agg(F.sum("order_ids").alias("conversions"), total("order_revenue").alias("revenue"))
    )
    return _performance(totals.join(attributed, ["campaign_id", "date"], "left"))


def _signups(t: Tables, w: BatchWindow) -> DataFrame:
    """Registered users of the window, one row per (day, source, user) with
    the number of user rows."""
    return (
        windowed(t["user_center.registered_users"], "register_time", w)
        .groupBy(day("register_time").alias("date"), F.col("referral_source").alias("source"), "user_id")
        .agg(F.count(F.lit(1)).alias("user_rows"))
    )


def _source_cost(t: Tables, w: BatchWindow) -> DataFrame:
    return (
        windowed_days(t["raw_data.marketing_metrics"], "event_date", w)
        .groupBy("source", day("event_date").alias("date"))
        .agg(dsum("cost").alias("source_cost"))
    )


def _acquisition(signups: DataFrame, t: Tables, w: BatchWindow, as_written: bool) -> DataFrame:
    joined = signups.join(_same_day_orders(t, w), ["user_id", "date"], "left")
    mult = F.greatest(F.coalesce(F.col("order_rows"), F.lit(0)), F.lit(1))
    per_group = joined.groupBy("date", "source").agg(
        F.count("user_id").alias("new_users"),
        F.sum(F.coalesce(F.col("order_ids"), F.lit(0))).alias("orders"),
        F.sum(F.col("user_rows") * mult).alias("fanout"),
    )
    with_cost = per_group.join(_source_cost(t, w), ["source", "date"], "left")
    cost = times("fanout", "source_cost") if as_written else "source_cost"
    out = with_cost.select(
        "date",
        "source",
        "new_users",
        ratio("orders", "new_users").alias("conversion_rate"),
        ratio(unscale(cost), "new_users").alias("acquisition_cost"),
    )
    return conform(out, "analytics.user_acquisition")


def user_acquisition(t: Tables, w: BatchWindow) -> DataFrame:
    """As written: users LEFT JOIN same-day orders LEFT JOIN same-day metrics
    of the source; the source's cost is counted once per (user row, order
    row) pair."""
    return _acquisition(_signups(t, w), t, w, as_written=True)


def user_acquisition_exact(t: Tables, w: BatchWindow) -> DataFrame:
    """New users, same-day orders per new user, and the source's same-day
    cost per new user, each aggregated independently."""
    return _acquisition(_signups(t, w), t, w, as_written=False)


def update_campaign_status(t: Tables, w: BatchWindow) -> DataFrame:
    """Snapshot of campaigns: active ones that ended before today are
    completed. No join needed; one pass over the table."""
    done = (F.col("status") == "active") & (F.col("end_date") < w.today)
    return apply_where(t["marketing.campaigns"], done, {"status": F.lit("completed")})
