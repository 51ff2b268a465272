"""User jobs: activity, retention, segments, deletion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import BatchWindow, day, dsum, ratio, unscale, windowed, windowed_days
from tillroll.operators.changes import apply_changes
from tillroll.operators.sizing import join_small
from tillroll.sources.schemas import conform
from tillroll.sources.tables import Tables

# Segment thresholds in active minutes (strictly greater).
POWER_USER_MINUTES = 120
ACTIVE_USER_MINUTES = 30


def user_activity(t: Tables, w: BatchWindow) -> DataFrame:
    """Sessions per (user, day): count, active minutes, and a JSON object of
    summed pages visited and actions."""
    sessions = windowed(t["raw_data.user_sessions"], "login_time", w)
    usage = F.to_json(
        F.struct(F.sum("pages_visited").alias("pages_visited"), F.sum("actions").alias("actions")),
        {"ignoreNullFields": "false"},
    )
    out = sessions.groupBy("user_id", day("login_time").alias("date")).agg(
        F.count(F.lit(1)).alias("login_count"),
        ratio(unscale(dsum("session_duration")), F.lit(60)).alias("active_minutes"),
        usage.alias("feature_usage"),
    )
    return conform(out, "analytics.user_activity_summary")


def user_retention(t: Tables, w: BatchWindow) -> DataFrame:
    """For users registered in the window: distinct users with a login N
    days after signup, per (signup day, N), over the signup day's cohort
    size. Logins before signup give negative N and are kept."""
    users = t["user_center.registered_users"]
    cohort = windowed(users, "register_time", w).select("user_id", "register_time")
    logins = t["user_center.login_history"].select("user_id", "login_time")
    per_day = (
        join_small(logins, cohort, "user_id")
        .groupBy(
            day("register_time").alias("cohort_date"),
            F.datediff("login_time", "register_time").alias("days_since_signup"),
        )
        .agg(F.count_distinct("user_id").alias("user_count"))
    )
    sizes = (
        windowed_days(users, "register_time", w)
        .groupBy(day("register_time").alias("cohort_date"))
        .agg(F.count_distinct("user_id").alias("total_users"))
    )
    out = per_day.join(sizes, "cohort_date").select(
        "cohort_date",
        "days_since_signup",
        "user_count",
        ratio("user_count", "total_users").alias("retention_rate"),
    )
    return conform(out, "analytics.user_retention")


def user_segments(t: Tables, w: BatchWindow) -> DataFrame:
    """One row per (registered user, activity day in the window)."""
    activity = windowed(t["analytics.user_activity_summary"], "date", w).select(
        "user_id", "active_minutes"
    )
    users = t["user_center.registered_users"].select("user_id")
    minutes = F.col("active_minutes")
    segment = (
        F.when(minutes > POWER_USER_MINUTES, "power_user")
        .when(minutes > ACTIVE_USER_MINUTES, "active_user")
        .otherwise("casual_user")
    )
    out = join_small(users, activity, "user_id").select(
        "user_id",
        segment.alias("segment_name"),
        w.today.alias("added_date"),
        (minutes / 10).alias("score"),
    )
    return conform(out, "marketing.user_segments")


def user_deletion(t: Tables, w: BatchWindow) -> DataFrame:
    """Snapshot of registered users; those with an approved deletion request
    in the window get status 0 and deletion_time = now."""
    approved = (
        windowed(t["raw_data.account_deletion_requests"], "request_time", w)
        .where(F.col("status") == "approved")
        .select("user_id")
        .distinct()
    )
    return apply_changes(
        t["user_center.registered_users"],
        approved,
        ["user_id"],
        {"status": F.lit(0), "deletion_time": w.now},
    )
