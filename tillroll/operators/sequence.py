"""Per-key ordered operators that stay split when one key is hot.

``lead_time`` is ``LEAD(ts) OVER (PARTITION BY key ORDER BY ts)``. A plain
window sends every row of a key to one task; if one product holds a third of
all rows, that task does a third of the work. Here the window is partitioned
by (key, minute), and the last row of each minute takes the first instant of
the key's next non-empty minute, found the same way one level up (one row
per minute, bucketed by day); only one row per (key, day) meets a plain
per-key window. The result equals the plain LEAD.

``top1_by_count`` picks, per group, the value with the highest count (ties:
smallest value) with a ``min(struct)`` aggregate, which is partially
aggregated before the shuffle instead of sorting each group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The bucket widths of lead_time, finest first, in minutes
# (minute, day): the middle level holds at most 1,440 rows per (key, day).
DEFAULT_BUCKET_MINUTES = (1, 1440)

# the bucket of rows without an instant: before all others, as NULLs sort
_NO_INSTANT = -(2**62)


def _wall_minutes(ts: str) -> Column:
    """Wall-clock minute index (calendar day x 1440 + hour x 60 + minute): no
    time-zone conversion for TIMESTAMP_NTZ, and monotonic in the instant."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def lead_time(
    df: DataFrame,
    key: str,
    ts: str,
    out: str,
    bucket_minutes: tuple[int, ...] = DEFAULT_BUCKET_MINUTES,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """``LEAD(ts) OVER (PARTITION BY key ORDER BY ts, ties)`` without sending
    a key's rows to one task.

    Rows are bucketed by the first width; LEAD runs within (key, bucket).
    The last row of a bucket takes the first instant of the key's next
    non-empty bucket, which is itself a LEAD, over one row per bucket, so it
    is computed the same way with the next, coarser width. Only the coarsest
    level uses a plain window per key, over one row per non-empty bucket
    (e.g. per day with changes).

    Full rows are shuffled once, by (filled key, null flag, bucket): those are
    real columns, so the LEAD and the join that brings the next bucket's
    instant back use one partitioning. The buckets' first instants come from
    a second, pruned read of key and instant, reduced before it is shuffled.
    Rows with equal instants share every bucket; ``ties`` (other columns,
    smallest first) decide their order, and rows equal in those too are
    alike."""
    marked = _bucketed(df, key, ts, bucket_minutes[0], 0)
    return _lead(marked, key, ts, out, bucket_minutes, ties, 0).drop(*_names(0)[:3])


def _names(level: int) -> tuple[str, ...]:
    return tuple(f"__{name}{level}" for name in ("key", "null", "bucket", "first", "next", "last"))


def _bucketed(df: DataFrame, key: str, ts: str, width: int, level: int) -> DataFrame:
    """``df`` with the key without NULLs, its NULL flag and the bucket: SQL
    puts NULL keys (and NULL instants) in a partition too, and a join on real
    columns keeps the partitioning that a null-safe one would lose."""
    filled, null, bucket = _names(level)[:3]
    blank = F.lit("" if dict(df.dtypes)[key] == "string" else 0).cast(dict(df.dtypes)[key])
    minute = F.floor(_wall_minutes(ts) / F.lit(width)).cast("long")
    return df.select(
        "*",
        F.coalesce(F.col(key), blank).alias(filled),
        F.col(key).isNull().alias(null),
        F.coalesce(minute, F.lit(_NO_INSTANT)).alias(bucket),
    )


def _lead(df: DataFrame, key: str, ts: str, out: str, widths: tuple[int, ...], ties: tuple[str, ...], level: int) -> DataFrame:
    filled, null, bucket, first, nxt, last = _names(level)
    order = [F.col(ts).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in ties]]
    in_bucket = Window.partitionBy(filled, null, bucket).orderBy(*order)
    within = df.select("*", F.lead(ts).over(in_bucket).alias(out), F.lead(F.lit(False), 1, True).over(in_bucket).alias(last))
    # one row per (key, bucket): its first instant
    firsts = df.groupBy(filled, null, bucket).agg(F.min(ts).alias(first))
    if len(widths) > 1:
        # bucket order is first-instant order, so the next bucket's first
        # instant is the LEAD of the firsts: the same with coarser buckets
        wider = _names(level + 1)[:3]
        coarse = firsts.select(
            "*", F.col(filled).alias(wider[0]), F.col(null).alias(wider[1]),
            F.coalesce(F.floor(_wall_minutes(first) / F.lit(widths[1])).cast("long"), F.lit(_NO_INSTANT)).alias(wider[2]),
        )
        linked = _lead(coarse, filled, first, nxt, widths[1:], (), level + 1)
    else:
        by_bucket = Window.partitionBy(filled, null).orderBy(F.col(bucket).asc())
        linked = firsts.withColumn(nxt, F.lead(first).over(by_bucket))
    bridge = linked.select(filled, null, bucket, nxt)
    joined = within.join(bridge, [filled, null, bucket], "left")
    filled_in = F.when(F.col(last), F.col(nxt)).otherwise(F.col(out))
    return joined.select(*df.columns, filled_in.alias(out))


def top1_by_count(counts: DataFrame, group: str, value: str, count: str, out: str) -> DataFrame:
    """From rows (group, value, count), the value with the largest count per
    group; ties go to the smallest value."""
    best: Column = F.min(F.struct((-F.col(count)).alias("neg"), F.col(value).alias("v")))
    return counts.groupBy(group).agg(best.alias("__best")).select(group, F.col("__best.v").alias(out))
