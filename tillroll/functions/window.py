"""The half-open batch window every job runs over."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ts_text(value: str | dt.date | dt.datetime) -> str:
    if isinstance(value, dt.datetime):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(value, dt.date):
        return value.strftime("%Y-%m-%d 00:00:00")
    text = str(value).strip()
    return text if " " in text else text + " 00:00:00"


def ts_literal(value: str | dt.date | dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal; constant-folded, so range filters on a
    timestamp column reach the Parquet scan as PushedFilters."""
    return F.expr(f"TIMESTAMP_NTZ'{_ts_text(value)}'")


@dataclass(frozen=True)
class BatchWindow:
    """``[date, date_next)`` plus the instant that stands in for NOW().

    ``as_of`` replaces CURRENT_DATE()/NOW() so reruns are reproducible; when
    it is None the session clock is used.
    """

    date: str
    date_next: str
    as_of: str | None = None

    @property
    def lo(self) -> Column:
        return ts_literal(self.date)

    @property
    def hi(self) -> Column:
        return ts_literal(self.date_next)

    @property
    def first_day(self) -> Column:
        return self.lo.cast("date")

    @property
    def last_day(self) -> Column:
        # last calendar day that has an instant inside the window
        return F.expr(f"TIMESTAMP_NTZ'{_ts_text(self.date_next)}' - INTERVAL 1 MICROSECOND").cast("date")

    @staticmethod
    def days_before(w: "BatchWindow", n: int) -> "BatchWindow":
        """The ``n`` whole calendar days before ``w`` starts."""
        start = dt.date.fromisoformat(w.date[:10])
        return BatchWindow((start - dt.timedelta(days=n)).isoformat(), start.isoformat(), w.as_of)

    @property
    def now(self) -> Column:
        return ts_literal(self.as_of) if self.as_of else F.localtimestamp()

    @property
    def today(self) -> Column:
        return self.now.cast("date")


# Fixed value: a table partitioned by the calendar day of one of its time
# columns names the partition column after it: <column>__day.
DAY_SUFFIX = "__day"


def day_partition(col: str) -> str:
    return f"{col}{DAY_SUFFIX}"


def _prune(df: DataFrame, col: str, lo: Column, hi: Column) -> Column | None:
    part = day_partition(col)
    return (F.col(part) >= lo) & (F.col(part) <= hi) if part in df.columns else None


def windowed(df: DataFrame, col: str, w: BatchWindow) -> DataFrame:
    """``df`` restricted to ``col`` in the window. If ``df`` is partitioned
    by the day of ``col``, the matching partition bounds are added, so whole
    days outside the window are never listed or opened (PartitionFilters)."""
    cond = in_window(col, w)
    extra = _prune(df, col, w.first_day, w.last_day)
    return df.where(cond if extra is None else cond & extra)


def windowed_days(df: DataFrame, col: str, w: BatchWindow) -> DataFrame:
    """``df`` restricted to the calendar days the window touches."""
    cond = in_days(col, w)
    extra = _prune(df, col, w.first_day, w.last_day)
    return df.where(cond if extra is None else cond & extra)


def since(df: DataFrame, col: str, first: Column) -> DataFrame:
    """``df`` where ``col >= first`` (a day), pruned by day partition."""
    cond = F.col(col) >= first
    part = day_partition(col)
    return df.where(cond & (F.col(part) >= first) if part in df.columns else cond)


def in_days(col: str | Column, w: BatchWindow) -> Column:
    """``col`` falls on a calendar day that the window touches (for joins
    on ``DATE(col) = DATE(windowed column)``)."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= w.first_day.cast("timestamp_ntz")) & (c < F.date_add(w.last_day, 1).cast("timestamp_ntz"))


def in_window(col: str | Column, w: BatchWindow) -> Column:
    """``col >= date AND col < date_next`` on the raw column (sargable)."""
    c = F.col(col) if isinstance(col, str) else col
    return (c >= w.lo) & (c < w.hi)
