"""UPDATE as a rewrite of the partitions it touches.

Parquet tables cannot be updated in place, so an UPDATE job returns new
contents: ``target LEFT JOIN changes`` on the key, taking the new value where
a change matched and the old one elsewhere. Row count and untouched rows are
preserved. ``changes`` must hold at most one row per key; callers pass a
distinct key set or an aggregate.

On a partitioned target (as the sinks write) the result holds the whole
partitions with a changed row, which is what the sink replaces: the distinct
partition values with a match are found from the key and partition columns
alone, and a semi-join on them prunes the read of the full rows (dynamic
partition pruning). Without a partition column the whole table is returned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.window import DAY_SUFFIX
from tillroll.operators.sizing import is_small, join_small

_HIT = "__tillroll_matched"
_PARTITIONS = ("batch_day", "batch_window")


def _touched(target: DataFrame, hits: DataFrame) -> DataFrame:
    """The partitions of ``target`` that ``hits`` (some of its rows) are in."""
    parts = [c for c in target.columns if c in _PARTITIONS or c.endswith(DAY_SUFFIX)]
    if not parts:
        return target
    values = hits.select(*[F.col(c).alias(f"__{c}") for c in parts]).distinct()
    same, known = F.lit(True), F.lit(True)
    for c in parts:
        same = same & (F.col(c) == F.col(f"__{c}"))
        known = known & F.col(c).isNotNull()
    # one row for each partition of the table at most: broadcast, which lets
    # the equality prune the partitions that are listed and opened. The NULL
    # partition, which the sinks never write, is always taken along
    return target.join(F.broadcast(values), same, "left_semi").unionByName(target.where(~known))


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    set_exprs: Mapping[str, Column],
) -> DataFrame:
    """Rewrite ``target``: where ``keys`` match a row of ``changes``, set each
    column of ``set_exprs`` (expressions may use columns of either side)."""
    small = is_small(changes)
    hits = join_small(target, changes.select(*keys), list(keys), "left_semi", proven=small)
    flagged = changes.withColumn(_HIT, F.lit(True))
    joined = join_small(_touched(target, hits), flagged, list(keys), "left", proven=small)
    return _set(joined, target.columns, F.col(_HIT).isNotNull(), set_exprs)


def apply_where(target: DataFrame, cond: Column, set_exprs: Mapping[str, Column]) -> DataFrame:
    """Rewrite ``target``: set each column of ``set_exprs`` where ``cond``
    holds (NULL counts as false)."""
    return _set(_touched(target, target.where(cond)), target.columns, F.coalesce(cond, F.lit(False)), set_exprs)


def _set(df: DataFrame, columns: Sequence[str], hit: Column, set_exprs: Mapping[str, Column]) -> DataFrame:
    out = [F.when(hit, set_exprs[c]).otherwise(F.col(c)).alias(c) if c in set_exprs else F.col(c) for c in columns]
    return df.select(*out, *[F.when(hit, e).alias(c) for c, e in set_exprs.items() if c not in columns])
