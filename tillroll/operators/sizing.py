"""Joins whose broadcast side is measured first.

Spark broadcasts a side on its own only when its *static* estimate is small;
a windowed slice of a large table is estimated at the full file size, so it
is shuffled even when a day holds a few thousand rows. ``join_small`` measures
the candidate side, rows and bytes, in one aggregate (one partial result per
partition), and broadcasts it only within ``tillroll.broadcast.maxBytes``
(default 256 MB) and ``tillroll.broadcast.maxRows``. Beyond either, the plain
join runs, where AQE re-plans at runtime and splits skewed partitions.

Bytes are those of the rows themselves: fixed-width columns by their type,
strings and nested values by their measured length. A broadcast hash join
never shuffles the big side, so a hot key on that side (one order with a
third of all items) costs nothing extra.

Only sides that a window bounds are worth a probe; a side that is history by
construction is joined plainly. A probe runs while the job is being built.
``probe_seconds`` tells how long they have taken so far.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Session keys for the broadcast caps, and their defaults.
MAX_ROWS_CONF = "tillroll.broadcast.maxRows"
DEFAULT_MAX_ROWS = 2_000_000
MAX_BYTES_CONF = "tillroll.broadcast.maxBytes"
DEFAULT_MAX_BYTES = 256 * 1024 * 1024

# Bytes of a value in a row: an 8-byte slot, and for other than
# fixed-width types an offset and the data; a row also has a header.
_SLOT = 8
_ROW_HEADER = 16
_FIXED = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")

_BUILD_RIGHT = {"inner", "left", "left_outer", "left_semi", "leftsemi", "left_anti", "leftanti", "cross"}

_spent = {"seconds": 0.0, "probes": 0}


def probe_seconds(reset: bool = False) -> tuple[float, int]:
    """Seconds and number of probes since the last reset."""
    out = (_spent["seconds"], int(_spent["probes"]))
    if reset:
        _spent.update(seconds=0.0, probes=0)
    return out


def _data_bytes(name: str, kind: str) -> Column | None:
    """Measured bytes of a column's value beyond its slot."""
    if kind in _FIXED or kind.startswith("decimal"):
        return F.lit(16) if kind.startswith("decimal") else None
    value = F.col(name) if kind in ("string", "binary") else F.to_json(F.struct(name))
    return F.coalesce(F.octet_length(value), F.lit(0)) + F.lit(_SLOT)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``."""
    began = time.perf_counter()
    varying = [b for b in (_data_bytes(n, k) for n, k in df.dtypes) if b is not None]
    total = F.lit(0)
    for b in varying:
        total = total + b
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total.cast("long")), F.lit(0)).alias("b")).first()
    _spent["seconds"] += time.perf_counter() - began
    _spent["probes"] += 1
    return row["n"], row["b"] + row["n"] * (_ROW_HEADER + _SLOT * len(df.columns))


def is_small(df: DataFrame) -> bool:
    """True iff ``df`` is measured to fit both broadcast caps."""
    conf = df.sparkSession.conf
    rows = int(conf.get(MAX_ROWS_CONF, None) or DEFAULT_MAX_ROWS)
    budget = int(conf.get(MAX_BYTES_CONF, None) or DEFAULT_MAX_BYTES)
    if rows <= 0 or budget <= 0:
        return False
    n, size = measure(df)
    return n <= rows and size <= budget


def join_small(
    big: DataFrame,
    small: DataFrame,
    on,
    how: str = "inner",
    proven: bool | None = None,
) -> DataFrame:
    """``big.join(small, on, how)``, broadcasting ``small`` if it is measured
    small. ``proven`` skips the probe when the caller already knows
    (``small`` is a subset of a side that was measured)."""
    if how.lower() in _BUILD_RIGHT:
        if proven is None:
            proven = is_small(small)
        if proven:
            small = F.broadcast(small)
    return big.join(small, on, how)
