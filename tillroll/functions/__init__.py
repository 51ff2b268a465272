from tillroll.functions.scalars import Limbs, as_double, day, dsum, exact, minus, or_zero, plus, ratio, running, times, total, unscale
from tillroll.functions.window import BatchWindow, in_days, in_window, since, ts_literal, windowed, windowed_days

__all__ = [
    "BatchWindow",
    "Limbs",
    "in_days",
    "in_window",
    "since",
    "ts_literal",
    "windowed",
    "windowed_days",
    "as_double",
    "day",
    "dsum",
    "exact",
    "minus",
    "or_zero",
    "plus",
    "ratio",
    "running",
    "times",
    "total",
    "unscale",
]
