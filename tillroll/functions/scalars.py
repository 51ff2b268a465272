"""Column helpers shared by the jobs.

Money and other fractional measures are summed exactly, so a sum does not
depend on the order rows arrive in. A value is the decimal that its DOUBLE
stands for (up to nine decimals, and up to the 15 digits a DOUBLE keeps: the
rounding noise of a product is not carried on), held in two 64-bit limbs:
whole hundredths, and the rest below one in units of 1e-9 (``exact``). Sums
(``dsum``, ``total``), differences and multiples go limb by limb in plain long
arithmetic inside whole-stage codegen (Spark widens a DECIMAL sum to a
BigDecimal-backed type, which is several times slower), and the limbs need no
carry until the end: a group may hold 9e11 rows and a sum 9e16. ``unscale``
makes them the correctly rounded DOUBLE, the same value as a DECIMAL(38,9) sum
cast to DOUBLE.

Ratios follow MySQL: division by zero is NULL (``try_divide``), and integer
operands give a fractional result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

# The limbs' units, and the largest integer up to which DOUBLEs
# hold every one.
PER_HUNDREDTH = 10_000_000
_WHOLE = 1 << 53
# Below these sizes a DOUBLE keeps so many decimals (15 digits),
# in steps of three.
_KEEPS = ((1e6, 9), (1e9, 6), (1e12, 3))


class Limbs(NamedTuple):
    """An exact value as the SQL of its two limbs (one call to Spark then
    parses a whole formula)."""

    hundredths: str
    rest: str

    @property
    def column(self) -> Column:
        return F.expr(f"named_struct('hundredths', {self.hundredths}, 'rest', {self.rest})")

    def alias(self, name: str) -> Column:
        return self.column.alias(name)


def _of(value: str | Limbs) -> Limbs:
    """The limbs of a column that holds them, by name."""
    return value if isinstance(value, Limbs) else Limbs(f"{value}.hundredths", f"{value}.rest")


def exact(value: str) -> Limbs:
    """A fractional measure (DOUBLE, DECIMAL or integer; a name or SQL) in two
    limbs; what lies beyond its last decimal is rounded half up, as a cast
    does."""
    x = f"CAST({value} AS DOUBLE)"
    # almost every value has two decimals at most: nothing is left within half
    # of the last decimal it keeps
    cents = f"rint({x} * 100D)"
    plain = f"abs({x} * 100D - {cents}) < greatest(abs({x}), 1e6D) * 4.5e-14D"
    scale = "CASE " + " ".join(f"WHEN abs({x}) < {below}D THEN {10**decimals}D" for below, decimals in _KEEPS) + " ELSE 100D END"
    units = f"(signum({x}) * floor(abs({x}) * {scale} + 0.5D))"
    # the floor of the quotient is exact: units are below 2**53 / 2
    hundredths = f"floor({units} / ({scale} / 100D))"
    rest = f"({units} - {hundredths} * ({scale} / 100D)) * ({PER_HUNDREDTH}D / ({scale} / 100D))"
    return Limbs(f"CASE WHEN {plain} THEN CAST({cents} AS BIGINT) ELSE {hundredths} END", f"CASE WHEN {plain} THEN 0L ELSE CAST({rest} AS BIGINT) END")


def dsum(value: str) -> Limbs:
    """Order-independent SUM of a fractional measure, in limbs."""
    return total(exact(value))


def total(value: str | Limbs) -> Limbs:
    """SUM of limbs."""
    return Limbs(*[f"sum({x})" for x in _of(value)])


def running(value: str | Limbs, over: WindowSpec) -> Column:
    """Their running sum over a window."""
    hundredths, rest = (F.expr(x).over(over) for x in total(value))
    return F.struct(hundredths.alias("hundredths"), rest.alias("rest"))


def plus(*values: str | Limbs) -> Limbs:
    return Limbs(*[f"({' + '.join(x)})" for x in zip(*map(_of, values), strict=True)])


def minus(*values: str | Limbs) -> Limbs:
    return Limbs(*[f"({' - '.join(x)})" for x in zip(*map(_of, values), strict=True)])


def times(n: str, value: str | Limbs) -> Limbs:
    """A whole number of times."""
    return Limbs(*[f"{n} * {x}" for x in _of(value)])


def or_zero(value: str | Limbs) -> Limbs:
    return Limbs(*[f"coalesce({x}, 0L)" for x in _of(value)])


def unscale(value: str | Limbs) -> Column:
    """Limbs back to DOUBLE (correctly rounded)."""
    h, r = _of(value)
    rest = f"pmod({r}, {PER_HUNDREDTH}L)"
    whole = f"({h} + ({r} - {rest}) div {PER_HUNDREDTH}L)"
    wide = f"CAST({whole} AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) + CAST({rest} AS DECIMAL(10,0)) * CAST(0.000000001 AS DECIMAL(10,9))"
    # the double quotient of two exact integers is correctly rounded
    return F.expr(f"CASE WHEN {rest} = 0 AND abs({whole}) < {_WHOLE}L THEN CAST({whole} AS DOUBLE) / 100D ELSE CAST({wide} AS DOUBLE) END")


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(col: str | Column) -> Column:
    return _c(col).cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as DOUBLE; NULL when ``den`` is 0 or NULL."""
    return F.try_divide(as_double(num), as_double(den))


def day(col: str | Column) -> Column:
    """MySQL ``DATE(ts)``."""
    return F.to_date(_c(col))
