"""Rounding, exact sums of amounts, and ratios that survive a zero.

Amounts are doubles.  Adding doubles gives a result that depends on the order
of the rows, and so on partitioning and task retries, and a mean on a half
cent then flips between runs.  Sums are therefore taken over decimals with ten
places.  An amount or a total that does not fit fails the query; it is never
left out, cut or wrapped.  Infinite amounts and those that are no number make
the result so, as they do in a plain sum.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INFINITE = float("inf")
_WHOLE = 2.0**52  # doubles of this size have no decimals


def _sums(amount: Column) -> Column:
    amount = amount.cast("double")
    odd = F.abs(amount) >= _INFINITE  # Spark sorts NaN above infinity
    exact = F.sum(F.when(~odd, amount.cast("decimal(28,10)")))
    return F.coalesce(F.sum(F.when(odd, amount)), exact.cast("double"))


def units(amount: Column) -> Column:
    """The finite part of an amount that is added up in steps, exact; see `not_finite`."""
    amount = amount.cast("double")
    return F.when(F.abs(amount) < _INFINITE, amount.cast("decimal(28,10)"))


def not_finite(amount: Column) -> Column:
    """The other part: an infinity or NaN, added up beside the units."""
    amount = amount.cast("double")
    return F.when(F.abs(amount) >= _INFINITE, amount)


def from_units(total: Column, odd: Column | None = None) -> Column:
    """The sum of both parts; any infinity or NaN among the amounts decides it."""
    exact = total.cast("double")
    return exact if odd is None else F.coalesce(odd, exact)


def round_cells(x: Column) -> Column:
    """Two decimals of a cell as it is written: 1.005 becomes 1.01.

    Works on the shortest decimal form of the double, unlike `round2`.
    """
    return F.round(x, 2) + 0.0


def round2(x: Column) -> Column:
    """Two decimals, halves away from zero; same formula on any engine.

    The last term turns a negative zero into a plain one.
    """
    near = F.signum(x) * F.floor(F.abs(x) * 100.0 + 0.5) / 100.0 + 0.0
    return F.when(F.abs(x) < _WHOLE, near).otherwise(x)


def amount_sum(amount: Column) -> Column:
    return _sums(amount)


def amount_avg(amount: Column) -> Column:
    return _sums(amount) / F.count(amount)


def coordinate_avg(degrees: Column) -> Column:
    """Unrounded mean of coordinates, independent of row order.

    The mean is used as a grouping key, so two attempts of one task must agree
    to the last bit; 18 decimals hold any double of this size without loss.
    """
    exact = degrees.try_cast("decimal(38,18)")
    return F.sum(exact).cast("double") / F.count(exact)


def percent(part: Column, whole: Column) -> Column:
    """`part / whole` in percent with two decimals; NULL for a zero whole."""
    return round2(F.try_divide(part, whole) * 100.0)


def or_zero(c: Column, dtype: str = "long") -> Column:
    return F.coalesce(c, F.lit(0).cast(dtype))
