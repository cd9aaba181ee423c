"""Guarded arithmetic. ANSI mode is on, so no division is left unguarded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE, 0 unless the denominator is positive."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def whole_average(total: Column, n: Column) -> Column:
    """Average cut to a whole number, 0 without rows."""
    return F.coalesce(
        F.try_divide(total.cast("double"), n.cast("double")), F.lit(0.0)
    ).cast("bigint")


def round_half_even(x: Column, noise_digits: int = 9) -> Column:
    """Nearest whole number, halves to the even one.

    The inner rounding removes summation noise, which would otherwise let the order in which
    a distributed sum was taken decide on which side of a half a value falls.
    """
    return F.bround(F.round(x.cast("double"), noise_digits), 0).cast("bigint")


def at_least_zero(x: Column) -> Column:
    """Negative values become 0 and null stays null (``greatest`` would turn null into 0)."""
    return F.when(x < 0, F.lit(0).cast("bigint")).otherwise(x)


def band(volume: Column) -> tuple[Column, Column]:
    """Lower and upper forecast bound: 80 % and 120 % of the volume, cut to whole numbers."""
    as_double = volume.cast("double")
    return (as_double * 0.8).cast("bigint"), (as_double * 1.2).cast("bigint")
