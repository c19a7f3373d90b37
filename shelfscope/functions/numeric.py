"""Order-independent arithmetic on doubles, guarded ratios and rounding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rounding = Callable[[Column], Column]


_LOW_BITS = 20


def exact_sum(value: Column) -> Column:
    """Sum of a double column that does not depend on the order of the rows.

    Adding doubles in a different order changes the last bits, so two runs over
    differently partitioned data disagree. The sum is taken on decimal values
    instead, in three parts:

    * amounts below 1e10 with at most two decimals, which is what money looks
      like, as whole cents in 64-bit integers. High and low bits are summed
      apart, so neither sum can overflow below 9e12 rows per group;
    * other finite values below 1e20, as decimals with eight places, and what they have
      beyond, up to the eighteenth place, as decimals of its own;
    * NaN, infinities and larger values, as doubles. They make the total what a
      plain sum would make it.
    """
    cents = F.rint(value * 100)
    is_money = (F.abs(value) < 1e10) & (cents / 100 == value)
    units = F.when(is_money, cents).cast("bigint")
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(19,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(19,0)")
    all_cents = high * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low
    money = (all_cents * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(28,2)")

    other = F.when(~is_money, value)
    wide = other.try_cast("decimal(38,18)")
    tail = wide % F.lit("0.00000001").cast("decimal(9,8)")
    rest = F.sum((wide - tail).cast("decimal(28,8)")).cast("decimal(36,8)")
    tails = F.sum(tail).cast("double")
    outside = F.sum(F.when(F.abs(other) >= 1e20, other))

    exact = F.coalesce(money + rest, money, rest).cast("double") + F.coalesce(tails, F.lit(0.0))
    return F.coalesce(outside + exact, outside, exact)


def exact_avg(value: Column) -> Column:
    """Average over the non-NULL values, built on :func:`exact_sum`."""
    return F.when(F.count(value) > 0, exact_sum(value) / F.count(value))


def guarded_ratio(numerator: Column, denominator: Column, otherwise: Column) -> Column:
    """``numerator / denominator`` where the denominator is positive.

    The result is always a double; ``otherwise`` covers zero, negative and NULL
    denominators.
    """
    ratio = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator > 0, ratio).otherwise(otherwise.cast("double"))


def round_half_up(value: Column) -> Column:
    """Two decimals, ties away from zero on the printed value."""
    return F.round(value, 2)


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; 0 when there is nothing to share."""
    return round_half_up(guarded_ratio(part, whole, F.lit(0.0)) * 100)
