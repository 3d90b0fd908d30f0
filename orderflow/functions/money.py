"""Rounding to cents, and sums that do not depend on how rows were partitioned."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_CENTS = "decimal(18,2)"
# Below this, a double equal to some whole number of cents has no other two-decimal text.
_EXACT_CENTS = 1e13


def round_half_even(amount: Column) -> Column:
    """Two decimals, ties to even on the scaled binary value (the ingest side's rule)."""
    return F.rint(amount * 100) / 100


def round_half_up(amount: Column) -> Column:
    """Two decimals, ties away from zero (the warehouse side's rule).

    ``F.round`` goes through a decimal text; amounts that are cents already skip it.
    """
    is_cents = (round_half_even(amount) == amount) & (F.abs(amount) < _EXACT_CENTS)
    return F.when(is_cents, amount).otherwise(F.round(amount, 2))


def cents_sum(amount: Column) -> Column:
    """Sum of amounts as a double; those that are whole cents add up exactly.

    Whole cents are added as decimals, so a retried task or another partitioning gives the
    same total. Other amounts (parts of a cent, NaN, infinities, huge ones) are added as
    doubles, so nothing is lost.
    """
    cents = amount.try_cast(_CENTS)
    whole = F.coalesce(cents.cast("double") == amount, F.lit(False))
    rest = F.sum(F.when(~whole, amount))
    total = F.sum(F.when(whole, cents)).cast("double")
    return F.coalesce(total + rest, total, rest)


_LIMB = 30  # bits of a part of a fraction


def exact_sum(amount: Column) -> Column:
    """Sum of amounts as a double that does not depend on the order of rows.

    Amounts below 2^31 whose last binary place is not below 2^-60 (all of 2^-8 and more) are cut
    into whole units and two parts of 30 bits, which add up exactly as integers. Others (huge and
    tiny ones, NaN, infinities) are added as doubles.
    """
    size = float(1 << _LIMB)
    whole = F.floor(amount)
    fraction = amount - whole.cast("double")
    high = F.floor(fraction * size)
    low = (fraction * size - high.cast("double")) * size
    held = (whole.cast("double") + fraction == amount) & (F.floor(low).cast("double") == low)
    fits = F.coalesce(F.when(F.abs(amount) < 2.0**31, held), F.lit(False))
    units, highs, lows = (F.sum(F.when(fits, part)) for part in (whole, high, F.floor(low)))
    highs = highs + F.shiftright(lows, _LIMB)
    units = units + F.shiftright(highs, _LIMB)
    mask = F.lit((1 << _LIMB) - 1).cast("long")
    below = highs.bitwiseAND(mask) * F.lit(1 << _LIMB).cast("long") + lows.bitwiseAND(mask)
    total = units.cast("double") + below.cast("double") / (size * size)
    rest = F.sum(F.when(~fits, amount))
    return F.coalesce(total + rest, total, rest)


def cents_avg(amount: Column) -> Column:
    """Mean of amounts, rounded to two decimals."""
    return round_half_up(cents_sum(amount) / F.nullif(F.count(amount), F.lit(0)))
