"""Doubles as integers of the same order, and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fraction bits, least normal exponent, biased exponent of infinity.
FRACTION_BITS = 52
LEAST_EXPONENT = -1022
INFINITE = 2047


def power_of_two(exponent: Column) -> Column:
    return F.pow(F.lit(2.0), exponent.cast("double"))


def ordinal(value: Column) -> Column:
    """The 64-bit image of a double, sign and magnitude: a < b exactly if its image is less.

    Equal doubles (0.0 and -0.0) have one image; NULL and NaN have none.
    """
    x = F.nullif(value.cast("double"), F.lit(float("nan")))
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.abs(F.coalesce(x, F.lit(0.0)))).cast("long")
    return F.when(x.isNotNull(), F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)) * bits)


def from_ordinal(image: Column) -> Column:
    """The double of an image."""
    size = F.abs(image)
    biased = F.shiftright(size, FRACTION_BITS)
    fraction = size.bitwiseAND((1 << FRACTION_BITS) - 1)
    whole = F.when(biased == 0, fraction).otherwise(fraction + F.lit(1 << FRACTION_BITS))
    least = LEAST_EXPONENT - FRACTION_BITS
    value = whole.cast("double") * power_of_two(F.greatest(biased, F.lit(1)) - 1 + least)
    value = F.when(biased == INFINITE, F.lit(float("inf"))).otherwise(value)
    return F.when(image < 0, -value).otherwise(value)
