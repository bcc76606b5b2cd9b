"""Sums of doubles that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A value is cut into whole numbers of this many steps; the first one holds what is above.
STEP = float(1 << 32)
BELOW = 3
LARGEST = float(1 << 95)
WHOLE = "decimal(19,0)"


def limbs(value: Column) -> list[Column]:
    """Whole numbers that make up ``value`` exactly, from the multiples of 2**32 down to those of 2**-96, then what is left.

    What is left is zero for amounts of any currency: it takes numbers from 2**95 on, NaN, infinities and bits below
    2**-96, which only numbers under 2**-43 have.
    """
    inside = F.when(F.abs(value) < LARGEST, value)
    part = inside % 1.0
    whole = inside - part
    units = whole % STEP
    found = [(whole - units) / STEP, units]
    for _ in range(BELOW):
        scaled = part * STEP
        part = scaled % 1.0
        found.append(scaled - part)
    left = F.coalesce(part * STEP ** -BELOW, value)
    # By way of a long, as a decimal takes only 17 digits of a double.
    return [*(limb.cast("long").cast(WHOLE) for limb in found), left]


def limb_sums(value: Column, name: str) -> list[Column]:
    """Aggregates that ``exact_sum`` puts together; null limbs (of null values) count for nothing."""
    return [F.sum(limb).alias(f"{name}_{number}") for number, limb in enumerate(limbs(value))]


def exact_sum(name: str) -> Column:
    """The sum from its ``limb_sums``: the same to the last bit however the rows were cut, ordered and combined.

    The limbs' sums are whole numbers and so exact; only putting them together rounds, always in the
    same way. Null if there was no value.
    """
    total = F.lit(0.0)
    for number in range(BELOW + 1, 0, -1):
        total = F.coalesce(F.col(f"{name}_{number}").cast("double"), F.lit(0.0)) + total / STEP
    top = F.coalesce(F.col(f"{name}_0").cast("double"), F.lit(0.0)) * STEP
    left = F.col(f"{name}_{BELOW + 2}")
    return F.when(left.isNotNull(), top + total + left)
