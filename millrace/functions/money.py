"""Loyalty points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: share of an amount that is paid back in points.
POINT_RATE = 0.2

LEAST_INT, MOST_INT = -(1 << 31), (1 << 31) - 1


def loyalty_points(amount: Column | str) -> Column:
    """Whole points for an amount, cut toward zero; beyond an int its nearest end, zero for no number."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    points = amount * POINT_RATE
    whole = F.least(F.greatest(points, F.lit(float(LEAST_INT))), F.lit(float(MOST_INT)))
    return F.when(F.isnan(points), 0).when(points.isNotNull(), whole.cast("int"))
