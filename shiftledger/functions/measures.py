"""Exact rounding of quotients.

Averages and rates are rounded half away from zero on whole numbers, so the
second decimal never depends on floating point or on an intermediate scale.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS_PER_HOUR = 10_000


def rounded_ratio(total: Column, parts: Column, digits: int = 2) -> Column:
    """``total / parts`` for whole ``total`` and whole, non-negative ``parts``; NULL when ``parts`` is 0."""
    size = F.abs(total).cast("decimal(28,0)")
    divisor = F.nullif(parts.cast("decimal(28,0)"), F.lit(0).cast("decimal(28,0)"))
    halves = size * F.lit(2 * 10**digits) + divisor
    steps = F.call_function("div", halves, divisor * F.lit(2))
    signed = F.when(total < 0, -steps).otherwise(steps)
    return signed.cast("double") / F.lit(float(10**digits))


def percentage(part: Column, whole: Column) -> Column:
    return rounded_ratio(part * F.lit(100), whole)


def hour_units(hours: Column) -> Column:
    """Decimal hours with four digits as a whole number of ten-thousandths."""
    return (hours * F.lit(UNITS_PER_HOUR)).cast("decimal(28,0)")
