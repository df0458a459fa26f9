"""Exact quotients and numeric parsing as native column expressions.

Means, shares and growth rates are rounded exactly, half away from zero, from decimal sums.
The result then depends neither on the order in which partitions were added up nor on how a
binary fraction happens to fall.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column) -> Column:
    """Text to number, NULL when it is not one. Six places keep the sign of tiny amounts."""
    return c.try_cast("decimal(30,6)")


def quotient(num: Column, den: Column, places: int) -> Column:
    """``num / den`` to ``places`` decimals; NULL when the denominator is zero or NULL.

    Both may be whole numbers or decimals of up to six places.
    """
    a, b = num.cast("decimal(38,6)"), den.cast("decimal(38,6)")
    unit = 10 ** places
    divisor = F.nullif(F.abs(b) * 2, F.lit(Decimal(0)))
    top = F.abs(a) * (2 * unit) + F.abs(b)
    whole = ((top - top % divisor) / divisor).cast("decimal(30,0)")
    scaled = (whole * F.lit(Decimal(1).scaleb(-places))).cast(f"decimal(24,{places})")
    return F.when((a < 0) != (b < 0), -scaled).otherwise(scaled)


def percent(num: Column, den: Column, places: int = 2) -> Column:
    return quotient(num.cast("decimal(36,6)") * 100, den, places)


def growth_pct(current: Column, prior: Column, places: int = 2) -> Column:
    """Change against ``prior`` in percent; NULL when there is none or it is zero."""
    return percent(current - prior, prior, places)


def mean(c: Column, places: int) -> Column:
    """Exact average of whole numbers or decimals."""
    return quotient(F.sum(c), F.count(c), places)


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(Decimal(0)))
