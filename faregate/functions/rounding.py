"""Half-to-even rounding on the binary product, and guarded ratios.

Spark's ``round`` and ``bround`` work on the decimal form of a double. The
reference results come from arithmetic on the double itself, so every rounded
column uses ``rint(x * 10^d) / 10^d``. Adding zero turns ``-0.0`` into ``0.0``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column, digits: int = 2) -> Column:
    factor = F.lit(float(10**digits))
    return F.rint(value * factor) / factor + F.lit(0.0)


def guarded_ratio(
    numerator: Column, divisor: Column, factor: float | None = None, digits: int = 2
) -> Column:
    """``numerator / divisor`` rounded, null unless the divisor is positive."""
    ratio = numerator / divisor
    if factor is not None:
        ratio = ratio * F.lit(factor)
    return F.when(divisor > 0, half_even(ratio, digits))


def row_total(columns: tuple[str, ...] | list[str], digits: int = 2) -> Column:
    """Sum of several columns of one row, left to right, rounded."""
    total = F.col(columns[0])
    for name in columns[1:]:
        total = total + F.col(name)
    return half_even(total, digits)


def clamp_at_zero(value: Column) -> Column:
    return F.greatest(F.lit(0.0), value)


def cents(value: Column) -> Column:
    """Money as a whole number of cents, so that sums do not depend on row order."""
    return F.rint(value * F.lit(100.0)).cast("bigint")
