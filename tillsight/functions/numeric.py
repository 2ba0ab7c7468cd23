"""Money and rounding rules shared by every mart.

Money is kept as ``decimal(12,2)`` per line and summed as a decimal (exact and
order-independent across partitions); it becomes ``double`` only at the output
edge.  Ratios are computed as doubles and rounded with :func:`dround`: the
double is first fixed to 9 decimals and then rounded half-up as a decimal, which
reproduces NUMERIC ``ROUND`` on values such as 225.455 that a binary double
cannot hold exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"
PRICE = "decimal(10,2)"


def dround(col: Column | str, digits: int) -> Column:
    """Half-up rounding of a double through its decimal form, returned as double."""
    return F.round(_c(col).cast("decimal(38,9)"), digits).cast("double")


def ddiv(num: Column | str, den: Column | str) -> Column:
    """Double division with NULL for a zero denominator (``x / NULLIF(d, 0)``)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def pct(num: Column | str, den: Column | str, digits: int) -> Column:
    """``ROUND(100.0 * num / NULLIF(den, 0), digits)`` on doubles."""
    return dround(F.lit(100.0) * _c(num).cast("double") / F.nullif(_c(den).cast("double"),
                                                                     F.lit(0.0)), digits)


def as_double(col: Column | str) -> Column:
    return _c(col).cast("double")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
