"""Numeric column expressions: shares, ages, bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def percent_1dp(n, total) -> Column:
    """Share in percent with one decimal, halves rounded up (Math.round rule).

    ``floor(n*1000/total + 0.5) / 10``; a zero or null total gives 0.0.
    """
    n, total = _c(n), _c(total)
    return F.when(F.coalesce(total, F.lit(0)) == 0, F.lit(0.0)).otherwise(
        F.floor(n.cast("double") * 1000.0 / total + 0.5) / 10.0)


def age_365(birthday, as_of) -> Column:
    """Whole 365-day years between ``birthday`` ('yyyy-MM-dd') and ``as_of``.

    Truncates toward zero like integer division of elapsed milliseconds.
    """
    days = F.datediff(F.to_date(_c(as_of) if not isinstance(as_of, str) else F.lit(as_of)),
                      F.to_date(_c(birthday)))
    return (days / 365).cast("int")


def band(value, width) -> Column:
    """Band index ``floor(value / width)``."""
    return F.floor(_c(value) / F.lit(width)).cast("long")
