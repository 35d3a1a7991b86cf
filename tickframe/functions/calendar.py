"""Quarter rules (H4, H5) as native expressions (the reference used Python
row UDFs, which leave whole-stage codegen and fail on null dates)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_quarter(date, calendar: bool = False) -> Column:
    """Quarter of a daily price. Reference rule: February-March -> 1,
    April-June -> 2, July-September -> 3, and October-December *and January*
    -> 4 of the same year. ``calendar=True`` gives the calendar quarter."""
    d = _col(date)
    if calendar:
        return F.quarter(d)
    return F.when(F.month(d) == 1, F.lit(4)).otherwise(F.quarter(d))


def statement_quarter(date) -> Column:
    """Quarter a statement reports on: March-May -> 2, June-August -> 3,
    September-November -> 4, December-February -> 1."""
    m = F.month(_col(date))
    return (F.when((m >= 3) & (m <= 5), F.lit(2))
            .when((m >= 6) & (m <= 8), F.lit(3))
            .when((m >= 9) & (m <= 11), F.lit(4))
            .when(m.isNotNull(), F.lit(1)))


def statement_year(date) -> Column:
    """Year a statement reports on: December rolls into the next year."""
    d = _col(date)
    return F.when(F.month(d) == 12, F.year(d) + 1).otherwise(F.year(d))
