"""Scalar and aggregate helpers shared by operators."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """Division that yields null on a zero or null divisor (H6)."""
    return F.try_divide(_col(num), _col(den))


STAT_SCALE = 12
# Values up to here are summed in decimal(38, scale), which can't overflow.
_DECIMAL_LIMIT = 1e15


def exact_sum(c, scale: int | None = 2) -> Column:
    """Sum of a column. Each value is split in its first ``scale`` decimals,
    which are summed in decimal, and what is left, which is summed as a
    double: nothing is rounded away, and a column of ``scale`` decimals has
    an exact sum that doesn't depend on row order. NaN, infinities and values
    beyond the decimal range go through the double sum, as in a plain one.
    ``scale=None`` is the plain double sum."""
    x = _col(c)
    if scale is None:
        return F.sum(x)
    part, rest = exact_parts(x, scale)
    return F.coalesce(F.sum(part).cast("double"), F.lit(0.0)) + F.sum(rest)


def exact_parts(c, scale: int = 2) -> tuple[Column, Column]:
    """The first ``scale`` decimals of a value as a decimal (null beyond the
    decimal range) and the rest as a double."""
    x = _col(c).cast("double")
    part = F.when(F.abs(x) < _DECIMAL_LIMIT, x).cast(f"decimal(38,{scale})")
    return part, x - F.coalesce(part.cast("double"), F.lit(0.0))


def exact_avg(c, scale: int | None = 2) -> Column:
    """Mean as ``exact_sum / count`` (null for an empty or all-null group)."""
    x = _col(c)
    if scale is None:
        return F.avg(x)
    return F.try_divide(exact_sum(x, scale), F.count(x).cast("double"))


def exact_moments(c, scale: int = STAT_SCALE):
    """(n, sum, sum of squares) of a double column, by ``exact_sum``."""
    x = _col(c)
    return F.count(x), exact_sum(x, scale), exact_sum(x * x, scale)


def pct_error(actual, predicted) -> Column:
    """Absolute percent error ``100*|a-p|/a`` (H9); null when ``a`` is 0."""
    a, p = _col(actual), _col(predicted)
    return F.try_divide(F.abs(a - p) * 100.0, a)


def minmax(x, lo, hi) -> Column:
    """Min-max scale; a constant column maps to 0."""
    x = _col(x)
    return F.coalesce(F.try_divide(x - _col(lo), _col(hi) - _col(lo)), x * 0.0)


def minmax_inverse(s, lo, hi) -> Column:
    """Undo ``minmax``."""
    return _col(s) * (_col(hi) - _col(lo)) + _col(lo)


def relative_upside(forecast, recent) -> Column:
    """``100*(forecast-recent)/recent``."""
    f, r = _col(forecast), _col(recent)
    return F.try_divide((f - r) * 100.0, r)


def any_null(cols) -> Column:
    """True when any listed column is null."""
    return reduce(or_, [F.col(c).isNull() for c in cols])
