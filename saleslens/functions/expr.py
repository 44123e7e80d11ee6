"""Scalar expressions shared by the analysis plans.

Money stays DECIMAL inside every plan (exact, order independent sums) and becomes
DOUBLE only at the output. Ratios are computed in DOUBLE and rounded HALF_UP through a
DECIMAL cast, so the rounding acts on the decimal value, as a DECIMAL engine would.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(c) -> Column:
    return col_(c).cast("double")


def as_long(c) -> Column:
    return col_(c).cast("bigint")


def safe_ratio(num, den) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of a division-by-zero error."""
    den = col_(den)
    return col_(num) / F.nullif(den, F.lit(0))


def mean(c) -> Column:
    """AVG as DOUBLE: ``sum / count`` over non-null values (NULL for no values)."""
    return safe_ratio(F.sum(c).cast("double"), F.count(c))


def round_half_up(c, scale: int) -> Column:
    """Round a DOUBLE to ``scale`` decimals, ties away from zero, returning DOUBLE.

    The value is first fixed to 9 decimals, then rounded as a decimal; this avoids the
    binary-representation drift of rounding doubles directly (1.005 -> 1.01).
    """
    return F.round(col_(c).cast("decimal(38,9)"), scale).cast("double")


def days_between(start, end) -> Column:
    """T-SQL ``DATEDIFF(day, start, end)``: whole days from start to end."""
    return F.datediff(col_(end), col_(start))


def _as_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def in_period(c, start=None, end=None) -> Column:
    """``start <= c < end`` as a range predicate that reaches the Parquet scan."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (col_(c) >= F.lit(_as_date(start)))
    if end is not None:
        cond = cond & (col_(c) < F.lit(_as_date(end)))
    return cond


def in_year(c, year: int) -> Column:
    """``year(c) = year`` written as a date range so both bounds push down."""
    return in_period(c, _dt.date(year, 1, 1), _dt.date(year + 1, 1, 1))
