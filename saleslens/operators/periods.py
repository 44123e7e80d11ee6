"""Periods over facts that may be partitioned by year and month (C-04)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.functions.expr import in_period

YEAR_COLUMN, MONTH_COLUMN = "sale_year", "sale_month"


def by_month(df: DataFrame) -> bool:
    """Whether ``df`` carries the partition columns of the monthly layout."""
    return {YEAR_COLUMN, MONTH_COLUMN} <= set(df.columns)


def _month_number(day: dt.date) -> int:
    return day.year * 12 + day.month


def where_period(df: DataFrame, start=None, end=None, date_col: str = "sale_date") -> DataFrame:
    """Rows with ``start <= date_col < end``; both bounds reach the scan.

    On the monthly layout of ``date_col`` the months outside are pruned as well, so their
    files are never opened.
    """
    out = df.where(in_period(date_col, start, end))
    if by_month(df):
        month = F.col(YEAR_COLUMN) * 12 + F.col(MONTH_COLUMN)
        if start is not None:
            out = out.where(month >= _month_number(_day(start)))
        if end is not None:
            out = out.where(month <= _month_number(_day(end) - dt.timedelta(days=1)))
    return out


def _day(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def where_year(df: DataFrame, year: int, date_col: str = "sale_date") -> DataFrame:
    """Rows of one calendar year."""
    return where_period(df, dt.date(year, 1, 1), dt.date(year + 1, 1, 1), date_col)
