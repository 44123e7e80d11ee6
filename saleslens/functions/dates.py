"""Date dimension (B-05) and safe date parsing (B-04)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.expr import col_


def add_calendar_columns(df: DataFrame, date_col: str = "full_date") -> DataFrame:
    """Add the Calendar attributes of ``date_col``.

    year is the calendar year, week the ISO-8601 week (so 2024-12-30 is week 1 of
    calendar year 2024), day_of_week is ISO (1 = Monday .. 7 = Sunday), month_name the
    English month name, date_key the yyyymmdd integer.
    """
    d = F.col(date_col)
    return df.select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("int").alias("year"),
        F.quarter(d).cast("int").alias("quarter"),
        F.month(d).cast("int").alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).cast("int").alias("week"),
        (F.weekday(d) + 1).cast("int").alias("day_of_week"),
    )


def _to_date(d) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d))


def build_calendar(spark: SparkSession, start, end) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive.

    The day count is known on the driver from the two bounds, so the rows come from a
    distributed ``range`` rather than from a single exploded array.
    """
    s, e = _to_date(start), _to_date(end)
    n_days = (e - s).days + 1
    if n_days <= 0:
        raise ValueError(f"empty calendar range {s}..{e}")
    days = spark.range(0, n_days).select(
        F.date_add(F.lit(s), F.col("id").cast("int")).alias("full_date"))
    return add_calendar_columns(days)


def calendar_covering(facts: DataFrame, date_col: str = "sale_date") -> DataFrame:
    """Calendar spanning whole years from the first to the last date in ``facts``.

    Lazy: the bounds are one global min/max aggregate (partial per task), the day list
    is bounded by the date span, never by the number of fact rows.
    """
    bounds = facts.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = bounds.where(F.col("lo").isNotNull()).select(F.explode(F.sequence(
        F.trunc("lo", "year"),
        F.date_sub(F.add_months(F.trunc("hi", "year"), 12), 1))).alias("full_date"))
    return add_calendar_columns(days)


def coerce_dates(df: DataFrame, cols: Iterable[str], fmt: str | None = None) -> DataFrame:
    """Parse text columns to DATE; unparseable text becomes NULL instead of an error."""
    out = df
    for c in cols:
        parsed = F.try_to_date(col_(c), fmt) if fmt else F.try_to_date(col_(c))
        out = out.withColumn(c, parsed)
    return out

