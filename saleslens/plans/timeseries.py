"""Time intelligence over the Calendar dimension: month over month (G-04), year to date
(G-05), quarter year over year (G-06), moving average (G-14), monthly trend of two years
(M-02), purchase trend (M-10), new customers (M-11), category x year matrix (M-07).

Sales join the broadcast Calendar and aggregate to one row per month (or quarter) with a
partial aggregate per task, so only a few rows per task are shuffled. Month-level
windows (lag, running sum, moving average) then run over at most one row per calendar
month: their single partition is bounded by the calendar span, not by the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslens.functions.expr import as_double, as_long, round_half_up, safe_ratio
from saleslens.operators.joins import by_calendar
from saleslens.operators.periods import where_period


def monthly_revenue(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """(year, month, month_name, revenue DECIMAL) for every month with sales."""
    return (by_calendar(sales, calendar, ["year", "month", "month_name"])
            .groupBy("year", "month", "month_name")
            .agg(F.sum("total_amount").alias("revenue")))


def revenue_mom(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """G-04: monthly revenue, previous month present, % change (NULL for the first month
    or a zero previous month). Months without sales are skipped, not zero-filled."""
    m = monthly_revenue(sales, calendar)
    w = Window.orderBy("year", "month")
    prev = F.lag("revenue", 1).over(w)
    pct = round_half_up(safe_ratio(as_double(F.col("revenue") - prev), as_double(prev)) * 100, 2)
    return (m.select(as_long("year").alias("year"), as_long("month").alias("month"), "month_name",
                     as_double("revenue").alias("revenue"), as_double(prev).alias("prev_revenue"),
                     pct.alias("mom_pct"))
            .orderBy("year", "month"))


def revenue_ytd(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """G-05: monthly revenue and its running total, restarting each year."""
    m = monthly_revenue(sales, calendar)
    w = (Window.partitionBy("year").orderBy("month")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (m.select(as_long("year").alias("year"), as_long("month").alias("month"), "month_name",
                     as_double("revenue").alias("revenue"),
                     as_double(F.sum("revenue").over(w)).alias("revenue_ytd"))
            .orderBy("year", "month"))


def _two_year_pivot(periods: DataFrame, key: list[str], base: int, current: int) -> DataFrame:
    """Manual pivot: per ``key``, revenue of ``base`` and ``current`` year (0 when absent)."""
    zero = F.lit(0).cast("decimal(38,2)")
    rb = F.sum(F.when(F.col("year") == base, F.col("revenue")).otherwise(zero))
    rc = F.sum(F.when(F.col("year") == current, F.col("revenue")).otherwise(zero))
    g = periods.groupBy(*key).agg(rb.alias("rb"), rc.alias("rc"))
    change = F.col("rc") - F.col("rb")
    return g.select(*key, as_double("rb").alias("revenue_base"),
                    as_double("rc").alias("revenue_current"),
                    as_double(change).alias("change_abs"),
                    round_half_up(safe_ratio(as_double(change) * 100.0, as_double("rb")), 2)
                    .alias("change_pct"))


def _between_years(sales: DataFrame, base: int, current: int) -> DataFrame:
    """Sales from the earlier to the later year: the bounds reach the scan of the facts."""
    low, high = sorted((base, current))
    return where_period(sales, dt.date(low, 1, 1), dt.date(high + 1, 1, 1))


def revenue_yoy_quarter(sales: DataFrame, calendar: DataFrame, base: int, current: int,
                        months: DataFrame | None = None) -> DataFrame:
    """G-06: per quarter, revenue of two years, absolute and % change (NULL when the base
    year has no revenue in that quarter). Every quarter with sales in any year appears.

    ``months``, the (year, month) known to hold sales, tells the quarters without reading
    them (``layout.months_present``): then only the two years' sales are read.
    """
    if months is None:
        dated = by_calendar(sales, calendar, ["year", "quarter"])
    else:
        dated = by_calendar(_between_years(sales, base, current), calendar.where(F.col("year").isin(base, current)),
                            ["year", "quarter"])
    q = dated.groupBy("year", "quarter").agg(F.sum("total_amount").alias("revenue"))
    if months is not None:
        known = calendar.join(months, ["year", "month"]).select("quarter").distinct()
        q = q.unionByName(known.select(F.lit(base).alias("year"), "quarter", F.lit(0).cast("decimal(38,2)").alias("revenue")))
    return (_two_year_pivot(q, ["quarter"], base, current)
            .withColumn("quarter", as_long("quarter"))
            .orderBy("quarter"))


def revenue_moving_avg(sales: DataFrame, calendar: DataFrame, months: int = 3) -> DataFrame:
    """G-14: monthly revenue and the mean of the current and ``months - 1`` preceding
    months present (ROWS frame; crosses years; the first rows average fewer months)."""
    m = monthly_revenue(sales, calendar)
    w = Window.orderBy("year", "month").rowsBetween(-(months - 1), Window.currentRow)
    avg = safe_ratio(as_double(F.sum("revenue").over(w)), F.count("revenue").over(w))
    return (m.select(as_long("year").alias("year"), as_long("month").alias("month"), "month_name",
                     as_double(F.round("revenue", 2)).alias("revenue"),
                     round_half_up(avg, 2).alias(f"moving_avg_{months}m"))
            .orderBy("year", "month"))


def monthly_trend(sales: DataFrame, calendar: DataFrame, base: int, current: int) -> DataFrame:
    """M-02: per month of the year, revenue of ``base`` vs ``current`` year."""
    years = calendar.where(F.col("year").isin(base, current))
    m = (by_calendar(_between_years(sales, base, current), years, ["year", "month", "month_name"])
         .groupBy("year", "month", "month_name").agg(F.sum("total_amount").alias("revenue")))
    return (_two_year_pivot(m, ["month", "month_name"], base, current)
            .withColumn("month", as_long("month"))
            .orderBy("month"))


def purchase_trend(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """M-10: per month: sale lines, revenue, distinct buying customers."""
    return (by_calendar(sales, calendar, ["year", "month", "month_name"])
            .groupBy("year", "month", "month_name")
            .agg(F.count("sale_id").alias("orders"), F.sum("total_amount").alias("revenue"),
                 F.countDistinct("customer_id").alias("buyers"))
            .select(as_long("year").alias("year"), as_long("month").alias("month"), "month_name",
                    as_long("orders").alias("orders"), as_double("revenue").alias("revenue"),
                    as_long("buyers").alias("buyers"))
            .orderBy("year", "month"))


def new_customers(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """M-11: customers counted in the month of their first purchase."""
    first = sales.groupBy("customer_id").agg(F.min("sale_date").alias("first_date"))
    return (by_calendar(first, calendar, ["year", "month", "month_name"], date_col="first_date")
            .groupBy("year", "month", "month_name")
            .agg(F.count("customer_id").alias("new_customers"))
            .select(as_long("year").alias("year"), as_long("month").alias("month"), "month_name",
                    as_long("new_customers").alias("new_customers"))
            .orderBy("year", "month"))


def category_year_matrix(sales: DataFrame, products: DataFrame, calendar: DataFrame) -> DataFrame:
    """M-07: revenue per (category, year) and its % of the year's revenue."""
    per = (by_calendar(sales, calendar, ["year"])
           .groupBy("product_id", "year").agg(F.sum("total_amount").alias("revenue")))
    cells = (per.join(products.select("product_id", "category"), "product_id")
             .groupBy("category", "year").agg(F.sum("revenue").alias("revenue")))
    # One row per calendar year: bounded by the calendar span.
    years = cells.groupBy("year").agg(F.sum("revenue").alias("year_revenue"))
    out = cells.join(years, "year")
    pct = round_half_up(safe_ratio(as_double("revenue") * 100.0, as_double("year_revenue")), 2)
    return (out.select("category", as_long("year").alias("year"),
                       as_double("revenue").alias("revenue"), pct.alias("pct_of_year"))
            .orderBy("category", "year"))
