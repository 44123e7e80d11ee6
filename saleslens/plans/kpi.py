"""KPI tables: the five-row KPI card table of a year (G-15) and the wide KPI row (M-01).

All KPIs come from ONE aggregate over one scan of Sales; the rows are then produced
by ``inline`` of five structs, instead of five scans glued by UNION ALL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.functions.expr import as_double, as_long, round_half_up, safe_ratio
from saleslens.operators.periods import where_year

# KPI labels (suffixed with the year) and units, in output order.
KPI_ROWS = (
    ("Fatturato Totale", "€"),
    ("Ordini Totali", "n."),
    ("Clienti Attivi", "n."),
    ("Sconto Medio", "%"),
    ("Prodotti Venduti", "n."),
)


def filter_year(df: DataFrame, year: int, date_col: str = "sale_date") -> DataFrame:
    """M-08: rows of one calendar year, as a date range the scan can push down."""
    return where_year(df, year, date_col)


def _year_aggregate(sales: DataFrame, year: int | None) -> DataFrame:
    s = filter_year(sales, year) if year is not None else sales
    return s.agg(
        F.sum("total_amount").alias("revenue"), F.count("total_amount").alias("n_total"),
        F.count("sale_id").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        F.sum("discount_pct").alias("disc_sum"), F.count("discount_pct").alias("disc_n"),
        F.countDistinct("product_id").alias("products"))


def kpi_summary(sales: DataFrame, year: int) -> DataFrame:
    """G-15: (kpi, value, unit) rows for ``year``: revenue, sale lines, distinct buying
    customers, mean discount %, distinct products sold."""
    a = _year_aggregate(sales, year)
    values = [
        as_double(F.round("revenue", 2)),
        as_double("orders"),
        as_double("customers"),
        round_half_up(safe_ratio(as_double("disc_sum"), "disc_n"), 2),
        as_double("products"),
    ]
    rows = [F.struct(F.lit(f"{label} {year}").alias("kpi"), v.alias("value"), F.lit(unit).alias("unit"))
            for (label, unit), v in zip(KPI_ROWS, values)]
    return a.select(F.inline(F.array(*rows)))


def kpi_cards(sales: DataFrame, year: int | None = None) -> DataFrame:
    """M-01: one row: revenue, sale lines, active (buying) customers, mean line value,
    mean discount %; all sales or one year."""
    a = _year_aggregate(sales, year)
    return a.select(as_double("revenue").alias("revenue"), as_long("orders").alias("orders"),
                    as_long("customers").alias("active_customers"),
                    safe_ratio(as_double("revenue"), "n_total").alias("avg_order_value"),
                    safe_ratio(as_double("disc_sum"), "disc_n").alias("avg_discount_pct"))
