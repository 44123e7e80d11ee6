"""Product cleaning (B-01), stable id assignment (B-02), sale-line pricing (B-03)."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslens.operators.windows import global_row_number

# Shortest name and fallback brand.
MIN_NAME_LENGTH = 3
UNKNOWN_BRAND = "Unknown"


def strip_text(c: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode spaces included."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+", ""), r"(?U)\s+$", "")


def clean_products(raw: DataFrame) -> DataFrame:
    """B-01: raw product records -> (product_name, brand, calories_per_100g) + raw columns.

    Expected raw columns: ``product_name``, ``brands`` (comma separated), ``energy_kcal``
    (text or number). Name: stripped, kept when at least 3 characters. Brand: first
    comma-separated item, stripped, 'Unknown' when missing or empty. Both stay whole: text
    over a table's limit is reported by ``check_domain``, never cut, so two long names
    cannot merge. Calories: numeric, rounded to 1 decimal; 0 or missing -> NULL.
    """
    name = strip_text(F.coalesce(F.col("product_name"), F.lit("")))
    first_brand = strip_text(F.split(F.coalesce(F.col("brands"), F.lit(UNKNOWN_BRAND)), ",")
                             .getItem(0))
    brand = F.when(F.length(first_brand) > 0, first_brand).otherwise(F.lit(UNKNOWN_BRAND))
    kcal = F.col("energy_kcal").cast("string").try_cast("decimal(18,6)")
    calories = F.when(kcal != 0, F.round(kcal, 1)).cast("decimal(8,2)")
    return (raw.withColumn("_name", name)
               .where(F.length("_name") >= MIN_NAME_LENGTH)
               .withColumn("product_name", F.col("_name"))
               .withColumn("brand", brand)
               .withColumn("calories_per_100g", calories)
               .drop("_name"))


def assign_ids(df: DataFrame, order: Sequence[str], id_col: str = "product_id", start: int = 1) -> DataFrame:
    """B-02: consecutive ids ``start, start+1, ..`` in the order of the given columns (any
    orderable types; together unique), numbered by the distributed row number."""
    first, *rest = order
    out = global_row_number(df, first, True, tie_break=rest or first, name="_rn")
    return out.withColumn(id_col, F.col("_rn") + (start - 1)).drop("_rn")


def price_sales(sales: DataFrame, products: DataFrame) -> DataFrame:
    """B-03: price sale lines from the product list price.

    discount_amount = round(price * qty * pct / 100, 2), total = round(price * qty -
    discount_amount, 2), exact decimals with HALF_UP rounding. A line whose product is
    unknown stays, unpriced (NULL amounts), for the foreign-key check to report.
    """
    p = products.select("product_id", F.col("unit_price").alias("_list_price"))
    j = sales.drop("unit_price", "discount_amount", "total_amount").join(p, "product_id", "left")
    gross = F.col("_list_price") * F.col("quantity")
    pct = F.coalesce(F.col("discount_pct"), F.lit(Decimal("0.00")))
    disc = F.round(gross * pct * F.lit(Decimal("0.01")), 2)
    return (j.withColumn("discount_amount", disc.cast("decimal(12,2)"))
             .withColumn("total_amount", F.round(gross - F.col("discount_amount"), 2)
                         .cast("decimal(12,2)"))
             .withColumnRenamed("_list_price", "unit_price"))
