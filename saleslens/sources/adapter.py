"""The retail star as DataFrames, and its mapping from the TPC-H-style test tables (A-06).

``Star`` bundles the four tables every analysis plan reads. ``star_from_tpch`` derives
them lazily from ``lineitem``/``orders``/``part``/``customer``/``nation``/``region``
Parquet files: Catalyst prunes every column a plan does not read, so each query scans only
what it uses. Only the Calendar's span, two dates, is collected, when it is first used.
"""

from __future__ import annotations

import datetime as dt
import functools
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.dates import build_calendar


class Star:
    """The four tables. ``calendar`` may be a function that makes it: it is called when the
    Calendar is first used, so plans without one do not look for its span."""

    def __init__(self, sales: DataFrame, products: DataFrame, customers: DataFrame,
                 calendar: DataFrame | Callable[[], DataFrame]):
        self.sales, self.products, self.customers, self._calendar = sales, products, customers, calendar

    @functools.cached_property
    def calendar(self) -> DataFrame:
        return self._calendar() if callable(self._calendar) else self._calendar


def read_parquet_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Table scan by name (A-03): ``<base>/<name>.parquet`` or a catalog table."""
    path = os.path.join(base, f"{name}.parquet")
    return spark.read.parquet(path)


def sales_from_tpch(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Sale lines = line items joined to their order (date, customer).

    Amounts are exact decimals: gross = extended price, discount_amount = round(gross *
    discount, 2), total_amount = gross - discount_amount. ``sale_id`` is
    ``orderkey * 10 + linenumber`` (not unique in the test data; see quality checks).
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                         "l_extendedprice", "l_discount")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    discount_amount = F.round(gross * disc, 2).cast("decimal(12,2)")
    unit_price = F.round(
        (F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))).cast("decimal(38,9)"),
        2).cast("decimal(10,2)")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        unit_price.alias("unit_price"),
        (disc * 100).cast("decimal(5,2)").alias("discount_pct"),
        discount_amount.alias("discount_amount"),
        (gross - discount_amount).cast("decimal(12,2)").alias("total_amount"),
    )


def products_from_tpch(part: DataFrame) -> DataFrame:
    """Products = parts; category = part type, organic flag = size divisible by 4."""
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.lit(None).cast("decimal(8,2)").alias("calories_per_100g"),
        ((F.col("p_size") % 4) == 0).alias("is_organic"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.lit(None).cast("date").alias("launch_date"),
    )


def customers_from_tpch(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customers = customer with nation name (country) and region name (region).

    Left joins keep every customer even when its nation or region is unknown.
    """
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    return (customer
            .join(n, customer["c_nationkey"] == n["n_nationkey"], "left")
            .join(r, F.col("n_regionkey") == r["r_regionkey"], "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.col("c_mktsegment").alias("customer_type"),
                F.col("r_name").alias("region"),
                F.col("n_name").alias("country"),
                F.lit(None).cast("date").alias("registration_date"),
                (F.col("c_acctbal") > 0).alias("is_active"),
            ))


def order_years(orders: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last day of the years that the order dates span (two aggregates of one
    pruned column; today's year without orders)."""
    low, high = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    today = dt.date.today()
    return dt.date((low or today).year, 1, 1), dt.date((high or today).year, 12, 31)


def star_from_tpch(spark: SparkSession, sf_dir: str, calendar_range=None) -> Star:
    """The star over the tables of ``sf_dir``; its Calendar spans whole years of the order
    dates unless ``calendar_range`` (first, last day) is given."""

    def t(name):
        return read_parquet_table(spark, sf_dir, name)

    def calendar() -> DataFrame:
        return build_calendar(spark, *(calendar_range or order_years(t("orders"))))

    return Star(
        sales=sales_from_tpch(t("lineitem"), t("orders")),
        products=products_from_tpch(t("part")),
        customers=customers_from_tpch(t("customer"), t("nation"), t("region")),
        calendar=calendar,
    )
