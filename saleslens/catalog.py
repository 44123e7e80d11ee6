"""Registered queries over the test tables and their SQL twins.

``QUERIES[name](spark, sf_dir)`` returns a Spark DataFrame built from the Parquet test
tables through ``star_from_tpch``; ``ORACLE_SQL[name]`` is the same question written as
plain SQL over the raw tables (run by an independent engine). Column names and output
types agree: money and ratios are DOUBLE, counts, ranks, tiles and date parts BIGINT.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.dates import calendar_covering, coerce_dates
from saleslens.functions.expr import as_double, as_long
from saleslens.operators.cleaning import assign_ids, clean_products, price_sales
from saleslens.operators.quality import (
    check_domain, check_foreign_key, check_not_null, check_primary_key, fill_defaults, row_counts,
)
from saleslens.operators.windows import global_ntile, global_rank
from saleslens.plans import customers as C
from saleslens.plans import kpi as K
from saleslens.plans import products as P
from saleslens.plans import revenue as R
from saleslens.plans import timeseries as T
from saleslens.sources.adapter import read_parquet_table, star_from_tpch

# Parameters of the registered queries on the test tables (order dates 1995-01..2001-08).
YOY_BASE, YOY_CURRENT = 1999, 2000
KPI_YEAR = 2000
RFM_AS_OF = dt.date(2001, 12, 31)
UNSOLD_PERIOD = (dt.date(1997, 12, 1), dt.date(1998, 1, 1))
DRILL_PRODUCT = 42

Query = Callable[[SparkSession, str], DataFrame]


_STARS: dict = {}


def _star(spark: SparkSession, sf_dir: str):
    """The lazily derived star for ``sf_dir`` (plans only; nothing is cached in memory)."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _STARS:
        _STARS[key] = star_from_tpch(spark, sf_dir)
    return _STARS[key]


def _longs(df: DataFrame, cols) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, as_long(c))
    return df


def _calendar(spark, d):
    cal = calendar_covering(_star(spark, d).sales)
    return _longs(cal, ["date_key", "year", "quarter", "month", "week", "day_of_week"])


def _row_counts(spark, d):
    s = _star(spark, d)
    return row_counts({"products": s.products, "customers": s.customers, "sales": s.sales,
                       "calendar": s.calendar})


def _check_pk(spark, d):
    return _longs(check_primary_key(_star(spark, d).sales, ["sale_id"]), ["sale_id"])


def _check_fk(spark, d):
    """Documents without a label: the tables' natural orphans."""
    docs, labels = (read_parquet_table(spark, d, t).select("doc_id") for t in ("documents", "labels"))
    return check_foreign_key(docs, labels, ["doc_id"])


def _labelled(spark, d):
    """Documents with their labels, where they have any."""
    docs, labels = (read_parquet_table(spark, d, t) for t in ("documents", "labels"))
    return docs.select("doc_id", "lang", "source").join(labels, "doc_id", "left")


def _check_not_null(spark, d):
    return check_not_null(_labelled(spark, d), ["doc_id", "lang", "source", "quality", "toxic"])


def _check_domain(spark, d):
    """Raw columns against narrower limits than they keep."""
    texts = check_domain(read_parquet_table(spark, d, "documents"), {"text": 2000, "source": 150})
    prices = check_domain(read_parquet_table(spark, d, "part"), {"p_name": 300}, {"p_retailprice": (5, 2)})
    return texts.unionByName(prices)


def _fill_defaults(spark, d):
    return fill_defaults(_labelled(spark, d).select("doc_id", "quality", "toxic"), {"quality": -1, "toxic": 0}).select(
        "doc_id", as_long("quality").alias("quality"), as_long("toxic").alias("toxic"))


def _clean_products(spark, d):
    """Product records made of parts: padded names, several brands, energy as text."""
    part = read_parquet_table(spark, d, "part")
    raw = part.select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("product_name"),
        F.when(F.col("p_size") % 5 == 0, None).when(F.col("p_size") % 5 == 1, F.lit(" "))
        .otherwise(F.concat("p_brand", F.lit(" , "), "p_type")).alias("brands"),
        F.when(F.col("p_size") % 3 == 0, F.lit("n/a")).otherwise((F.col("p_size") % 7).cast("string")).alias("energy_kcal"))
    return clean_products(raw).select("p_partkey", "product_name", "brand",
                                      as_double("calories_per_100g").alias("calories_per_100g"))


def _coerce_dates(spark, d):
    """Order dates as text, and other text that is no date."""
    orders = read_parquet_table(spark, d, "orders")
    text = orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
                         F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
                         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("mixed"))
    return coerce_dates(text, ["order_date", "mixed"])


def _priced(spark, d, products):
    out = price_sales(_star(spark, d).sales, products)
    return out.select(as_long("sale_id").alias("sale_id"), as_long("product_id").alias("product_id"),
                      as_long("quantity").alias("quantity"), as_double("unit_price").alias("unit_price"),
                      as_double("discount_pct").alias("discount_pct"),
                      as_double("discount_amount").alias("discount_amount"),
                      as_double("total_amount").alias("total_amount"))


def _price_sales(spark, d):
    return _priced(spark, d, _star(spark, d).products)


def _price_sales_unknown(spark, d):
    """Lines whose product is not organic find no price and stay, unpriced."""
    return _priced(spark, d, _star(spark, d).products.where("is_organic"))


def _global_ntile(spark, d):
    o = read_parquet_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return global_ntile(o, 100, "o_totalprice", ascending=False, tie_break="o_orderkey",
                        name="tile").select("o_orderkey", "tile")


def _global_rank(spark, d):
    li = read_parquet_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return (global_rank(li, "l_quantity", ascending=False, name="rank")
            .select("l_orderkey", as_long("l_linenumber").alias("l_linenumber"), "rank"))


def _assign_ids(spark, d):
    c = read_parquet_table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return assign_ids(c, ["c_acctbal", "c_custkey"], id_col="new_id").select("c_custkey", "new_id")


def _assign_ids_by_text(spark, d):
    p = read_parquet_table(spark, d, "part").select("p_partkey", "p_brand", "p_name")
    return assign_ids(p, ["p_brand", "p_name", "p_partkey"], id_col="new_id").select("p_partkey", "new_id")


def _mixed_case(products: DataFrame) -> DataFrame:
    """Products whose names are spelled in capitals at every other id."""
    odd = F.col("product_id") % 2 == 1
    return products.withColumn("product_name", F.when(odd, F.upper("product_name")).otherwise(F.col("product_name")))


def _sales_in_year(spark, d):
    s = K.filter_year(_star(spark, d).sales, KPI_YEAR)
    return s.select(as_long("sale_id").alias("sale_id"), "sale_date",
                    as_long("product_id").alias("product_id"),
                    as_long("customer_id").alias("customer_id"),
                    as_double("total_amount").alias("total_amount"))


QUERIES: dict[str, Query] = {
    # Reference queries (G-01 .. G-15)
    "revenue_by_year": lambda sp, d: R.revenue_by_year(_star(sp, d).sales),
    "rank_products": lambda sp, d: R.rank_products(_star(sp, d).sales, _star(sp, d).products),
    "rank_products_top10": lambda sp, d: R.rank_products(_star(sp, d).sales, _star(sp, d).products,
                                                         top_n=10),
    "rank_products_ignore_case": lambda sp, d: R.rank_products(
        _star(sp, d).sales, _mixed_case(_star(sp, d).products), ignore_case=True),
    "top_products_share": lambda sp, d: R.top_products_share(_star(sp, d).sales,
                                                             _star(sp, d).products),
    "revenue_mom": lambda sp, d: T.revenue_mom(_star(sp, d).sales, _star(sp, d).calendar),
    "revenue_ytd": lambda sp, d: T.revenue_ytd(_star(sp, d).sales, _star(sp, d).calendar),
    "revenue_yoy_quarter": lambda sp, d: T.revenue_yoy_quarter(
        _star(sp, d).sales, _star(sp, d).calendar, YOY_BASE, YOY_CURRENT),
    "rank_in_category": lambda sp, d: P.rank_in_category(_star(sp, d).sales, _star(sp, d).products),
    "organic_split": lambda sp, d: P.organic_split(_star(sp, d).products, _star(sp, d).sales),
    "unsold_products": lambda sp, d: P.unsold_products(_star(sp, d).products, _star(sp, d).sales),
    "unsold_products_in_period": lambda sp, d: P.unsold_products(
        _star(sp, d).products, _star(sp, d).sales, *UNSOLD_PERIOD),
    "rfm_scores": lambda sp, d: C.rfm_scores(_star(sp, d).sales, _star(sp, d).customers, RFM_AS_OF),
    "rfm_scores_best_high": lambda sp, d: C.rfm_scores(_star(sp, d).sales, _star(sp, d).customers,
                                                       RFM_AS_OF, orientation="best_high"),
    "segment_distribution": lambda sp, d: C.segment_distribution(
        _star(sp, d).sales, _star(sp, d).customers, RFM_AS_OF),
    "top3_per_category": lambda sp, d: P.top_products_per_category(
        _star(sp, d).sales, _star(sp, d).products, 3),
    "discount_impact": lambda sp, d: C.discount_impact(_star(sp, d).sales, _star(sp, d).customers),
    "revenue_moving_avg": lambda sp, d: T.revenue_moving_avg(_star(sp, d).sales,
                                                             _star(sp, d).calendar, 3),
    "kpi_summary": lambda sp, d: K.kpi_summary(_star(sp, d).sales, KPI_YEAR),
    # Loading, calendar and quality (B-xx)
    "build_calendar": _calendar,
    "row_counts": _row_counts,
    "check_pk": _check_pk,
    "check_fk": _check_fk,
    "check_not_null": _check_not_null,
    "check_domain": _check_domain,
    "price_sales": _price_sales,
    "price_sales_unknown_product": _price_sales_unknown,
    "assign_ids": _assign_ids,
    "assign_ids_by_text": _assign_ids_by_text,
    "clean_products": _clean_products,
    "coerce_dates": _coerce_dates,
    "fill_defaults": _fill_defaults,
    # Distributed windows (F-10, F-11)
    "global_ntile": _global_ntile,
    "global_rank": _global_rank,
    # Dashboard measures (M-xx)
    "kpi_cards": lambda sp, d: K.kpi_cards(_star(sp, d).sales, KPI_YEAR),
    "monthly_trend": lambda sp, d: T.monthly_trend(_star(sp, d).sales, _star(sp, d).calendar,
                                                   YOY_BASE, YOY_CURRENT),
    "revenue_by_region": lambda sp, d: R.revenue_by(_star(sp, d).sales, _star(sp, d).customers,
                                                    "customer_id", "region"),
    "revenue_by_category": lambda sp, d: R.revenue_by(_star(sp, d).sales, _star(sp, d).products,
                                                      "product_id", "category"),
    "category_year_matrix": lambda sp, d: T.category_year_matrix(
        _star(sp, d).sales, _star(sp, d).products, _star(sp, d).calendar),
    "sales_in_year": _sales_in_year,
    "top_customers": lambda sp, d: C.top_customers(_star(sp, d).sales, _star(sp, d).customers, 10),
    "purchase_trend": lambda sp, d: T.purchase_trend(_star(sp, d).sales, _star(sp, d).calendar),
    "new_customers": lambda sp, d: T.new_customers(_star(sp, d).sales, _star(sp, d).calendar),
    "product_kpis": lambda sp, d: P.product_kpis(_star(sp, d).sales, _star(sp, d).products,
                                                 DRILL_PRODUCT),
    "product_vs_category": lambda sp, d: P.product_vs_category(_star(sp, d).sales,
                                                               _star(sp, d).products),
    "top_customers_per_product": lambda sp, d: C.top_customers_per_product(
        _star(sp, d).sales, _star(sp, d).customers, 5),
    "product_monthly_trend": lambda sp, d: T.monthly_trend(
        _star(sp, d).sales.where(F.col("product_id") == DRILL_PRODUCT), _star(sp, d).calendar, YOY_BASE, YOY_CURRENT),
    "top_customers_in_year": lambda sp, d: C.top_customers(
        K.filter_year(_star(sp, d).sales, KPI_YEAR), _star(sp, d).customers, 10),
    "product_vs_category_in_year": lambda sp, d: P.product_vs_category(
        K.filter_year(_star(sp, d).sales, KPI_YEAR), _star(sp, d).products),
    "order_details": lambda sp, d: P.order_details(_star(sp, d).sales, _star(sp, d).products,
                                                   _star(sp, d).customers, DRILL_PRODUCT),
}
