"""Revenue analysis: yearly totals (G-01), product ranking (G-02), top products with
share of total (G-03), revenue by a dimension attribute (M-04).

Product-level plans aggregate Sales by ``product_id`` first and join Products to the
aggregate (eager aggregation): the fact table is reduced map-side before any shuffle,
and the dimension join sees one row per product instead of one per sale line.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslens.functions.expr import as_double, as_long, mean, round_half_up, safe_ratio
from saleslens.operators.windows import global_rank
from saleslens.session import materialize

# Product names left out of the share ranking by default.
DEFAULT_EXCLUDED_NAMES = ("?????",)


def revenue_by_year(sales: DataFrame) -> DataFrame:
    """G-01: per calendar year of the sale date: sale lines, revenue, mean line value, units."""
    return (sales.groupBy(F.year("sale_date").alias("year"))
            .agg(F.count("sale_id").alias("orders"),
                 F.sum("total_amount").alias("revenue"),
                 mean("total_amount").alias("avg_order_value"),
                 F.sum("quantity").alias("units"))
            .select(as_long("year").alias("year"), as_long("orders").alias("orders"),
                    as_double("revenue").alias("revenue"), "avg_order_value",
                    as_long("units").alias("units"))
            .orderBy("year"))


def product_totals(sales: DataFrame, products: DataFrame, attrs: Iterable[str],
                   measures: dict | None = None, ignore_case: bool = False) -> DataFrame:
    """Revenue and units per group of product attributes (not per product id).

    ``measures`` maps output name -> (per-product aggregate, regroup aggregate name). With
    ``ignore_case`` spellings that differ in case are one group, shown by the least one (a
    row store's usual collation groups so).
    """
    measures = measures or {
        "revenue": (F.sum("total_amount"), "sum"),
        "units": (F.sum("quantity"), "sum"),
    }
    attrs = list(attrs)
    per_product = sales.groupBy("product_id").agg(
        *[agg.alias(name) for name, (agg, _) in measures.items()])
    joined = per_product.join(products.select("product_id", *attrs), "product_id")
    regroup = {"sum": F.sum, "max": F.max, "min": F.min}
    if ignore_case:
        keys = [F.lower(c).alias(f"_{c}") for c in attrs]
        return joined.groupBy(*keys).agg(
            *[F.min(c).alias(c) for c in attrs],
            *[regroup[how](name).alias(name) for name, (_, how) in measures.items()]).drop(*[f"_{c}" for c in attrs])
    return joined.groupBy(*attrs).agg(
        *[regroup[how](name).alias(name) for name, (_, how) in measures.items()])


def rank_products(sales: DataFrame, products: DataFrame, top_n: int | None = None,
                  ignore_case: bool = False) -> DataFrame:
    """G-02 / M-06: rank of (name, category, brand) groups by revenue, ties share a rank.

    Ids sharing name, category and brand merge into one group. ``top_n`` keeps groups
    ranked within the first ``top_n`` (ties at the border are all kept).
    """
    groups = product_totals(sales, products, ["product_name", "category", "brand"], ignore_case=ignore_case)
    if top_n is None:
        ranked = global_rank(materialize(groups, "groups"), "revenue", ascending=False, name="rank")
    else:
        # The filter becomes a rank limit: each task sends only its own first top_n.
        first = F.rank().over(Window.orderBy(F.desc("revenue"))).cast("bigint")
        ranked = groups.withColumn("rank", first).where(F.col("rank") <= top_n)
    return ranked.select("product_name", "category", "brand",
                         as_double("revenue").alias("revenue"), as_long("units").alias("units"),
                         "rank")


def top_products_share(sales: DataFrame, products: DataFrame, n: int = 10,
                       exclude_names: Iterable[str] = DEFAULT_EXCLUDED_NAMES) -> DataFrame:
    """G-03: top ``n`` (name, category) groups by revenue with their % of the total.

    Excluded names leave the total as well. The total is a scalar subquery over the
    grouped rows: computed once, never a single-partition window over the groups.
    """
    groups = product_totals(sales, products, ["product_name", "category"],
                            {"revenue": (F.sum("total_amount"), "sum")})
    excluded = list(exclude_names)
    if excluded:
        groups = groups.where(~F.col("product_name").isin(excluded))
    total = groups.select(F.sum("revenue")).scalar()
    share = round_half_up(safe_ratio(as_double("revenue"), total.cast("double")) * 100, 2)
    return (groups.select("product_name", "category", as_double("revenue").alias("revenue"),
                          share.alias("pct_of_total"))
            .orderBy(F.desc("revenue"), "product_name", "category")
            .limit(n))


def revenue_by(sales: DataFrame, dim: DataFrame, key: str, attr: str) -> DataFrame:
    """M-04: sale lines, revenue and % of total per dimension attribute.

    ``dim`` is Products (key product_id) or Customers (key customer_id); sales are
    reduced per key before the dimension join.
    """
    per_key = sales.groupBy(key).agg(F.count("sale_id").alias("orders"),
                                     F.sum("total_amount").alias("revenue"))
    groups = (per_key.join(dim.select(key, attr), key)
              .groupBy(attr).agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue")))
    total = groups.select(F.sum("revenue")).scalar()
    share = round_half_up(safe_ratio(as_double("revenue"), total.cast("double")) * 100, 2)
    return (groups.select(attr, as_long("orders").alias("orders"),
                          as_double("revenue").alias("revenue"), share.alias("pct_of_total"))
            .orderBy(F.desc("revenue")))
