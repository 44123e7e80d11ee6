"""Product performance: rank within category (G-07), organic vs conventional (G-08),
products never sold (G-09), top n per category (G-12), single-product KPIs (M-12),
product vs category mean (M-13), order lines of a product (M-15).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.functions.expr import as_double, as_long, safe_ratio
from saleslens.operators.joins import join_null_safe, small
from saleslens.operators.periods import where_period
from saleslens.operators.windows import global_rank, top_n_per_group
from saleslens.session import materialize
from saleslens.plans.revenue import product_totals

# Labels of the organic flag (true, otherwise).
ORGANIC_LABEL = "Organico"
CONVENTIONAL_LABEL = "Convenzionale"


def rank_in_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    """G-07: per (category, name, brand): sale lines, revenue, mean discount % per line,
    and the revenue rank inside the category (ties share a rank)."""
    groups = product_totals(sales, products, ["category", "product_name", "brand"], {
        "orders": (F.count("sale_id"), "sum"),
        "revenue": (F.sum("total_amount"), "sum"),
        "disc_sum": (F.sum("discount_pct"), "sum"),
        "disc_n": (F.count("discount_pct"), "sum"),
    })
    ranked = global_rank(materialize(groups, "groups"), "revenue", ascending=False, partition_by=["category"],
                         name="rank_in_category")
    return (ranked.select("category", "product_name", "brand", as_long("orders").alias("orders"),
                          as_double("revenue").alias("revenue"),
                          safe_ratio(as_double("disc_sum"), "disc_n").alias("avg_discount_pct"),
                          "rank_in_category")
            .orderBy("category", "rank_in_category"))


def organic_split(products: DataFrame, sales: DataFrame) -> DataFrame:
    """G-08: products LEFT JOIN sales grouped by the raw organic flag.

    A NULL flag is its own group (labelled like false). The mean list price is taken
    over joined rows: a product weighs as many times as it has sales (once if unsold).
    Sales are reduced to one row per product before the join.
    """
    per = sales.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("sale_id").alias("n_sales"),
        F.sum("total_amount").alias("rev"), F.count("total_amount").alias("n_total"),
        F.sum("discount_pct").alias("disc_sum"), F.count("discount_pct").alias("disc_n"))
    j = products.select("product_id", "is_organic", "unit_price").join(per, "product_id", "left")
    weight = F.greatest(F.coalesce(F.col("n_rows"), F.lit(0)), F.lit(1))
    g = j.groupBy("is_organic").agg(
        F.countDistinct("product_id").alias("products"),
        F.sum(F.coalesce(F.col("n_sales"), F.lit(0))).alias("sales"),
        F.sum("rev").alias("revenue"),
        F.sum("n_total").alias("n_total"),
        F.sum(F.col("unit_price") * weight).alias("price_sum"),
        F.sum(F.when(F.col("unit_price").isNotNull(), weight)).alias("price_n"),
        F.sum("disc_sum").alias("disc_sum"), F.sum("disc_n").alias("disc_n"))
    label = F.when(F.col("is_organic"), F.lit(ORGANIC_LABEL)).otherwise(F.lit(CONVENTIONAL_LABEL))
    return (g.select(label.alias("product_type"), as_long("products").alias("products"),
                     as_long("sales").alias("sales"), as_double("revenue").alias("revenue"),
                     safe_ratio(as_double("revenue"), "n_total").alias("avg_order_value"),
                     safe_ratio(as_double("price_sum"), "price_n").alias("avg_list_price"),
                     safe_ratio(as_double("disc_sum"), "disc_n").alias("avg_discount_pct"))
            .orderBy(F.desc("revenue")))


def unsold_products(products: DataFrame, sales: DataFrame, start=None, end=None) -> DataFrame:
    """G-09: products with no sale (in ``start <= sale_date < end`` when given).

    Anti join against the distinct sold ids: the fact side is de-duplicated map-side
    before its shuffle.
    """
    sold = where_period(sales, start, end).select("product_id").distinct()
    return (products.join(sold, "product_id", "left_anti")
            .select(as_long("product_id").alias("product_id"), "product_name", "brand", "category",
                    as_double("unit_price").alias("unit_price"), "launch_date")
            .orderBy("category", "product_name"))


def top_products_per_category(sales: DataFrame, products: DataFrame, n: int = 3) -> DataFrame:
    """G-12: exactly ``n`` (name, brand) groups per category by revenue (fewer only when
    the category has fewer); ties broken by name, then brand."""
    groups = product_totals(sales, products, ["category", "product_name", "brand"],
                            {"revenue": (F.sum("total_amount"), "sum")})
    top = top_n_per_group(groups, ["category"],
                          [F.desc("revenue"), F.asc("product_name"), F.asc("brand")], n)
    return (top.select("category", "product_name", "brand",
                       as_double(F.round("revenue", 2)).alias("revenue"), "position")
            .orderBy("category", "position"))


def product_kpis(sales: DataFrame, products: DataFrame, product_id: int) -> DataFrame:
    """M-12: KPIs of one product (drill-through): lines, units, revenue, mean line value,
    mean discount %, distinct customers."""
    s = sales.where(F.col("product_id") == product_id)
    agg = s.groupBy("product_id").agg(
        F.count("sale_id").alias("orders"), F.sum("quantity").alias("units"),
        F.sum("total_amount").alias("revenue"), F.count("total_amount").alias("n_total"),
        F.sum("discount_pct").alias("disc_sum"), F.count("discount_pct").alias("disc_n"),
        F.countDistinct("customer_id").alias("customers"))
    p = products.where(F.col("product_id") == product_id).select(
        "product_id", "product_name", "category", "brand")
    out = p.join(agg, "product_id", "left")
    return out.select(as_long("product_id").alias("product_id"), "product_name", "category", "brand",
                      as_long(F.coalesce("orders", F.lit(0))).alias("orders"),
                      as_long("units").alias("units"), as_double("revenue").alias("revenue"),
                      safe_ratio(as_double("revenue"), "n_total").alias("avg_order_value"),
                      safe_ratio(as_double("disc_sum"), "disc_n").alias("avg_discount_pct"),
                      as_long(F.coalesce("customers", F.lit(0))).alias("customers"))


def product_vs_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    """M-13: revenue of each sold product against the mean product revenue of its category."""
    per = sales.groupBy("product_id").agg(F.sum("total_amount").alias("revenue"))
    # read twice below: written, so that the facts are reduced and joined once
    pr = materialize(per.join(products.select("product_id", "product_name", "category"), "product_id"), "product-revenue")
    cat = pr.groupBy("category").agg(F.sum("revenue").alias("cat_sum"),
                                     F.count("revenue").alias("cat_n"))
    # A few large categories would be hot keys of a shuffle; one row each, written, is small.
    out = join_null_safe(pr, small(materialize(cat, "categories")), ["category"])
    cat_avg = safe_ratio(as_double("cat_sum"), "cat_n")
    return (out.select(as_long("product_id").alias("product_id"), "product_name", "category",
                       as_double("revenue").alias("revenue"),
                       cat_avg.alias("category_avg_revenue"),
                       (as_double("revenue") - cat_avg).alias("diff_vs_category"),
                       safe_ratio(as_double("revenue"), cat_avg).alias("ratio_vs_category"))
            .orderBy("category", F.desc("revenue"), "product_id"))


def order_details(sales: DataFrame, products: DataFrame, customers: DataFrame,
                  product_id: int) -> DataFrame:
    """M-15: the sale lines of one product with product and customer names."""
    s = sales.where(F.col("product_id") == product_id)
    p = products.where(F.col("product_id") == product_id).select("product_id", "product_name")
    c = customers.select("customer_id", "customer_name", "region")
    out = s.join(p, "product_id").join(c, "customer_id", "left")
    return (out.select(as_long("sale_id").alias("sale_id"), "sale_date",
                       as_long("product_id").alias("product_id"), "product_name",
                       as_long("customer_id").alias("customer_id"), "customer_name", "region",
                       as_long("quantity").alias("quantity"),
                       as_double("unit_price").alias("unit_price"),
                       as_double("discount_pct").alias("discount_pct"),
                       as_double("discount_amount").alias("discount_amount"),
                       as_double("total_amount").alias("total_amount"))
            .orderBy("sale_date", "sale_id"))
