"""Customer analytics: RFM scores (G-10), segment distribution (G-11), discount impact
(G-13), top customers (M-09), top customers per product (M-14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslens.functions.expr import as_double, as_long, days_between, round_half_up, safe_ratio
from saleslens.operators.windows import global_ntiles, top_n_per_group
from saleslens.session import materialize

# RFM reference date, segment thresholds on R + F + M (four tiles each)
# and labels, first match wins.
RFM_AS_OF = "2024-12-31"
RFM_SEGMENTS = (
    (10, "Champions"),
    (8, "Loyal Customers"),
    (6, "Potential Loyalists"),
    (4, "At Risk"),
)
RFM_OTHERWISE = "Lost"

_RFM_ATTRS = ["customer_id", "customer_name", "customer_type", "region"]


def rfm_base(sales: DataFrame, customers: DataFrame, as_of=RFM_AS_OF,
             group_cols: Sequence[str] = tuple(_RFM_ATTRS)) -> DataFrame:
    """Recency (days from the last sale to ``as_of``), frequency (sale lines) and
    monetary (revenue, DECIMAL) per customer group; customers without sales drop out.

    Sales are reduced per customer_id first; the regroup by ``group_cols`` after the join
    keeps the result identical to grouping the joined rows directly. Sales that were reduced
    before (``state.state_sales``, told by their ``monetary``) are taken as they are.
    """
    per = sales if "monetary" in sales.columns else sales.groupBy("customer_id").agg(
        F.max("sale_date").alias("last_date"), F.count("sale_id").alias("frequency"),
        F.sum("total_amount").alias("monetary"))
    cols = list(dict.fromkeys(["customer_id", *group_cols]))
    j = per.join(customers.select(*cols), "customer_id")
    g = j.groupBy(*group_cols).agg(F.max("last_date").alias("last_date"),
                                   F.sum("frequency").alias("frequency"),
                                   F.sum("monetary").alias("monetary"))
    recency = days_between("last_date", F.lit(as_of).cast("date"))
    return g.withColumn("recency_days", recency).drop("last_date")


def segment_of(score) -> F.Column:
    expr = None
    for threshold, label in RFM_SEGMENTS:
        cond = score >= threshold
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(RFM_OTHERWISE)


def rfm_scored(sales: DataFrame, customers: DataFrame, as_of=RFM_AS_OF, tiles: int = 4,
               orientation: str = "reference",
               group_cols: Sequence[str] = tuple(_RFM_ATTRS)) -> DataFrame:
    """RFM base plus r/f/m tiles, score and segment (monetary still DECIMAL).

    Tiles: recency ascending, frequency and monetary descending, ties broken by
    customer_id, so tile 1 holds the most recent / most frequent / highest spending
    customers. ``orientation="reference"`` keeps that numbering (the thresholds then
    label the weakest customers 'Champions'); ``"best_high"`` flips every tile to
    ``tiles + 1 - tile`` so high scores mean good customers.
    """
    if orientation not in ("reference", "best_high"):
        raise ValueError("orientation must be 'reference' or 'best_high'")
    keys = list(group_cols)
    # The base is read by three orderings and the final join: write it once.
    base = materialize(rfm_base(sales, customers, as_of, keys), "rfm_base")
    out = global_ntiles(base, tiles, [("recency_days", True, "r_score"),
                                      ("frequency", False, "f_score"),
                                      ("monetary", False, "m_score")], key="customer_id")
    if orientation == "best_high":
        for name in ("r_score", "f_score", "m_score"):
            out = out.withColumn(name, tiles + 1 - F.col(name))
    score = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return out.withColumn("rfm_score", score).withColumn("segment", segment_of(F.col("rfm_score")))


def rfm_scores(sales: DataFrame, customers: DataFrame, as_of=RFM_AS_OF, tiles: int = 4,
               orientation: str = "reference") -> DataFrame:
    """G-10: RFM per customer, ordered by total score (highest first)."""
    s = rfm_scored(sales, customers, as_of, tiles, orientation)
    return (s.select(as_long("customer_id").alias("customer_id"), "customer_name", "customer_type",
                     "region", as_long("recency_days").alias("recency_days"),
                     as_long("frequency").alias("frequency"),
                     as_double(F.round("monetary", 2)).alias("monetary"),
                     as_long("r_score").alias("r_score"), as_long("f_score").alias("f_score"),
                     as_long("m_score").alias("m_score"), as_long("rfm_score").alias("rfm_score"),
                     "segment")
            .orderBy(F.desc("rfm_score"), "customer_id"))


def segment_distribution(sales: DataFrame, customers: DataFrame, as_of=RFM_AS_OF, tiles: int = 4,
                         orientation: str = "reference") -> DataFrame:
    """G-11: customers, mean and total monetary (rounded to cents first) and % of
    customers per segment. The % window spans one row per segment label."""
    s = rfm_scored(sales, customers, as_of, tiles, orientation, group_cols=["customer_id"])
    s = s.withColumn("monetary", F.round("monetary", 2))
    g = s.groupBy("segment").agg(F.count("customer_id").alias("customers"),
                                 F.sum("monetary").alias("m_sum"),
                                 F.count("monetary").alias("m_n"))
    share = safe_ratio(as_double("customers") * 100.0,
                       as_double(F.sum("customers").over(Window.partitionBy())))
    return (g.select("segment", as_long("customers").alias("customers"),
                     round_half_up(safe_ratio(as_double("m_sum"), "m_n"), 2).alias("avg_monetary"),
                     as_double(F.round("m_sum", 2)).alias("total_monetary"),
                     round_half_up(share, 1).alias("pct_customers"))
            .orderBy(F.desc("total_monetary")))


def discount_impact(sales: DataFrame, customers: DataFrame, by: str = "region") -> DataFrame:
    """G-13: per customer attribute: lines, revenue, discounts, potential revenue
    (revenue + discounts), % of potential lost to discounts, mean discount %."""
    per = sales.groupBy("customer_id").agg(
        F.count("sale_id").alias("orders"), F.sum("total_amount").alias("rev"),
        F.sum("discount_amount").alias("disc"), F.sum("discount_pct").alias("pct_sum"),
        F.count("discount_pct").alias("pct_n"))
    g = (per.join(customers.select("customer_id", by), "customer_id")
         .groupBy(by).agg(F.sum("orders").alias("orders"), F.sum("rev").alias("rev"),
                          F.sum("disc").alias("disc"), F.sum("pct_sum").alias("pct_sum"),
                          F.sum("pct_n").alias("pct_n")))
    potential = F.col("rev") + F.col("disc")
    return (g.select(by, as_long("orders").alias("orders"),
                     as_double(F.round("rev", 2)).alias("revenue"),
                     as_double(F.round("disc", 2)).alias("discounts"),
                     as_double(F.round(potential, 2)).alias("potential_revenue"),
                     round_half_up(safe_ratio(as_double("disc") * 100.0, as_double(potential)), 2)
                     .alias("pct_lost"),
                     round_half_up(safe_ratio(as_double("pct_sum"), "pct_n"), 2)
                     .alias("avg_discount_pct"))
            .orderBy(F.desc("revenue")))


def top_customers(sales: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """M-09: the ``n`` customers with the highest revenue (ties by customer_id).

    The ``n`` are taken before their attributes are looked up; a buyer that is no known
    customer appears without attributes.
    """
    per = (sales.groupBy("customer_id").agg(F.count("sale_id").alias("orders"),
                                            F.sum("total_amount").alias("revenue"))
           .orderBy(F.desc("revenue"), "customer_id").limit(n))
    j = per.join(customers.select("customer_id", "customer_name", "customer_type", "region"),
                 "customer_id", "left")
    return (j.select(as_long("customer_id").alias("customer_id"), "customer_name", "customer_type",
                     "region", as_long("orders").alias("orders"),
                     as_double("revenue").alias("revenue"))
            .orderBy(F.desc("revenue"), "customer_id"))


def top_customers_per_product(sales: DataFrame, customers: DataFrame, n: int = 5) -> DataFrame:
    """M-14: the ``n`` best customers of every product by revenue (ties by customer_id)."""
    pairs = sales.groupBy("product_id", "customer_id").agg(
        F.count("sale_id").alias("orders"), F.sum("total_amount").alias("revenue"))
    top = top_n_per_group(pairs, ["product_id"], [F.desc("revenue"), F.asc("customer_id")], n)
    j = top.join(customers.select("customer_id", "customer_name"), "customer_id", "left")
    return (j.select(as_long("product_id").alias("product_id"),
                     as_long("customer_id").alias("customer_id"), "customer_name",
                     as_long("orders").alias("orders"), as_double("revenue").alias("revenue"),
                     "position")
            .orderBy("product_id", "position"))
