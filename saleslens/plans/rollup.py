"""Pre-aggregated sales: a cube of the card measures (M-01, M-04, M-07, M-08) and daily
sketches of the buyers (E-05, M-01, M-10).

The cube holds, for every combination of year, region and category and all their
totals, sums and counts that add up, so cards under any of these filters are a look-up.
Facts are read once: they are reduced to the finest cells, and to distinct (year, region,
category, customer), before anything is rolled up. Distinct buyers do not add up over
years and categories, but a customer has one region, so those of regions do.

Sketches (HyperLogLog) of each day's buyers per region unite for any period without
reading a fact. They are estimates; the exact count stays what every other plan returns.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.functions.expr import as_double, as_long, in_period, safe_ratio
from saleslens.session import materialize

LEVELS = ("year", "region", "category")
SKETCH_LG_K = 14  # 2 ** 14 registers: a standard error of 0.8 %


def _facts(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales per (year, product, customer), then with region and category. Lines of
    unknown products or customers stay, with a null attribute."""
    per = sales.groupBy(F.year("sale_date").alias("year"), "product_id", "customer_id").agg(
        F.count("sale_id").alias("orders"), F.sum("total_amount").alias("revenue"), F.count("total_amount").alias("n_total"),
        F.sum("discount_pct").alias("disc_sum"), F.count("discount_pct").alias("disc_n"))
    return (per.join(products.select("product_id", "category"), "product_id", "left")
            .join(customers.select("customer_id", "region"), "customer_id", "left"))


_SUMS = ("orders", "revenue", "n_total", "disc_sum", "disc_n")


def sales_cube(sales: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """(level, year, region, category, orders, revenue, n_total, disc_sum, disc_n, buyers).

    ``level`` tells totals from null values: bit 4 (2, 1) is set where the cell is over all
    years (regions, categories). A total over nothing exists only if there are sales.
    """
    facts = materialize(_facts(sales, products, customers), "cells")
    level = F.grouping_id().cast("int").alias("level")
    # the finest cells are few; the eight levels are made of them
    finest = materialize(facts.groupBy(*LEVELS).agg(*[F.sum(c).alias(c) for c in _SUMS]), "finest")
    sums = finest.cube(*LEVELS).agg(level, *[F.sum(c).alias(c) for c in _SUMS])
    # distinct buyers: each (cell of year and category, region, customer) once, combined map-side
    pairs = facts.where(F.col("customer_id").isNotNull()).select(*LEVELS, "customer_id").distinct()
    y, r, c, who = "year", "region", "category", "customer_id"
    once = pairs.groupingSets([[y, r, c, who], [y, r, who], [c, r, who], [r, who]], y, r, c, who).agg(
        F.grouping(y).alias("gy"), F.grouping(c).alias("gc"))
    by_region = once.groupBy("gy", "gc", *LEVELS).agg(F.count(F.lit(1)).alias("buyers"))
    # a customer has one region: regions add up
    counted = by_region.groupingSets([["gy", "gc", y, r, c], ["gy", "gc", y, c]], "gy", "gc", y, r, c).agg(
        F.sum("buyers").alias("buyers"), F.grouping(r).alias("gr"))
    buyers = counted.select((F.col("gy") * 4 + F.col("gr") * 2 + F.col("gc")).cast("int").alias("b_level"),
                            *[F.col(x).alias(f"b_{x}") for x in LEVELS], "buyers")
    on = [sums["level"] == buyers["b_level"], *[sums[x].eqNullSafe(buyers[f"b_{x}"]) for x in LEVELS]]
    return (sums.join(buyers, on, "left").withColumn("buyers", F.coalesce("buyers", F.lit(0)))
            .select("level", *LEVELS, *_SUMS, "buyers"))


def cube_cards(cube: DataFrame) -> DataFrame:
    """M-01 for every cell of a cube: level, year, region, category and the card measures."""
    return cube.select(as_long("level").alias("level"), as_long("year").alias("year"), "region", "category",
                       as_double("revenue").alias("revenue"), as_long("orders").alias("orders"),
                       as_long("buyers").alias("active_customers"),
                       safe_ratio(as_double("revenue"), "n_total").alias("avg_order_value"),
                       safe_ratio(as_double("disc_sum"), "disc_n").alias("avg_discount_pct"))


def cards_of(cube: DataFrame, **filters) -> DataFrame:
    """M-01 under optional filters (year, region, category): one cell of a cube. A filter of
    None asks for the rows without that attribute, a missing one for all."""
    unknown = set(filters) - set(LEVELS)
    if unknown:
        raise ValueError(f"the cube has no {sorted(unknown)}")
    level = sum(bit for bit, c in zip((4, 2, 1), LEVELS) if c not in filters)
    cell = cube.where(F.col("level") == level)
    for c, v in filters.items():
        cell = cell.where(F.col(c).eqNullSafe(F.lit(v)))
    return cube_cards(cell).drop("level", *LEVELS)


def buyer_sketches(sales: DataFrame, customers: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """(sale_date, region, orders, revenue, buyers): ``buyers`` is a sketch of the day's
    distinct customers. Partial sketches are united map-side: a day is never a hot key."""
    located = sales.join(customers.select("customer_id", "region"), "customer_id", "left")
    return located.groupBy("sale_date", "region").agg(
        F.count("sale_id").alias("orders"), F.sum("total_amount").alias("revenue"),
        F.hll_sketch_agg("customer_id", lg_k).alias("buyers"))


def buyers_between(sketches: DataFrame, start=None, end=None, by: tuple[str, ...] = ()) -> DataFrame:
    """Estimated distinct buyers with ``start <= sale_date < end``, and exact orders and
    revenue, per column of ``by`` (region, or year and month of the day), from sketches alone."""
    parts = {"year": F.year("sale_date").alias("year"), "month": F.month("sale_date").alias("month")}
    chosen = sketches.where(in_period("sale_date", start, end))
    return chosen.groupBy(*[parts.get(c, F.col(c)) for c in by]).agg(
        F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"),
        F.hll_sketch_estimate(F.hll_union_agg("buyers")).alias("buyers"))


def buyer_estimates(sales: DataFrame, customers: DataFrame, start: dt.date, end: dt.date, tolerance: float = 0.03) -> DataFrame:
    """Per region and for all: exact buyers of a period, and whether the sketches' estimate
    lies within ``tolerance`` of them."""
    sketches = materialize(buyer_sketches(sales, customers), "sketches")
    estimated = (buyers_between(sketches, start, end, ("region",)).withColumn("whole", F.lit(False))
                 .unionByName(buyers_between(sketches, start, end).withColumn("region", F.lit(None).cast("string"))
                              .withColumn("whole", F.lit(True))))
    dated = sales.where(in_period("sale_date", start, end)).join(customers.select("customer_id", "region"), "customer_id", "left")
    # a customer has one region: the regions' exact counts add up
    exact = dated.groupBy("region").agg(F.countDistinct("customer_id").alias("exact"))
    exact = exact.withColumn("whole", F.lit(False)).unionByName(
        exact.agg(F.sum("exact").alias("exact")).select(F.lit(None).cast("string").alias("region"), "exact", F.lit(True).alias("whole")))
    e = exact.withColumnsRenamed({"region": "e_region", "whole": "e_whole"})
    out = estimated.join(e, estimated["region"].eqNullSafe(e["e_region"]) & (estimated["whole"] == e["e_whole"]))
    return out.select("region", "whole", as_long("orders").alias("orders"), as_double("revenue").alias("revenue"),
                      as_long("exact").alias("buyers"), (F.abs(F.col("buyers") - F.col("exact")) <= tolerance * F.col("exact")).alias("within"))
