"""Registered queries on tables that are written first: the monthly layout, checked loads,
the star store, cubes, sketches, customer state and collated text. What is written comes
from the test tables and goes to the session's scratch folder.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslens.functions.expr import as_long
from saleslens.operators.collation import fold_spellings
from saleslens.plans import customers as C
from saleslens.plans import kpi as K
from saleslens.plans import products as P
from saleslens.plans import revenue as R
from saleslens.plans import rollup as U
from saleslens.plans import state as S
from saleslens.plans import timeseries as M
from saleslens.session import evaluated_once, scratch_path
from saleslens.sources.adapter import read_parquet_table, star_from_tpch
from saleslens.sources.files import read_csv_table, read_product_pages, write_csv
from saleslens.sources.layout import months_present, read_by_month, write_by_month
from saleslens.sources.staging import PROBLEMS, rule_counts, stage
from saleslens.sources.store import BUCKETS, StarStore

YOY_BASE, YOY_CURRENT, KPI_YEAR = 1999, 2000, 2000
RFM_AS_OF = dt.date(2001, 12, 31)
ROWS_A_BUCKET = 4_000_000
SPLIT = "1998-07-01"  # the day that parts old sales from new ones
PERIOD = (dt.date(1997, 3, 1), dt.date(1999, 3, 1))


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex}"


def _by_month(spark: SparkSession, d: str):
    star, path = star_from_tpch(spark, d), scratch_path(spark, _name("sales"))
    write_by_month(star.sales, path)
    return star, read_by_month(spark, path, star.sales.schema), path


def _trend_by_month(spark, d):
    star, sales, _ = _by_month(spark, d)
    return M.monthly_trend(sales, star.calendar, YOY_BASE, YOY_CURRENT)


def _yoy_by_month(spark, d):
    star, sales, path = _by_month(spark, d)
    return M.revenue_yoy_quarter(sales, star.calendar, YOY_BASE, YOY_CURRENT, months_present(spark, path))


def _kpi_by_month(spark, d):
    return K.kpi_summary(_by_month(spark, d)[1], KPI_YEAR)


LABELLED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                         T.StructField("source", T.StringType()), T.StructField("n_chars", T.DecimalType(3, 0)),
                         T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.ByteType())])
LABELLED_RULES = {"key": ["doc_id"], "not_null": ["doc_id", "lang", "quality", "toxic"], "max_length": {"text": 2000, "source": 4},
                  "decimal": {"n_chars": (3, 0)}, "defaults": {"toxic": 0}}


def _staged_documents(spark, d):
    """Documents with their labels, where they have any, under narrow rules."""
    docs, labels = (read_parquet_table(spark, d, t) for t in ("documents", "labels"))
    return stage(docs.join(labels, "doc_id", "left"), "documents", scratch_path(spark, _name("staged")), LABELLED, LABELLED_RULES)


def _load_problems(spark, d):
    return rule_counts([_staged_documents(spark, d)])


def _load_rejects(spark, d):
    rows = _staged_documents(spark, d).rejects
    return rows.select("doc_id", F.array_join(F.transform(PROBLEMS, lambda p: F.concat_ws(" ", p["column_name"], p["rule"])), "; ").alias("problems"),
                       as_long("toxic").alias("toxic"))


def _star_loads(spark, d):
    """Two loads (the second brings the first one's sales again), and the second once more.

    Both read the sales, so these are joined once; their number gives the store's buckets.
    """
    star = star_from_tpch(spark, d)
    sales, n = evaluated_once(star.sales, "sales", "zstd")
    store = StarStore(spark, _name("store"), scratch_path(spark, _name("store")), max(BUCKETS, math.ceil(n / ROWS_A_BUCKET)))
    old = sales.where(F.col("sale_date") < SPLIT)
    known = star.products.where("NOT is_organic")
    first = {"products": known, "customers": star.customers, "calendar": star.calendar, "sales": old}
    second = {"products": star.products, "sales": sales}
    for load_id, tables in (("first", first), ("second", second), ("second", second)):
        store.load(tables, load_id, on_problem="reject")
    return store


def _star_load_counts(spark, d):
    store = _star_loads(spark, d)
    rows = [(load_id, name, n["accepted"], n["refused"]) for load_id in store.loads() for name, n in store.counts(load_id).items()]
    return spark.createDataFrame(rows, "load_id string, table_name string, accepted bigint, refused bigint")


def _star_load_rejects(spark, d):
    rows = _star_loads(spark, d).rejects("sales")
    return rows.select(F.col("load_id"), F.inline(PROBLEMS)).groupBy("load_id", "column_name", "rule").agg(F.count(F.lit(1)).alias("violations"))


def _star_load_revenue(spark, d):
    return R.revenue_by_year(_star_loads(spark, d).read("sales"))


def _cube(spark, d):
    star = star_from_tpch(spark, d)
    return U.cube_cards(U.sales_cube(star.sales, star.products, star.customers))


def _buyers(spark, d):
    star = star_from_tpch(spark, d)
    return U.buyer_estimates(star.sales, star.customers, *PERIOD)


def _state(spark, d):
    """The state of the sales before a day, with the later ones merged in."""
    star, tables = star_from_tpch(spark, d), [_name("state"), _name("state")]
    paths = [scratch_path(spark, t) for t in tables]
    S.write_state(S.customer_state(star.sales.where(F.col("sale_date") < SPLIT)), tables[0], paths[0])
    S.advance_state(spark, tables[0], tables[1], paths[1], star.sales.where(F.col("sale_date") >= SPLIT))
    for table in tables:  # the files stay: the tables are external
        spark.sql(f"DROP TABLE {table}")
    return star, spark.read.parquet(paths[1])


def _rfm_from_state(spark, d):
    star, state = _state(spark, d)
    return C.rfm_scores(S.state_sales(state), star.customers, RFM_AS_OF)


def _new_customers_from_state(spark, d):
    star, state = _state(spark, d)
    return S.new_customers_of(state, star.calendar)


def _top_customers_from_state(spark, d):
    star, state = _state(spark, d)
    return S.top_customers_of(state, star.customers, 10)


def _folded(spark, d):
    """The star with names and categories spelled in several cases, then folded."""
    star = star_from_tpch(spark, d)
    i = F.col("product_id")
    mixed = (star.products.withColumn("product_name", F.when(i % 2 == 1, F.upper("product_name")).otherwise(F.col("product_name")))
             .withColumn("category", F.when(i % 3 == 1, F.lower("category")).when(i % 3 == 2, F.upper("category")).otherwise(F.col("category"))))
    return star.sales, fold_spellings(mixed, ["product_name", "category"])


def _csv_round_trip(spark, d):
    path = scratch_path(spark, _name("customer_csv"))
    customer = read_parquet_table(spark, d, "customer")
    write_csv(customer, path)
    return read_csv_table(spark, path, customer.schema, keep_corrupt=False)


def _json_pages(spark, d):
    """Parts as product pages of an API, fifty a page, landed as JSON and read back."""
    path = scratch_path(spark, _name("pages"))
    part = read_parquet_table(spark, d, "part")
    product = F.struct(F.col("p_name").alias("product_name"), F.col("p_brand").alias("brands"), F.col("p_type").alias("categories"),
                       F.struct(F.col("p_size").alias("energy-kcal_100g")).alias("nutriments"))
    pages = part.groupBy(F.floor(F.col("p_partkey") / 50).cast("string").alias("page")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", product.alias("product")))), lambda x: x["product"]).alias("products"))
    # a file a page, as an API lands them
    pages.withColumn("_file", F.col("page")).repartition("_file").write.partitionBy("_file").json(path)
    return read_product_pages(spark, path).drop("source").withColumn("position", as_long("position"))


STORED_QUERIES = {
    "monthly_trend_by_month": _trend_by_month,
    "revenue_yoy_quarter_by_month": _yoy_by_month,
    "kpi_summary_by_month": _kpi_by_month,
    "load_problems": _load_problems,
    "load_rejects": _load_rejects,
    "star_load_counts": _star_load_counts,
    "star_load_rejects": _star_load_rejects,
    "star_load_revenue": _star_load_revenue,
    "sales_cube": _cube,
    "buyer_estimates": _buyers,
    "rfm_scores_from_state": _rfm_from_state,
    "new_customers_from_state": _new_customers_from_state,
    "top_customers_from_state": _top_customers_from_state,
    "top_products_share_ignore_case": lambda sp, d: R.top_products_share(*_folded(sp, d)),
    "rank_in_category_ignore_case": lambda sp, d: P.rank_in_category(*_folded(sp, d)),
    "top3_per_category_ignore_case": lambda sp, d: P.top_products_per_category(*_folded(sp, d), 3),
    "csv_round_trip": _csv_round_trip,
    "json_pages": _json_pages,
}
