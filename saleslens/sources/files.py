"""File sources and sinks: CSV tables (A-01), landed product JSON pages (A-02), CSV
export (B-14).

Readers always take an explicit schema (no inference pass, no drifting types) and run
in PERMISSIVE mode: a malformed field becomes NULL and the raw line is kept in a
corrupt-record column instead of failing the load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"

# Raw product page as landed from the product API: a page number and an array of
# products; page number and energy may arrive as number or text, so they are read as text.
PRODUCT_PAGE_SCHEMA = T.StructType([
    T.StructField("page", T.StringType(), True),
    T.StructField("products", T.ArrayType(T.StructType([
        T.StructField("product_name", T.StringType(), True),
        T.StructField("brands", T.StringType(), True),
        T.StructField("categories", T.StringType(), True),
        T.StructField("nutriments", T.StructType([
            T.StructField("energy-kcal_100g", T.StringType(), True),
        ]), True),
    ])), True),
    T.StructField(CORRUPT_COL, T.StringType(), True),
])


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType,
                   keep_corrupt: bool = True) -> DataFrame:
    """A-01: header CSV (quoted commas, UTF-8) with an explicit schema.

    Bad values (a date like 2024-13-45, text in a numeric column) become NULL; with
    ``keep_corrupt`` the raw line of such rows is in ``_corrupt_record``.
    """
    full = schema
    if keep_corrupt:
        full = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    return (spark.read
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL)
            .option("encoding", "UTF-8")
            .option("multiLine", False)
            .schema(full)
            .csv(path))


def _landed_pages(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read
            .option("multiLine", True)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT_COL)
            .schema(PRODUCT_PAGE_SCHEMA)
            .json(path)
            .withColumn("source", F.col("_metadata.file_path")))


def read_product_pages(spark: SparkSession, path: str) -> DataFrame:
    """A-02: landed JSON pages ``{"page": n, "products": [...]}`` -> one row per product.

    Columns: page, source (file), position (index in the page), product_name, brands,
    categories, energy_kcal. A field of another type becomes NULL and costs only itself (a
    page number as text is read, one that is no number is NULL). A page without a products
    array yields no rows; pages without usable JSON are in ``rejected_pages``.
    """
    return (_landed_pages(spark, path)
            .select(F.col("page").try_cast("bigint").alias("page"), "source",
                    F.posexplode("products").alias("position", "p"))
            .select("page", "source", "position",
                    F.col("p.product_name").alias("product_name"),
                    F.col("p.brands").alias("brands"),
                    F.col("p.categories").alias("categories"),
                    F.col("p.nutriments").getField("energy-kcal_100g").alias("energy_kcal")))


def rejected_pages(spark: SparkSession, path: str) -> DataFrame:
    """(source, raw text) of landed pages that give no products because they are not JSON."""
    return (_landed_pages(spark, path).where(F.col(CORRUPT_COL).isNotNull() & F.col("products").isNull())
            .select("source", F.col(CORRUPT_COL).alias("raw")))


def write_csv(df: DataFrame, path: str) -> None:
    """B-14: header CSV export, replacing what is at ``path`` (a folder of part files)."""
    df.write.mode("overwrite").option("header", True).csv(path)
