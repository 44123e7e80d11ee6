"""Incremental customer state (G-10, G-11, M-09, M-11): one row per customer that new
sales are merged into, instead of reading all sales again.

The state is kept in tables bucketed by customer: a merge reduces the new sales per
customer, moves only those to the state's buckets and writes the next version, the whole
of it in the same buckets. Dates, counts and DECIMAL sums merge exactly in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.functions.expr import as_double, as_long
from saleslens.operators.joins import by_calendar

_MERGE = {"first_date": F.least, "last_date": F.greatest}
_ADD = ("frequency", "n_rows", "monetary")
BUCKETS = 16


def customer_state(sales: DataFrame) -> DataFrame:
    """(customer_id, first_date, last_date, frequency, n_rows, monetary) of a batch of sales.
    Sales without a customer are left out."""
    return sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min("sale_date").alias("first_date"), F.max("sale_date").alias("last_date"),
        F.count("sale_id").alias("frequency"), F.count(F.lit(1)).alias("n_rows"), F.sum("total_amount").cast("decimal(38,2)").alias("monetary"))


def merge_state(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The state after ``batch``, itself a state of new sales; no sale may be in both."""
    new = batch.select(F.col("customer_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in batch.columns if c != "customer_id"])
    both = state.join(new, state["customer_id"] == new["_id"], "full")
    merged = [F.coalesce("customer_id", "_id").alias("customer_id")]
    # least and greatest skip nulls; a sum over nothing stays null
    merged += [how(c, f"_{c}").alias(c) for c, how in _MERGE.items()]
    for c in _ADD:
        total = F.coalesce(F.col(c) + F.col(f"_{c}"), F.col(c), F.col(f"_{c}"))
        merged.append(total.cast(state.schema[c].dataType).alias(c))
    return both.select(*merged)


def write_state(state: DataFrame, table: str, path: str, buckets: int = BUCKETS) -> DataFrame:
    """``state`` as a new table at ``path``, bucketed by customer; returns its scan."""
    (state.repartition(buckets, "customer_id").write.mode("error").format("parquet").option("path", path)
     .bucketBy(buckets, "customer_id").saveAsTable(table))
    return state.sparkSession.table(table)


def advance_state(spark: SparkSession, table: str, next_table: str, path: str, sales: DataFrame,
                  buckets: int = BUCKETS) -> DataFrame:
    """The state of ``table`` with ``sales`` merged in, as ``next_table`` at ``path``. The old
    version stays until it is dropped, so a failed merge loses nothing."""
    return write_state(merge_state(spark.table(table), customer_state(sales)), next_table, path, buckets)


def state_sales(state: DataFrame) -> DataFrame:
    """The per-customer part of the RFM base: what ``rfm_base`` makes of all sales."""
    return state.select("customer_id", "last_date", "frequency", "monetary")


def new_customers_of(state: DataFrame, calendar: DataFrame) -> DataFrame:
    """M-11 from the state: customers per month of their first purchase."""
    return (by_calendar(state, calendar, ["year", "month", "month_name"], date_col="first_date")
            .groupBy("year", "month", "month_name").agg(F.count("customer_id").alias("new_customers"))
            .select(as_long("year").alias("year"), as_long("month").alias("month"), "month_name",
                    as_long("new_customers").alias("new_customers")).orderBy("year", "month"))


def top_customers_of(state: DataFrame, customers: DataFrame, n: int = 10) -> DataFrame:
    """M-09 from the state: the ``n`` customers with the highest revenue (ties by customer_id)."""
    top = state.orderBy(F.desc("monetary"), "customer_id").limit(n)
    j = top.join(customers.select("customer_id", "customer_name", "customer_type", "region"), "customer_id", "left")
    return (j.select(as_long("customer_id").alias("customer_id"), "customer_name", "customer_type", "region",
                     as_long("frequency").alias("orders"), as_double("monetary").alias("revenue"))
            .orderBy(F.desc("revenue"), "customer_id"))
