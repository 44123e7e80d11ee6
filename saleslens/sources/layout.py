"""Sales laid out by year and month of the sale (A-03, B-13, C-04, D-03).

The commonest predicates are by year and month, so the written fact table is partitioned
by both. Rows are rebalanced by month before the write: small months share a file each,
a large one is split over many, neither by a fixed number of files. Sales without a date
go to a partition of their own, which no period reads.

On such a table a period prunes months before any file is opened (``where_period``), a
join with a filtered Calendar prunes them while the query runs (``by_calendar`` joins on
the partition columns too), and the months present are known from the folder names alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslens.operators.periods import MONTH_COLUMN, YEAR_COLUMN

_PARTITIONS = (YEAR_COLUMN, MONTH_COLUMN)


def write_by_month(sales: DataFrame, path: str, date_col: str = "sale_date", mode: str = "append") -> None:
    """Write ``sales`` partitioned by the year and month of ``date_col``."""
    dated = sales.withColumn(YEAR_COLUMN, F.year(date_col)).withColumn(MONTH_COLUMN, F.month(date_col))
    (dated.hint("rebalance", *[F.col(c) for c in _PARTITIONS])
     .write.mode(mode).partitionBy(*_PARTITIONS).parquet(path))


def read_by_month(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``: the columns of ``schema``, then sale_year and sale_month."""
    known = {f.name for f in schema.fields}
    fields = [*schema.fields, *(T.StructField(c, T.IntegerType()) for c in _PARTITIONS if c not in known)]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def months_present(spark: SparkSession, path: str) -> DataFrame:
    """(year, month) of every month that holds sales, from the folders: no file is read.

    One row per month reaches the driver. A folder is written only with rows in it.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"{YEAR_COLUMN}=*/{MONTH_COLUMN}=*"))
    months = []
    for status in found or []:
        folder = status.getPath()
        year, month = (p.getName().split("=")[1] for p in (folder.getParent(), folder))
        if year.isdigit() and month.isdigit():
            months.append((int(year), int(month)))
    return spark.createDataFrame(sorted(months), "year int, month int")
