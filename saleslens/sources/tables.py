"""Typed table loads (B-06), table creation (B-13) and table scans (A-03).

Tables are Parquet: either catalog tables (``name`` without a slash) or folders.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslens.operators.joins import join_null_safe
from saleslens.operators.quality import check_foreign_key, check_not_null, fill_defaults
from saleslens.schemas import SCHEMAS, TABLE_RULES
from saleslens.session import materialize


def _is_path(target: str) -> bool:
    return "/" in target or "://" in target


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns in order, cast to its types (missing -> NULL)."""
    cols = []
    for f in schema.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A-03: scan a table by catalog name or Parquet folder."""
    return spark.read.parquet(target) if _is_path(target) else spark.table(target)


def _exists(spark: SparkSession, target: str) -> bool:
    if _is_path(target):
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(target)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(hpath)
    return spark.catalog.tableExists(target)


def key_conflicts(rows: DataFrame, key: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """The rows that a primary key refuses, with a ``problem``: a NULL in the key, a key
    that another row of the load has too (all of them), or one that is already present."""
    key = list(key)
    null = F.lit(False)
    for c in key:
        null = null | F.col(c).isNull()
    repeated = (rows.where(~null).groupBy(*key).count().where("count > 1")
                .select(*key, F.lit("repeated key").alias("_repeated")))
    out = rows.join(repeated, key, "left")
    problem = F.when(null, F.lit("null key")).otherwise(F.col("_repeated"))
    if existing is not None:
        out = out.join(existing.select(*key).distinct().withColumn("_present", F.lit("key already present")), key, "left")
        problem = F.coalesce(problem, F.col("_present"))
    out = out.withColumn("problem", problem).where(F.col("problem").isNotNull())
    return out.select(*rows.columns, "problem")


def load_table(df: DataFrame, target: str, schema: T.StructType | None = None,
               key: Sequence[str] | None = None, on_conflict: str = "error") -> int:
    """B-06: append ``df`` (cast to ``schema``) to a table; returns the rows written.

    ``on_conflict``: "error" raises when a key is NULL, repeats within the load or is
    already in the target (a primary key violation) and writes nothing; "skip" appends the
    other rows and leaves the refused ones, complete, to ``key_conflicts``, so re-running a
    load adds nothing. With a key the source is read once: the rows are written to the
    scratch folder and checked there.
    """
    if on_conflict not in ("error", "skip"):
        raise ValueError("on_conflict must be 'error' or 'skip'")
    spark = df.sparkSession
    rows = conform(df, schema) if schema is not None else df
    if key:
        key = list(key)
        rows = materialize(rows, "load")
        existing = read_table(spark, target) if _exists(spark, target) else None
        refused = materialize(key_conflicts(rows, key, existing).select(*key).distinct(), "refused")
        if not refused.isEmpty():
            if on_conflict == "error":
                raise ValueError(f"primary key violation on {key} loading {target}")
            rows = join_null_safe(rows, refused, key, "left_anti")
    seen = Observation()
    writer = rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append")
    if _is_path(target):
        writer.parquet(target)
    else:
        writer.format("parquet").saveAsTable(target)
    return seen.get["n"]


# Parents before the facts that refer to them.
LOAD_ORDER = ("products", "customers", "calendar", "sales")


def load_star(tables: Mapping[str, DataFrame], targets: Mapping[str, str]) -> dict[str, int]:
    """Load parents before facts, with defaults, NOT NULL, primary and foreign keys.

    Table by table: raises before writing the table that breaks a rule, those before it in
    the order stay written (``store.StarStore`` publishes all or none). Returns the rows
    written per table, in load order.
    """
    written = {}
    for name in LOAD_ORDER:
        if name not in tables:
            continue
        rules, spark = TABLE_RULES[name], tables[name].sparkSession
        rows = materialize(fill_defaults(conform(tables[name], SCHEMAS[name]), rules["defaults"]), name)
        nulls = check_not_null(rows, rules["not_null"]).where("null_count > 0").collect()
        if nulls:
            raise ValueError(f"NULL in {[r.column_name for r in nulls]} loading {name}")
        for column, (parent, parent_key) in rules.get("foreign_keys", {}).items():
            if parent in targets and not check_foreign_key(
                    rows, read_table(spark, targets[parent]), [column], [parent_key]).isEmpty():
                raise ValueError(f"unknown {column} loading {name}")
        written[name] = load_table(rows, targets[name], key=rules["key"])
    return written


def _ddl_type(name: str, f: T.StructField, rules: dict) -> str:
    n = rules.get("max_length", {}).get(name)
    if n is not None:
        return f"VARCHAR({n})"
    return f.dataType.simpleString().upper()


def ensure_tables(spark: SparkSession, database: str = "retail",
                  location: str | None = None) -> list[str]:
    """B-13: CREATE DATABASE / TABLE IF NOT EXISTS for the star, Parquet, with the
    declared text limits (VARCHAR(n), enforced on insert) and column defaults."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    created = []
    for name, schema in SCHEMAS.items():
        rules = TABLE_RULES[name]
        defaults = rules.get("defaults", {})
        cols = []
        for f in schema.fields:
            col = f"{f.name} {_ddl_type(f.name, f, rules)}"
            if f.name in defaults:
                v = defaults[f.name]
                col += f" DEFAULT {str(v).upper() if isinstance(v, bool) else v}"
            cols.append(col)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({', '.join(cols)}) USING parquet")
        created.append(f"{database}.{name}")
    return created
