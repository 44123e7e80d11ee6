"""Data-quality checks (B-07..B-12): what a row store enforces on insert (keys, foreign
keys, NOT NULL, text length, decimal range, defaults), checked as DataFrame plans.

Each check is one aggregate or one anti join and returns the violations (or the
per-rule counts) as a DataFrame; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """B-07: (table_name, row_count) for every table, in the given order."""
    parts = [df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def check_primary_key(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B-08: key values that are NULL or appear more than once, with their row count.

    A partial aggregate per task collapses repeated keys before the shuffle, so even a
    key holding a large share of the rows costs one row per task.
    """
    cols = list(cols)
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("row_count"))
    return (g.where((F.col("row_count") > 1) | any_null)
             .withColumn("problem", F.when(any_null, "null key").otherwise("duplicate key")))


def check_foreign_key(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
                      parent_cols: Sequence[str] | None = None) -> DataFrame:
    """B-09: child key values (non-null) without a parent row, with their row count."""
    child_cols = list(child_cols)
    parent_cols = list(parent_cols or child_cols)
    present = F.lit(True)
    for c in child_cols:
        present = present & F.col(c).isNotNull()
    keys = child.where(present).groupBy(*child_cols).agg(F.count(F.lit(1)).alias("row_count"))
    p = parent.select(*[F.col(pc).alias(f"_p_{i}") for i, pc in enumerate(parent_cols)])
    cond = [keys[c] == p[f"_p_{i}"] for i, c in enumerate(child_cols)]
    return keys.join(p, cond, "left_anti")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """B-10: (column_name, null_count) for every column, from one aggregate."""
    agg = df.agg(*[F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"_n{i}")
                   for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.coalesce(F.col(f"_n{i}"), F.lit(0)).cast("bigint").alias("null_count"))
            for i, c in enumerate(cols)]
    return agg.select(F.inline(F.array(*rows)))


def check_domain(df: DataFrame, max_length: Mapping[str, int] | None = None,
                 decimal: Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """B-11: (column_name, rule, violations): text longer than its limit, values that do
    not fit DECIMAL(p, s). One aggregate for all rules."""
    rules = []
    for c, n in (max_length or {}).items():
        rules.append((c, f"max_length {n}", F.length(F.col(c)) > n))
    for c, (p, s) in (decimal or {}).items():
        rules.append((c, f"decimal({p},{s})",
                      F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()))
    agg = df.agg(*[F.sum(F.when(cond, 1).otherwise(0)).alias(f"_v{i}")
                   for i, (_, _, cond) in enumerate(rules)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"),
                     F.coalesce(F.col(f"_v{i}"), F.lit(0)).cast("bigint").alias("violations"))
            for i, (c, rule, _) in enumerate(rules)]
    return agg.select(F.inline(F.array(*rows)))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """B-12: replace NULL by the column default."""
    out = df
    for c, v in defaults.items():
        dtype = df.schema[c].dataType
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(dtype)))
    return out
