"""One-pass validation while loading (B-06, B-08 to B-12).

``stage`` evaluates every rule of a table on every source row, as an array of problems,
while it writes the rows once; counts per rule are observed during that write, so the
source is read a single time. A column tells rows without a problem from rows with one,
so the write need not sort them. What needs several rows (repeated keys, keys already
loaded, unknown parents) is then checked on the staged keys alone, never on the source.

Checks against a large target move only the new rows: they are the build side of a hash
join whose other side, if it is a table bucketed by the key, is read where it lies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROBLEMS, REFUSED = "_problems", "_refused"
KIND = "array<struct<column_name:string,rule:string>>"  # of PROBLEMS
NULL_KEY, REPEATED_KEY, PRESENT_KEY, NO_PARENT = "null key", "repeated key", "key already present", "unknown parent"


def row_rules(schema: T.StructType, rules: Mapping) -> list[tuple[str, str]]:
    """(column, rule) of every rule that one row can break, in a fixed order."""
    decimal, out = rules.get("decimal", {}), []
    for f in schema.fields:
        if f.name in rules.get("key", ()):
            out.append((f.name, NULL_KEY))
        elif f.name in rules.get("not_null", ()):
            out.append((f.name, "not null"))
        if f.name in rules.get("max_length", {}):
            out.append((f.name, f"max_length {rules['max_length'][f.name]}"))
        if f.name in decimal:
            p, s = decimal[f.name]
            out.append((f.name, f"decimal({p},{s})"))
        elif not isinstance(f.dataType, T.StringType):
            out.append((f.name, f"type {f.dataType.simpleString()}"))
    return out


def _raw(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None)


def _broken(df: DataFrame, field: T.StructField, rule: str) -> Column:
    """Whether the source's value breaks a rule. A missing column counts as null."""
    raw = _raw(df, field.name)
    if rule.startswith("max_length "):
        return F.length(raw.cast("string")) > int(rule.split()[1])
    if rule.startswith("decimal("):
        return raw.isNotNull() & raw.try_cast(rule).isNull()
    if rule.startswith("type "):
        return raw.isNotNull() & raw.try_cast(field.dataType).isNull()
    return raw.isNull()


def _no_problems() -> Column:
    return F.array().cast(KIND)


def problem_list(found: Sequence[tuple[Column, str, str]]) -> Column:
    """The problems of one row, an array of struct<column_name, rule>, from (broken, column,
    rule). Only a row that breaks a rule has a list built."""
    if not found:
        return _no_problems()
    broken = F.lit(False)
    for is_broken, _, _ in found:
        broken = broken | is_broken
    named = [F.when(is_broken, F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"))) for is_broken, c, r in found]
    return F.when(broken, F.array_compact(F.array(*named)).cast(KIND)).otherwise(_no_problems())


def _judged(df: DataFrame, schema: T.StructType, rules: Mapping) -> DataFrame:
    """``df`` as the schema's columns (defaults filled in) and a flag ``_rule_<i>``, never
    null, for each rule of ``row_rules``: whether the row breaks it."""
    fields, defaults = {f.name: f for f in schema.fields}, rules.get("defaults", {})
    columns = []
    for f in schema.fields:
        value = _raw(df, f.name).try_cast(f.dataType)
        if f.name in defaults:
            filled = F.lit(defaults[f.name]).cast(f.dataType)
            value = F.when(_raw(df, f.name).isNull(), filled).otherwise(value)
        columns.append(value.alias(f.name))
    flags = [F.lit(False) if c in defaults and r in ("not null", NULL_KEY) else F.coalesce(_broken(df, fields[c], r), F.lit(False))
             for c, r in row_rules(schema, rules)]
    return df.select(*columns, *[flag.alias(f"_rule_{i}") for i, flag in enumerate(flags)])


def _problems(checks: Sequence[tuple[str, str]]) -> Column:
    return problem_list([(F.col(f"_rule_{i}"), c, r) for i, (c, r) in enumerate(checks)]).alias(PROBLEMS)


def validated(df: DataFrame, schema: T.StructType, rules: Mapping) -> DataFrame:
    """``df`` as the schema's columns (defaults filled in) and ``_problems``, an array of
    struct<column_name, rule> in the order of ``row_rules``.

    A column with a default is never null. A value that does not fit its column's type is
    a problem and becomes null; text stays whole. Extra columns are left out.
    """
    return _judged(df, schema, rules).select(*schema.names, _problems(row_rules(schema, rules)))


@dataclass(frozen=True)
class Staged:
    """A staged table: its rows with ``_problems`` and ``_refused``, and counts per rule."""

    name: str
    rows: DataFrame
    counts: dict[tuple[str, str], int]
    total: int

    @property
    def accepted(self) -> DataFrame:
        return self.rows.where(~F.col(REFUSED)).drop(PROBLEMS, REFUSED)

    @property
    def rejects(self) -> DataFrame:
        return self.rows.where(REFUSED).drop(REFUSED)


def stage(df: DataFrame, name: str, path: str, schema: T.StructType, rules: Mapping) -> Staged:
    """Write ``df`` checked to ``path``, with a column that tells whether a row is refused.

    The one pass over the source: rows, rejects and the counts per rule come from it.
    """
    checks = row_rules(schema, rules)
    seen = Observation()
    watched = _judged(df, schema, rules).observe(seen, F.count(F.lit(1)).alias("rows"),
                                                 *[F.count_if(f"_rule_{i}").alias(f"r{i}") for i in range(len(checks))])
    rows = watched.select(*schema.names, _problems(checks)).withColumn(REFUSED, F.size(PROBLEMS) > 0)
    rows.write.mode("error").option("compression", "zstd").parquet(path)
    got = seen.get
    written = df.sparkSession.read.schema(rows.schema).parquet(path)
    return Staged(name, written, {k: got[f"r{i}"] for i, k in enumerate(checks)}, got["rows"])


def rule_counts(staged: Sequence[Staged]) -> DataFrame:
    """(table_name, column_name, rule, violations) of staged tables: one row per rule."""
    rows = [(s.name, c, r, n) for s in staged for (c, r), n in s.counts.items()]
    return staged[0].rows.sparkSession.createDataFrame(rows, "table_name string, column_name string, rule string, violations bigint")


def _dealt(keys: DataFrame, key: Sequence[str], buckets: int | None) -> DataFrame:
    return keys.repartition(buckets, *key) if buckets else keys


def present_keys(new_keys: DataFrame, target: DataFrame, key: Sequence[str], buckets: int | None = None) -> DataFrame:
    """The keys of ``new_keys`` (distinct, column names ``key``) that ``target`` has.

    The new keys are the build side. A target bucketed by the key, into ``buckets``, is not
    moved or sorted whatever the session's number of shuffle partitions; a key that the
    target repeats is sent on once per task.
    """
    key = list(key)
    return target.select(*key).join(_dealt(new_keys, key, buckets).hint("shuffle_hash"), key, "left_semi").distinct()


def key_problems(rows: DataFrame, key: Sequence[str], target: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """(key, problem) of distinct keys that ``rows`` repeat or that ``target`` (bucketed by
    the key into ``buckets``) already has; a key of both kinds is called repeated."""
    key = list(key)
    counts = _dealt(rows.select(*key), key, buckets).groupBy(*key).agg((F.count(F.lit(1)) > 1).alias("_repeated"))
    out = counts.withColumn("problem", F.when(F.col("_repeated"), F.lit(REPEATED_KEY))).drop("_repeated")
    if target is not None:
        found = present_keys(counts.select(*key), target, key).withColumn("_present", F.lit(PRESENT_KEY))
        out = out.join(found, key, "left").withColumn("problem", F.coalesce("problem", "_present")).drop("_present")
    return out.where(F.col("problem").isNotNull())


def orphan_keys(rows: DataFrame, column: str, parents: Sequence[tuple[DataFrame, str]], buckets: int | None = None) -> DataFrame:
    """Distinct non-null values of ``column`` that no parent (frame, its key; bucketed by it
    into ``buckets``) has."""
    left = rows.where(F.col(column).isNotNull()).select(column).distinct()
    for parent, parent_key in parents:
        found = present_keys(left.withColumnRenamed(column, parent_key), parent, [parent_key], buckets)
        left = left.join(found.withColumnRenamed(parent_key, column), column, "left_anti")
    return left
