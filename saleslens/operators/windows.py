"""Window operators that stay distributed at any data size.

``rank() OVER (ORDER BY x)`` or ``ntile(k) OVER (ORDER BY x)`` without a PARTITION BY
makes Spark move every row into one task. The functions here give the same numbers with
the work spread over many tasks:

* Row numbers and tiles: the rows are range-partitioned by (partition keys, order key,
  tie-break), sorted inside each task and written once with their task's number and their
  place in it. The rows per task (one row per task and partition key) give every task its
  offset; a row's number is offset plus place. Range bounds are composite, so a value
  that a third of all rows share is split by the tie-break.
* Ranks: a value's rank is one more than the rows of smaller values. Rows are counted per
  value (combined map-side, so a heavy value costs one row per task), the distinct values
  are range-partitioned and their counts added up the same way, and the ranks are joined
  back (adaptive execution splits a heavy value, both sides being plain exchanges).

Spark orders the keys itself, so any orderable type works: NaN, BIGINT of any size,
DECIMAL, text, dates. Tasks hold about ``ROWS_A_TASK`` rows whatever the data size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslens.operators.joins import join_null_safe
from saleslens.session import evaluated_once, materialize

ROWS_A_TASK = 4_000_000

_TASK, _AT, _FIRST, _N, _OFF, _TOT = "_wtask", "_wat", "_wfirst", "_wn", "_woff", "_wtot"
_PLACE_BITS = 33  # of monotonically_increasing_id


def _tasks(df: DataFrame, rows: int, rows_a_task: int) -> int:
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, math.ceil(rows / rows_a_task), min(least, rows // 10_000))


def _direction(col: str, ascending: bool) -> Column:
    return F.col(col).asc() if ascending else F.col(col).desc()


def _offsets(cells: DataFrame, parts: list[str]) -> DataFrame:
    """(parts, task) -> rows (or counts) of earlier tasks and of all, from one row per task
    and partition key."""
    whole = Window.partitionBy(*parts)
    before = whole.orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    return cells.withColumn(_OFF, F.coalesce(F.sum(_N).over(before), F.lit(0))).withColumn(
        _TOT, F.sum(_N).over(whole))


def _numbered(df: DataFrame, order_col: str, ascending: bool, tie_break: str | Sequence[str],
              partition_by: Sequence[str], rows_a_task: int) -> DataFrame:
    """Rows with ``_wrn`` (row number) and ``_wtot`` (rows in the partition)."""
    parts = list(partition_by)
    ties = [tie_break] if isinstance(tie_break, str) else list(tie_break)
    order = [*[F.col(c).asc() for c in parts], _direction(order_col, ascending), *[F.col(c).asc() for c in ties]]
    df, rows = evaluated_once(df, "numbered")
    placed = materialize(
        df.repartitionByRange(_tasks(df, rows, rows_a_task), *order).sortWithinPartitions(*order)
        .withColumn(_AT, F.monotonically_increasing_id())
        .withColumn(_TASK, F.shiftright(_AT, _PLACE_BITS).cast("int"))
        .withColumn(_AT, F.col(_AT).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))), "ordered")
    cells = placed.groupBy(*parts, _TASK).agg(F.count(F.lit(1)).alias(_N), F.min(_AT).alias(_FIRST))
    joined = join_null_safe(placed, _offsets(cells, parts).drop(_N), [*parts, _TASK])
    return joined.withColumn("_wrn", F.col(_OFF) + F.col(_AT) - F.col(_FIRST) + 1).drop(_AT, _TASK, _FIRST, _OFF)


def global_row_number(df: DataFrame, order_col: str, ascending: bool = True, *, tie_break: str | Sequence[str],
                      partition_by: Sequence[str] = (), name: str = "row_number",
                      rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """``row_number() OVER (PARTITION BY .. ORDER BY order_col, tie_break)``, distributed."""
    out = _numbered(df, order_col, ascending, tie_break, partition_by, rows_a_task)
    return out.withColumnRenamed("_wrn", name).drop(_TOT)


def global_rank(df: DataFrame, order_col: str, ascending: bool = True, partition_by: Sequence[str] = (),
                name: str = "rank", rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """``rank() OVER (PARTITION BY partition_by ORDER BY order_col)``, distributed."""
    parts = list(partition_by)
    keys = [*parts, order_col]
    values = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_wc")), "values")
    order = [*[F.col(c).asc() for c in parts], _direction(order_col, ascending)]
    placed = materialize(values.repartitionByRange(_tasks(df, values.count(), rows_a_task), *order)
                         .withColumn(_TASK, F.spark_partition_id()), "ordered")
    earlier = (Window.partitionBy(*parts, _TASK).orderBy(_direction(order_col, ascending))
               .rowsBetween(Window.unboundedPreceding, -1))
    local = placed.withColumn("_wbefore", F.coalesce(F.sum("_wc").over(earlier), F.lit(0)))
    cells = placed.groupBy(*parts, _TASK).agg(F.sum("_wc").alias(_N))
    ranked = join_null_safe(local, _offsets(cells, parts).drop(_N, _TOT), [*parts, _TASK])
    ranks = materialize(ranked.select(*keys, (F.col(_OFF) + F.col("_wbefore") + 1).cast("bigint").alias(name)), "ranks")
    return join_null_safe(df, ranks, keys)


def ntile_of(row_number: str, total: str, k: int) -> Column:
    """Tile of a 1-based row number among ``total`` rows: the first ``total mod k`` tiles
    get one extra row (SQL NTILE). Exact integer arithmetic."""
    q = f"({total} div {k})"
    rem = f"({total} % {k})"
    big = f"({rem} * ({q} + 1))"
    return F.expr(
        f"CAST(CASE WHEN {row_number} <= {big} THEN ({row_number} - 1) div ({q} + 1) + 1 "
        f"ELSE {rem} + ({row_number} - {big} - 1) div nullif({q}, 0) + 1 END AS BIGINT)")


def global_ntile(df: DataFrame, k: int, order_col: str, ascending: bool = True, *, tie_break: str | Sequence[str],
                 partition_by: Sequence[str] = (), name: str = "ntile",
                 rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """``ntile(k) OVER (PARTITION BY .. ORDER BY order_col, tie_break)``, distributed."""
    if k < 1:
        raise ValueError("ntile needs k >= 1")
    out = _numbered(df, order_col, ascending, tie_break, partition_by, rows_a_task)
    return out.withColumn(name, ntile_of("_wrn", _TOT, k)).drop("_wrn", _TOT)


def global_ntiles(df: DataFrame, k: int, specs: Sequence[tuple], key: str,
                  rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """Several ``ntile(k) OVER (ORDER BY col, key)`` columns at once; ``key`` is unique.

    ``specs`` = [(order_col, ascending, name), ...]. Each ordering moves only its column
    and the key; the tiles are joined to the rows by key at the end. ``df`` is read once
    per ordering, so pass a written table.
    """
    out = df
    for col, ascending, name in specs:
        tiles = global_ntile(df.select(key, col), k, col, ascending, tie_break=key, name=name, rows_a_task=rows_a_task)
        out = out.join(tiles.select(key, name), key)
    return out


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    name: str = "position") -> DataFrame:
    """First ``n`` rows of each group by ``order`` (ROW_NUMBER <= n).

    Catalyst turns the filter into a WindowGroupLimit on both sides of the shuffle, so
    a huge group sends only its local top ``n`` rows per task.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return (df.withColumn(name, F.row_number().over(w).cast("bigint"))
              .where(F.col(name) <= n))
