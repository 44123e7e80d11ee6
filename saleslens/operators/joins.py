"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.operators.periods import MONTH_COLUMN, YEAR_COLUMN, by_month

BROADCAST_BYTES = 8 << 20


# Nodes whose output may be larger than Spark's estimate of it.
_GROWING = ("Generate", "Expand", "Join", "MapInArrow", "MapInPandas", "FlatMapGroups", "Window")


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it is known to hold at most ``BROADCAST_BYTES``; else as it is.

    The size is known for written tables, ranges and what filters, projections and
    aggregates make of them. A plan that may grow in between (an exploded day list, a join)
    has no known size and is never marked: write it first.
    """
    frame = getattr(df, "_jdf", None)
    if frame is None:  # no JVM to ask
        return df
    plan = frame.queryExecution().optimizedPlan()
    nodes = [line.lstrip(" :+-").split(" ")[0] for line in plan.toString().splitlines()]
    if any(n.startswith(_GROWING) for n in nodes):
        return df
    return F.broadcast(df) if int(str(plan.stats().sizeInBytes())) <= BROADCAST_BYTES else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (GROUP BY semantics for NULL keys)."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def by_calendar(sales: DataFrame, calendar: DataFrame, attrs: Sequence[str],
                date_col: str = "sale_date") -> DataFrame:
    """Sales inner-joined to Calendar attributes on the sale date.

    A Calendar of up to some centuries is broadcast (its plan's size is checked), so the
    fact side is not shuffled. Sales dated outside its span are dropped, as an inner join
    does; ``star_from_tpch`` spans all order dates. Facts in the monthly layout join on
    their partition columns too, so a filter on the Calendar prunes months as it runs.
    """
    keys = [(date_col, "full_date")]
    if date_col == "sale_date" and by_month(sales):
        keys += [(YEAR_COLUMN, "year"), (MONTH_COLUMN, "month")]
    cal = calendar.select(*[F.col(c).alias(f"_cal_{c}") for _, c in keys], *attrs)
    return sales.join(small(cal), [sales[k] == F.col(f"_cal_{c}") for k, c in keys]).drop(*[f"_cal_{c}" for _, c in keys])
