"""Connected components of a large edge list, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.session import materialize


EDGES_A_TASK = 250_000


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Every node's larger neighbours are linked to the least of its neighbourhood."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(tasks), "least")
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(
        F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Every node's smaller neighbours, and itself, are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = materialize(down.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), "least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable from each node of ``edges`` (u, v).

    Rounds of large and small stars, each written to the shared folder, until every edge
    points to its component's least node; the number of rounds is logarithmic. Minima are
    combined map-side and the joins read written tables, so adaptive execution can split
    a node that has a third of all edges. Self-links and repeated edges are harmless.
    ``edges`` should be a written table: it is counted to size the tasks.
    """
    tasks = 1 + edges.count() // EDGES_A_TASK

    def stored(rows: DataFrame) -> DataFrame:
        return materialize(rows.where("u <> v").distinct().coalesce(tasks), "edges")

    current, before = stored(edges.select("u", "v")), None
    while True:
        current = stored(_small_star(stored(_large_star(current, tasks)), tasks))
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
