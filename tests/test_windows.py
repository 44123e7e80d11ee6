"""Distributed rank / row_number / ntile equal Spark's single-partition windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from saleslens.operators.windows import global_ntile, global_rank, global_row_number, top_n_per_group


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        g = rnd.choice(["a", "b", None])
        v = 7 if rnd.random() < 0.34 else rnd.randint(0, 200)  # one value holds a third
        if rnd.random() < 0.01:
            v = None
        rows.append((i, g, v, rnd.random()))
    return spark.createDataFrame(rows, "id long, g string, v int, x double")


@pytest.mark.parametrize("asc", [True, False])
@pytest.mark.parametrize("parts", [[], ["g"]])
def test_rank_matches_window(skewed, asc, parts):
    o = F.col("v").asc() if asc else F.col("v").desc()
    exp = skewed.withColumn("r0", F.rank().over(Window.partitionBy(*parts).orderBy(o)))
    got = global_rank(skewed, "v", asc, parts, name="r1", rows_a_task=20)
    j = exp.join(got.select("id", "r1"), "id")
    assert got.count() == skewed.count()
    assert j.where(F.col("r0") != F.col("r1")).count() == 0


@pytest.mark.parametrize("asc", [True, False])
@pytest.mark.parametrize("parts", [[], ["g"]])
def test_ntile_and_row_number_match_window(skewed, asc, parts):
    o = F.col("v").asc() if asc else F.col("v").desc()
    w = Window.partitionBy(*parts).orderBy(o, F.col("id"))
    exp = skewed.withColumn("t0", F.ntile(4).over(w)).withColumn("n0", F.row_number().over(w))
    t = global_ntile(skewed, 4, "v", asc, tie_break="id", partition_by=parts, name="t1", rows_a_task=200)
    n = global_row_number(skewed, "v", asc, tie_break="id", partition_by=parts, name="n1", rows_a_task=200)
    j = exp.join(t.select("id", "t1"), "id").join(n.select("id", "n1"), "id")
    assert j.count() == skewed.count()
    assert j.where((F.col("t0") != F.col("t1")) | (F.col("n0") != F.col("n1"))).count() == 0


@pytest.mark.parametrize("n", [1, 3, 5, 6, 7])
def test_ntile_uneven_and_fewer_rows_than_tiles(spark, n):
    df = spark.createDataFrame([(i, float(i % 2)) for i in range(n)], "id long, v double")
    got = {r.id: r.t for r in global_ntile(df, 4, "v", False, tie_break="id", name="t").collect()}
    exp = {r.id: r.t for r in df.withColumn(
        "t", F.ntile(4).over(Window.orderBy(F.desc("v"), "id"))).collect()}
    assert got == exp
    sizes = {}
    for t in got.values():
        sizes[t] = sizes.get(t, 0) + 1
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_rank_on_decimal_and_date(spark):
    df = spark.sql("select id, cast(id % 5 as decimal(12,2)) m, date_add(date'2024-01-01', "
                   "cast(id % 3 as int)) d from range(50)")
    for col in ("m", "d"):
        exp = df.withColumn("r0", F.rank().over(Window.orderBy(F.desc(col))))
        got = global_rank(df, col, False, name="r1", rows_a_task=2)
        assert exp.join(got.select("id", "r1"), "id").where("r0 != r1").count() == 0


def test_top_n_per_group_exact_n(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 5.0), ("a", 3, 5.0), ("a", 4, 1.0),
                                ("b", 5, 2.0)], "g string, id int, v double")
    out = top_n_per_group(df, ["g"], [F.desc("v"), F.asc("id")], 3).collect()
    assert sorted((r.g, r.id, r.position) for r in out) == [
        ("a", 1, 1), ("a", 2, 2), ("a", 3, 3), ("b", 5, 1)]


@pytest.mark.parametrize("asc", [True, False])
@pytest.mark.parametrize("kind,values", [
    ("double", [1.0, float("nan"), 2.0, float("-inf"), None, 0.0, -0.0]),
    ("long", [-(1 << 63), (1 << 63) - 1, (1 << 53) + 1, 1 << 53, 0, None]),
    ("string", ["b", "a", "", None, "é", "B"])])
def test_extreme_keys_rank_and_number_as_windows(spark, asc, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values * 3)], f"id long, v {kind}")
    order = F.col("v").asc() if asc else F.col("v").desc()
    exp = {r.id: (r.r, r.n) for r in df.select(
        "id", F.rank().over(Window.orderBy(order)).alias("r"), F.row_number().over(Window.orderBy(order, "id")).alias("n")).collect()}
    rank = {r.id: r["rank"] for r in global_rank(df, "v", asc, rows_a_task=2).collect()}
    number = {r.id: r.row_number for r in global_row_number(df, "v", asc, tie_break="id", rows_a_task=4).collect()}
    assert {i: (rank[i], number[i]) for i in rank} == exp


def test_hot_value_above_double_precision_is_split(spark):
    hot = (1 << 53) + 1
    df = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, hot).otherwise(hot + F.col("id")).alias("v"))
    order = [F.col("v").asc(), F.col("id").asc()]
    sizes = [r["count"] for r in df.repartitionByRange(10, *order).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 2 * 30_000 / 10
    out = global_row_number(df, "v", True, tie_break="id", rows_a_task=3000)
    assert out.agg(F.countDistinct("row_number"), F.max("row_number")).first() == (30_000, 30_000)


def test_scratch_tables_are_removed(spark, tmp_dir):
    import os

    from saleslens.session import scratch, scratch_path
    root = scratch_path(spark, "").replace("file:", "")
    before = set(os.listdir(root)) if os.path.exists(root) else set()
    with scratch(spark):
        global_rank(spark.range(50).withColumn("v", F.col("id") % 7), "v").write.parquet(f"{tmp_dir}/out")
    assert set(os.listdir(root) if os.path.exists(root) else ()) == before


def test_no_shared_folder_is_an_error_off_local_masters():
    from types import SimpleNamespace

    from saleslens.session import checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)
