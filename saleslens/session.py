"""Spark session helpers and the shared scratch folder.

The library never creates a session behind the caller's back: every operator takes
DataFrames. ``get_session`` is a convenience for scripts, tests and the bench.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Session settings the analysis plans rely on. Adaptive execution re-plans joins from
# runtime sizes (broadcast only when the measured side is small), coalesces tiny
# shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

SCRATCH = "saleslens"
_scope: contextvars.ContextVar[str] = contextvars.ContextVar("scope", default="")


def get_session(master: str | None = None, app: str = "saleslens",
                shuffle_partitions: int | None = None, extra: dict | None = None,
                driver_memory: str | None = "8g") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session.

    On a cluster ``spark.checkpoint.dir`` names a folder all executors share and is used
    as is; without it this raises, because a machine-local folder would lose files. Only
    with a local master (unit tests, a laptop) is a fresh local folder set instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="saleslens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for tables written to cut lineage."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{SCRATCH}/{name}"


def materialize(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage of a plan that several later steps read: it is computed once, and a
    lost executor costs a re-read of the written files, not a recomputation. The folder
    lives until ``release_scratch`` or the end of the enclosing ``scratch`` context.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{_scope.get()}{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("error")
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_PLAIN = ("Project", "Filter", "Relation", "SubqueryAlias", "Range", "LocalRelation")


def evaluated_once(df: DataFrame, name: str = "table", compression: str | None = None) -> tuple[DataFrame, int]:
    """``df`` for steps that read it several times, and its number of rows.

    A plan of scans, filters and projections is read again; any other is written first
    and counted by that write, so its joins and aggregates run once.
    """
    nodes = [line.lstrip(" :+-").split(" ")[0] for line in _optimized(df).splitlines() if line.strip()]
    if all(n.split("[")[0].startswith(_PLAIN) for n in nodes):
        return df, df.count()
    seen = Observation()
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), name, compression)
    return written, seen.get["n"]


def _optimized(df: DataFrame) -> str:
    """The optimized plan as text; of a client without a JVM, a plan of an unknown node."""
    frame = getattr(df, "_jdf", None)
    return "Unknown" if frame is None else frame.queryExecution().optimizedPlan().toString()


def release_scratch(spark: SparkSession, scope: str = "") -> None:
    """Delete every table ``materialize`` has written in this session, or in one scope.

    Frames that still read them fail afterwards, so call it once their results are stored.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, scope))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


@contextlib.contextmanager
def scratch_scope(name: str):
    """Within it ``materialize`` writes to a folder of its own, for ``release_scratch``."""
    scope = f"{_scope.get()}{name}-{uuid.uuid4().hex}/"
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """``with scratch(spark): query(..).write...`` removes the intermediates at the end."""
    with scratch_scope("run") as scope:
        try:
            yield spark
        finally:
            release_scratch(spark, scope)
