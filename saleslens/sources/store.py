"""Loading the star as one step: validate, then publish (B-06, B-13).

A store is a database of Parquet tables under one folder. Every table is partitioned by the
load that brought its rows and by whether they were refused, and bucketed by its key, so
that checking a new load against all earlier ones moves the new keys only. The staged rows
meet their problems on the way into the table: they move once, to their key's bucket, and
are written once, accepted and refused ones by the same job. A load is written in full
before it counts: its rows become visible when its marker file is written, which names the
load and its counts. Readers take the loads with a marker; a load that failed half-way has
none, is invisible, and is cleared by the next try. Loading the same id again adds nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from saleslens.schemas import SCHEMAS, TABLE_RULES
from saleslens.session import materialize, scratch_path
from saleslens.sources.staging import KIND, NO_PARENT, PRESENT_KEY, PROBLEMS, REPEATED_KEY, Staged, key_problems, orphan_keys, problem_list, stage

# Parents before the facts that refer to them.
TABLES = ("products", "customers", "calendar", "sales")
LOAD, REFUSED = "load_id", "refused"
BUCKETS = 16
BROADCAST_KEYS = 2_000_000  # unknown parents' keys up to here go to the rows, beyond it the rows go to them


class LoadRefused(ValueError):
    """A load broke rules and nothing of it was published; ``problems`` counts them."""

    def __init__(self, problems: dict[str, dict[str, int]]):
        super().__init__(f"nothing published: {problems}")
        self.problems = problems


class StarStore:
    """The star's tables in ``database`` under ``location``, created where missing.

    ``buckets`` is how many buckets a table has: choose it so that a bucket's keys fit a
    task, once, when the store is made.
    """

    def __init__(self, spark: SparkSession, database: str, location: str, buckets: int = BUCKETS):
        self.spark, self.database, self.location = spark, database, location.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.location}'")
        for name, schema in SCHEMAS.items():
            self._fs().mkdirs(self._path(name))
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self._table(name)} ({columns}, {PROBLEMS} {KIND}, {LOAD} STRING, {REFUSED} BOOLEAN) "
                      f"USING parquet OPTIONS (compression 'zstd') PARTITIONED BY ({LOAD}, {REFUSED}) CLUSTERED BY ({', '.join(TABLE_RULES[name]['key'])}) INTO {buckets} BUCKETS "
                      f"LOCATION '{self.location}/{name}'")
            # a store made by an earlier session: its loads are found by their folders
            spark.sql(f"ALTER TABLE {self._table(name)} RECOVER PARTITIONS")

    def _table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.location, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def loads(self) -> list[str]:
        """The published loads: one small file each."""
        found = self._fs().globStatus(self._path("_loads", "*.json"))
        return sorted(s.getPath().getName().removesuffix(".json") for s in found or [])

    def _rows(self, name: str, loads: Sequence[str], refused: bool = False) -> DataFrame:
        of_loads = self.spark.table(self._table(name)).where(F.col(LOAD).isin(list(loads)))
        return of_loads.where(F.col(REFUSED) if refused else ~F.col(REFUSED))

    def read(self, name: str) -> DataFrame:
        """The published rows of a table."""
        return self._rows(name, self.loads()).select(*SCHEMAS[name].names)

    def rejects(self, name: str) -> DataFrame:
        """Rows that published loads refused, with their problems and ``load_id``."""
        return self._rows(name, self.loads(), refused=True).select(*SCHEMAS[name].names, PROBLEMS, LOAD)

    def counts(self, load_id: str) -> dict[str, dict[str, int]]:
        """Per table of a published load: accepted and refused rows."""
        stream = self._fs().open(self._path("_loads", f"{load_id}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _clear(self, load_id: str) -> None:
        """Remove what a failed try of this load has left."""
        for name in TABLES:
            for refused in ("false", "true"):
                self.spark.sql(f"ALTER TABLE {self._table(name)} DROP IF EXISTS PARTITION ({LOAD}='{load_id}', {REFUSED}={refused})")
            self._fs().delete(self._path(name, f"{LOAD}={load_id}"), True)

    def _publish(self, load_id: str, counts: dict) -> None:
        """The commit: written beside and renamed, so a marker is whole or absent."""
        draft, marker = self._path("_loads", f".{load_id}.{uuid.uuid4().hex}"), self._path("_loads", f"{load_id}.json")
        out = self._fs().create(draft, True)
        out.write(json.dumps(counts).encode())
        out.close()
        if not self._fs().rename(draft, marker):
            raise OSError(f"cannot publish load {load_id}")

    def _stage(self, name: str, df: DataFrame) -> Staged:
        path = scratch_path(self.spark, f"stage-{name}-{uuid.uuid4().hex}")
        return stage(df, name, path, SCHEMAS[name], TABLE_RULES[name])

    def _buckets(self, name: str) -> int:
        return int(next(r.data_type for r in self.spark.sql(f"DESCRIBE EXTENDED {self._table(name)}").collect()
                        if r.col_name == "Num Buckets"))

    def _write(self, staged: Staged, load_id: str) -> dict[str, int]:
        """Write the staged rows to their table, those that hold and those refused with
        their problems; how many of each."""
        rules, name, clean = TABLE_RULES[staged.name], staged.name, staged.accepted
        key, bad = rules["key"], []
        rows = clean
        for i, (column, (parent, parent_key)) in enumerate(rules.get("foreign_keys", {}).items()):
            parents = [(self._rows(parent, [*self.loads(), load_id]), parent_key)]
            lost = materialize(orphan_keys(clean, column, parents).withColumn(f"_lost_{i}", F.lit(True)), "orphans")
            # few keys meet the rows where these lie
            rows = rows.join(F.broadcast(lost) if lost.count() <= BROADCAST_KEYS else lost, column, "left")
            bad.append((F.col(f"_lost_{i}").isNotNull(), column, NO_PARENT))
        # Keys with a problem lie in the table's buckets: the rows move once, to these. They are
        # the build side, with a code and not a text, so the rows are not sorted.
        buckets = self._buckets(name)
        bad_keys = key_problems(clean, key, self.read(name), buckets).select(*key, (F.col("problem") == REPEATED_KEY).alias("_repeated"))
        beside = f"bad_keys_{uuid.uuid4().hex}"
        (bad_keys.write.bucketBy(buckets, *key).option("path", scratch_path(self.spark, beside))
         .saveAsTable(self._table(beside), format="parquet"))
        rows = rows.join(self.spark.table(self._table(beside)).hint("shuffle_hash"), key, "left")
        repeated = F.coalesce(F.col("_repeated"), F.lit(False))
        bad = [(repeated, key[0], REPEATED_KEY), (F.col("_repeated").isNotNull() & ~repeated, key[0], PRESENT_KEY), *bad]
        names = SCHEMAS[name].names
        judged = rows.select(*names, problem_list(bad).alias(PROBLEMS)).unionByName(staged.rejects.select(*names, PROBLEMS))
        seen = Observation()
        try:
            (judged.withColumn(LOAD, F.lit(load_id)).withColumn(REFUSED, F.size(PROBLEMS) > 0)
             .observe(seen, F.count_if(~F.col(REFUSED)).alias("accepted"), F.count_if(REFUSED).alias("refused"))
             .write.mode("append").insertInto(self._table(name)))
        finally:
            self.spark.sql(f"DROP TABLE {self._table(beside)}")
        return {k: seen.get[k] for k in ("accepted", "refused")}

    def load(self, tables: Mapping[str, DataFrame], load_id: str, on_problem: str = "error") -> dict[str, dict[str, int]]:
        """Check all ``tables``, then publish them together; accepted and refused rows of each.

        ``on_problem``: "error" publishes nothing and raises ``LoadRefused`` if any row of
        any table breaks a rule; "reject" publishes the other rows and keeps the refused
        ones, complete and with their problems, among the rejects. A row that breaks a rule
        of its own is not compared with others. Sales refer to parents of this load that
        were accepted or of earlier ones. A published ``load_id`` is not loaded again.
        """
        if on_problem not in ("error", "reject"):
            raise ValueError("on_problem must be 'error' or 'reject'")
        if not re.fullmatch(r"[\w-]+", load_id):
            raise ValueError("load_id must be of letters, digits, _ and -")
        if load_id in self.loads():
            return self.counts(load_id)
        self._clear(load_id)
        counts = {n: self._write(self._stage(n, tables[n]), load_id) for n in TABLES if n in tables}
        broken = [n for n in counts if counts[n]["refused"]]
        if on_problem == "error" and broken:
            problems = {n: {f"{r.column_name}: {r.rule}": r["count"] for r in self._rows(n, [load_id], refused=True)
                            .select(F.inline(PROBLEMS)).groupBy("column_name", "rule").count().collect()} for n in broken}
            self._clear(load_id)
            raise LoadRefused(problems)
        self._publish(load_id, counts)
        return counts
