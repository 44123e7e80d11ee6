"""Best-fit packing of documents into sequences, in bulk-synchronous rounds.

A round takes all unplaced pieces and all open gaps. Both are range-sorted by size and
swept: a gap takes the largest piece before it that no smaller gap has taken, which is each
piece's successor among the gaps with conflicts resolved by rank. The sweep of a task is
local; what it leaves (gaps that found nothing before them, pieces that found nothing
behind them) is matched across tasks by rank, from two numbers a task. Gaps are updated
and the next round begins; when nothing fits any more, new sequences are opened, as many
as the pieces left need at least. A gap that holds several of the largest pieces
offers that many places in one round, so many small pieces do not need many rounds.

Nothing but counts reaches the driver: two per task of a sweep, a few sums per round.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from saleslens.llm.rows import slices
from saleslens.llm.tokens import encoder
from saleslens.session import materialize

LENGTH = 1024
END = 2
ROWS_A_TASK = 2_000_000
SLICE = 4000  # documents encoded together

PIECE = [T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
         T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())]
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


def _cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; the first takes what is over."""
    over = length % size or size
    return [(0, over), *((s, size) for s in range(over, length, size))] if length > size else [(0, length)]


def _pieces(tokenizer: str, end: int, size: int, keep_ids: bool, id_type: T.DataType):
    """Task-side: the pieces of documents."""
    kind = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = encoder(tokenizer)
        for batch in slices(batches, SLICE):
            ids, at = read.encode(batch.column(1), end)
            raw, rows, sources, parts = memoryview(ids.view(np.uint8)), [], [], []
            for i, (first, last) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                for k, (start, n) in enumerate(_cut(last - first, size)):
                    left = first + start
                    rows.append((k, start, n, zlib.crc32(raw[4 * left:4 * (left + n)])))
                    sources.append(i)
                    if keep_ids:
                        parts.append(ids[left:left + n])
            columns = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(zip(*rows), PIECE)] or [
                pa.array([], to_arrow_type(f.dataType)) for f in PIECE]
            names = ["doc_id", *(f.name for f in PIECE)]
            columns = [batch.column(0).take(pa.array(sources, pa.int64())).cast(kind), *columns]
            if keep_ids:
                names.append("ids")
                columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def pieces(docs: DataFrame, tokenizer: str, size: int = LENGTH, end: int = END, keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) per piece of at most ``size`` tokens."""
    field = docs.schema["doc_id"]
    schema = T.StructType([field, *PIECE, *([IDS] if keep_ids else [])])
    return docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, end, size, keep_ids, field.dataType), schema)


# --- one round --------------------------------------------------------------------------

SWEPT = "task int, kind int, id bigint, size bigint, rank bigint, match bigint"


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task-side: pieces (kind 0) and gaps (kind 1) in ascending order of size, pieces first.

    A gap takes the last waiting piece. Gaps that find none are ranked in the order they
    come; pieces that still wait at the end are ranked from the largest.
    """
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    waiting: list[tuple[int, int]] = []
    late = 0

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
            zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
            ["task", "kind", "id", "size", "rank", "match"])

    for batch in slices(batches, 50_000):
        rows = []
        for kind, number, size in zip(*(batch.column(c).to_pylist() for c in ("kind", "id", "size"))):
            if kind == 0:
                waiting.append((number, size))
            elif waiting:
                piece, length = waiting.pop()
                rows.append((task, 0, piece, length, -1, number))
                rows.append((task, 1, number, size, -1, piece))
            else:
                rows.append((task, 1, number, size, late, -1))
                late += 1
        if rows:
            yield out(rows)
    waiting.reverse()
    for start in range(0, len(waiting), 50_000):
        yield out([(task, 0, n, s, start + i, -1) for i, (n, s) in enumerate(waiting[start:start + 50_000])])


def _across(left: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Matches between tasks, as ranges of ranks: (piece task, first piece rank, gap task,
    first gap rank, count). ``left``: per task in order, its number, late gaps and waiting
    pieces. A gap again takes the last waiting piece, so each task's ranges are few."""
    waiting: list[list[int]] = []  # task, first rank, count
    out = []
    for task, gaps, held in left:
        at = 0
        while at < gaps and waiting:
            source, first, count = waiting[-1]
            n = min(count, gaps - at)
            out.append((source, first, task, at, n))
            at += n
            waiting[-1] = [source, first + n, count - n]
            if count == n:
                waiting.pop()
        if held:
            waiting.append([task, 0, held])
    return out


def _round(pending: DataFrame, gaps: DataFrame, largest: int, rows: int, rows_a_task: int) -> DataFrame:
    """The swept rows of a round with every match filled in: kind, id, size, match (the gap
    of a piece, the piece of a gap; null without one)."""
    spark = pending.sparkSession
    places = F.greatest(F.lit(1), F.expr(f"size div {largest}"))
    offered = (gaps.withColumn("n", places.cast("int")).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
               .select(F.lit(1).alias("kind"), "id", F.when(F.col("i") < F.col("n"), F.lit(largest))
                       .otherwise(F.col("size") - F.lit(largest) * (F.col("n") - 1)).cast("bigint").alias("size")))
    both = pending.select(F.lit(0).alias("kind"), "id", "size").unionByName(offered)
    tasks = max(1, math.ceil(rows / rows_a_task), min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 50_000))
    order = ["size", "kind", "id"]
    swept = materialize(both.repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(_sweep, SWEPT), "swept")
    open_rows = swept.where("match < 0")
    left = open_rows.groupBy("task").agg(F.sum("kind").alias("gaps"), F.sum(1 - F.col("kind")).alias("held")).orderBy("task").collect()
    ranges = _across([tuple(r) for r in left])
    if not ranges:
        return swept.select("kind", "id", "size", F.when(F.col("match") >= 0, F.col("match")).alias("match"))
    # a few ranges per task of the sweep
    ranges = F.broadcast(spark.createDataFrame(ranges, "pt int, p bigint, gt int, g bigint, c bigint"))
    paired = (open_rows.join(ranges, (F.col("kind") == 0) & (F.col("task") == F.col("pt")) & (F.col("rank") >= F.col("p"))
                             & (F.col("rank") < F.col("p") + F.col("c")))
              .select(F.col("gt").alias("task"), (F.col("g") + F.col("rank") - F.col("p")).alias("rank"),
                      F.col("id").alias("piece"), F.col("size").alias("piece_size")))
    late = open_rows.where("kind = 1").select("task", "rank", "id", "size")
    met = materialize(late.join(paired, ["task", "rank"], "left"), "late")
    taken = met.where("piece IS NOT NULL").select(F.lit(0).alias("kind"), F.col("piece").alias("id"),
                                                  F.col("piece_size").alias("size"), F.col("id").alias("match"))
    still = (open_rows.where("kind = 0").join(ranges, (F.col("task") == F.col("pt")) & (F.col("rank") >= F.col("p"))
                                              & (F.col("rank") < F.col("p") + F.col("c")), "left_anti")
             .select("kind", "id", "size", F.lit(None).cast("bigint").alias("match")))
    return (swept.where("match >= 0").select("kind", "id", "size", "match").unionByName(taken).unionByName(still)
            .unionByName(met.select(F.lit(1).alias("kind"), "id", "size", F.col("piece").alias("match"))))


def _sequences(spark: SparkSession, first: int, count: int, size: int) -> DataFrame:
    return spark.range(first, first + count).select("id", F.lit(size).cast("bigint").alias("size"))


def best_fit(sizes: DataFrame, capacity: int = LENGTH, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """(id, sequence_id) of pieces (id, size), each of 1 to ``capacity`` tokens.

    A piece as large as a sequence has one of its own.
    """
    spark = sizes.sparkSession
    sizes = materialize(sizes.select("id", F.col("size").cast("bigint").alias("size")), "sizes")
    # whole sequences are numbered by their ids below zero, the others from zero
    placed = [sizes.where(F.col("size") >= capacity).select("id", (-1 - F.col("id")).alias("sequence_id"))]
    pending = sizes.where(F.col("size") < capacity)
    stats = F.struct(F.count(F.lit(1)).alias("n"), F.sum("size").alias("tokens"), F.max("size").alias("largest"),
                     F.min("size").alias("least"), F.count_if(F.col("size") > capacity / 2).alias("halves"))
    now = pending.select(stats.alias("s")).first().s
    opened, gaps, n_gaps, widest = 0, None, 0, 0
    while now.n:
        if widest < now.least:
            fresh = max(math.ceil(now.tokens / capacity), now.halves)
            new = _sequences(spark, opened, fresh, capacity)
            gaps, n_gaps, opened, widest = new, fresh, opened + fresh, capacity
        offers = n_gaps * max(1, min(widest // now.largest, capacity))
        swept = materialize(_round(pending, gaps, now.largest, now.n + offers, rows_a_task), "round")
        placed.append(swept.where("kind = 0 AND match IS NOT NULL").select("id", F.col("match").alias("sequence_id")))
        pending = swept.where("kind = 0 AND match IS NULL").select("id", "size")
        now = pending.select(stats.alias("s")).first().s
        if not now.n:
            break
        used = (swept.where("kind = 1").select("id", "size")
                .unionByName(swept.where("kind = 0 AND match IS NOT NULL")
                             .select(F.col("match").alias("id"), (-F.col("size")).alias("size"))))
        seen = Observation()
        gaps = materialize(used.groupBy("id").agg(F.sum("size").alias("size")).where(F.col("size") >= now.least)
                           .observe(seen, F.count(F.lit(1)).alias("n"), F.max("size").alias("widest")), "gaps")
        n_gaps, widest = seen.get["n"], seen.get["widest"] or 0
    out = placed[0]
    for part in placed[1:]:
        out = out.unionByName(part)
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = LENGTH, end: int = END, keep_ids: bool = False,
         rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """One row per piece of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, and with ``keep_ids`` its token ids.

    A document is its whole text's ids and the end token, a null or empty text the end
    token alone; rows that repeat an id are documents of their own. Longer documents are cut
    into pieces of ``capacity``, the first of what is over. Within a sequence pieces follow
    each other by length, largest first, without a gap. ``tokenizer`` is a file that every
    worker can read. Other columns are ignored; an empty table gives an empty result.
    """
    cut = materialize(pieces(docs, tokenizer, capacity, end, keep_ids)
                      .withColumn("__id", F.monotonically_increasing_id()), "pieces")
    where = best_fit(cut.select(F.col("__id").alias("id"), F.col("length").alias("size")), capacity, rows_a_task)
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "__id").rowsBetween(Window.unboundedPreceding, -1)
    return (cut.join(where.withColumnRenamed("id", "__id"), "__id")
            .withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
            .drop("__id").select(*cut.drop("__id", "ids").columns, "sequence_id", "offset", *(["ids"] if keep_ids else [])))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of a packing that kept its ids: at most a sequence's tokens a row."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return rows.select("sequence_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))
