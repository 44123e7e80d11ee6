"""Dropping rows of a documents table by id and text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller pieces: fewer texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_mark(text: str | None) -> int:
    """What ``xxhash64`` of a text column gives."""
    if text is None:
        return 42
    mark = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return mark - (1 << 64) if mark >> 63 else mark


def bounded(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` (written, narrow) marked for broadcast if there are at most ``most``."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the rows named in ``dropped`` (doc_id, mark); mark: xxhash64 of the text.

    Few dropped rows are broadcast, more are joined by shuffle. All columns stay as they were.
    """
    gone = dropped.select(F.col("doc_id").alias("__gone_id"), F.col("mark").alias("__gone_mark")).distinct()
    return docs.join(bounded(gone), F.col("doc_id").eqNullSafe(F.col("__gone_id"))
                     & (F.xxhash64("text") == F.col("__gone_mark")), "left_anti")


def keep_first(docs: DataFrame, gone: DataFrame, once: DataFrame) -> DataFrame:
    """``docs`` without the rows named in ``gone`` and with one row for each name in ``once``.

    A name is (doc_id, mark); rows of one name have the same id and text, any one of them
    is kept whole. All columns stay as they were.
    """
    rest = drop_rows(docs, gone.select("doc_id", "mark").unionByName(once.select("doc_id", "mark")))
    names = once.select(F.col("doc_id").alias("__once_id"), F.col("mark").alias("__once_mark")).distinct()
    named = docs.withColumn("__mark", F.xxhash64("text"))
    repeated = named.join(bounded(names), F.col("doc_id").eqNullSafe(F.col("__once_id")) & (F.col("__mark") == F.col("__once_mark")), "left_semi")
    return rest.unionByName(repeated.dropDuplicates(["doc_id", "__mark"]).drop("__mark"))
