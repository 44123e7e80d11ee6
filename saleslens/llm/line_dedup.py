"""Line deduplication with two Bloom filters.

Pass 1 builds, per task, a filter of the line hashes seen once and one of those seen
twice; (once, twice) pairs of two tasks merge as (o|p, t|u|(o&p)). Pass 2 tests every
line against the merged "twice" filter, which never misses a repeat, and only suspected
repeats shuffle: they are grouped by their whole text, which confirms them exactly and
picks the document whose lines stay. Pass 3 drops the confirmed lines.

The filter has a power of two of bits, about ten per line, at most ``max_bits``: that
bound is what makes it safe to send to every task. Beyond it more lines are suspected
and shuffled; the result stays exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from saleslens.llm import bloom
from saleslens.llm.rows import slices
from saleslens.session import materialize

MIN_CHARS = 20
MIN_DOCS = 3
WS = b" \t\n\x0b\x0c\r"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def line_key(line: bytes) -> bytes:
    """A line's key: white space stripped at both ends, A-Z lower-cased (UTF-8 in and out)."""
    return line.strip(WS).translate(LOWER)


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _keys(text: str | None, least: int) -> list[bytes]:
    """The distinct keys of one document that are long enough."""
    if not text or len(text) < least:
        return []
    lines = text.encode().translate(LOWER).split(b"\n")
    return [k for k in {x.strip(WS) for x in lines} if _long_enough(k, least)]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _build(bits: int, least: int):
    """Task-side: the two filters of a task's documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in slices(batches, 5000):
            keys = [k for text in batch.column(0) for k in _keys(text.as_py(), least)]
            met, counts = np.unique(_hashes(keys), return_counts=True)
            at = bloom.probes(met, bits)
            again = (counts > 1) | bloom.holds(once, at)
            bloom.add(twice, at[again])
            bloom.add(once, at)
        yield from bloom.shards(once, twice)

    return run


def repeat_filter(docs: DataFrame, min_chars: int = MIN_CHARS, max_bits: int = bloom.MAX_BITS) -> np.ndarray:
    """The merged "twice" filter of all documents, at most ``max_bits / 8`` bytes."""
    newlines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    bits = bloom.bits_for(docs.agg(F.sum(newlines + 1)).first()[0] or 1, max_bits)
    shards = docs.select("text").mapInArrow(_build(bits, min_chars), bloom.SHARD_SCHEMA)
    return bloom.merged(shards, bits, "twice")


def _suspects(filt, least: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = filt.value
        bits = len(twice) * 8
        for batch in slices(batches, 5000):
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = _keys(text.as_py(), least)
                ids += [doc_id] * len(own)
                keys += own
            hit = np.flatnonzero(bloom.holds(twice, bloom.probes(_hashes(keys), bits)))
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([ids[i] for i in hit], id_type),
                "key": pa.array([keys[i].decode() for i in hit], pa.string())})

    return run


def _drop(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, total, gone = [], [], []
            for text, keys in zip(batch.column(1), batch.column(2), strict=True):
                lines = (text.as_py() or "").split("\n")
                keys = {k.encode() for k in keys.as_py() or ()}
                stay = [x for x in lines if line_key(x.encode()) not in keys] if keys else lines
                kept.append("\n".join(stay))
                total.append(len(lines))
                gone.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(id_type), "n_lines": pa.array(total, pa.int64()),
                "n_dropped": pa.array(gone, pa.int64()), "kept_text": pa.array(kept, pa.string())})

    return run


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
               max_bits: int = bloom.MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_dropped, kept_text.

    A key of at least ``min_chars`` code points held by at least ``min_docs`` rows loses
    its lines everywhere but in the largest doc_id that holds it (a null doc_id is never
    the largest). Null and empty texts are one empty line. Rows that repeat a doc_id count
    as documents of their own and share what is dropped from that doc_id. Other columns
    are ignored; an empty table gives an empty result.
    """
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    id_field = docs.schema["doc_id"]
    id_type = to_arrow_type(id_field.dataType)
    filt = spark.sparkContext.broadcast(repeat_filter(docs, min_chars, max_bits))
    suspects = materialize(docs.mapInArrow(
        _suspects(filt, min_chars, id_type),
        T.StructType([id_field, T.StructField("key", T.StringType())])), "suspect-lines")
    repeated = materialize(
        suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id"))
        .where(F.col("n") >= min_docs).select("key", "keep_id"), "repeated-lines")
    drops = (suspects.join(repeated, "key")
             .where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
             .groupBy(F.col("doc_id").alias("drop_id")).agg(F.collect_set("key").alias("keys")))
    joined = docs.join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id")), "left")
    return joined.select("doc_id", "text", "keys").mapInArrow(
        _drop(id_type), T.StructType([id_field, T.StructField("n_lines", T.LongType()),
                                      T.StructField("n_dropped", T.LongType()),
                                      T.StructField("kept_text", T.StringType())]))
