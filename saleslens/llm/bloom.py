"""Bloom filters over 64-bit hashes, built in tasks and merged shard by shard.

A filter has a power of two of bits. Tasks send it as compressed shards, so a merge task
holds one shard and the driver the whole, whose size the caller bounds (``max_bits``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS_PER_KEY = 10
MAX_BITS = 1 << 31  # 256 MB
SHARD_BITS = 1 << 19
PROBES = 4


def bits_for(keys: int, max_bits: int = MAX_BITS) -> int:
    return min(max_bits, max(SHARD_BITS, 1 << int(max(keys, 1) * BITS_PER_KEY - 1).bit_length()))


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return (hashes[:, None] + step[:, None] * np.arange(PROBES, dtype=np.uint64)) & np.uint64(bits - 1)


def holds(filt: np.ndarray, at: np.ndarray) -> np.ndarray:
    got = filt[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)
    return (got & 1).all(axis=1)


def add(filt: np.ndarray, at: np.ndarray) -> None:
    flat = at.ravel()
    np.bitwise_or.at(filt, (flat >> np.uint64(3)).astype(np.int64),
                     np.uint8(1) << (flat & np.uint64(7)).astype(np.uint8))


def shards(once: np.ndarray, twice: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's filters of the hashes it saw, and saw twice."""
    size = SHARD_BITS // 8
    for shard in range(len(once) // size):
        o, t = once[shard * size:(shard + 1) * size], twice[shard * size:(shard + 1) * size]
        if o.any():
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()),
                "once": pa.array([zlib.compress(o.tobytes(), 1)], pa.binary()),
                "twice": pa.array([zlib.compress(t.tobytes(), 1)], pa.binary())})


SHARD_SCHEMA = "shard int, once binary, twice binary"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard; only one shard's two filters are in memory."""
    shard, once, twice = None, None, None

    def out():
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()),
            "once": pa.array([zlib.compress(once.tobytes(), 1)], pa.binary()),
            "twice": pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())})

    for batch in batches:
        for s, o, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            o = np.frombuffer(zlib.decompress(o), np.uint8)
            t = np.frombuffer(zlib.decompress(t), np.uint8)
            if s != shard:
                if shard is not None:
                    yield out()
                shard, once, twice = s, o.copy(), t.copy()
            else:
                twice |= t | (once & o)
                once |= o
    if shard is not None:
        yield out()


def merged(parts: DataFrame, bits: int, which: str) -> np.ndarray:
    """The merged filter (``once`` or ``twice``) of all tasks: ``bits / 8`` bytes.

    (once, twice) of two tasks merge as (o|p, t|u|(o&p)), in any order.
    """
    rows = (parts.repartition(max(1, bits // SHARD_BITS), "shard").sortWithinPartitions("shard")
            .mapInArrow(_merge, SHARD_SCHEMA).select("shard", which))
    filt, size = np.zeros(bits // 8, np.uint8), SHARD_BITS // 8
    for row in rows.toLocalIterator():
        filt[row[0] * size:(row[0] + 1) * size] = np.frombuffer(zlib.decompress(row[1]), np.uint8)
    return filt
