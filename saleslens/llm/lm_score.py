"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions. Each decision node has a tree of contexts, the last 0 to
``DEPTH`` bytes; every context has a Krichevsky-Trofimov estimate, and a context's weighted
estimate mixes its own with those of its longer contexts, half and half. The training
counts give each context its posterior share of that mixture, and the mixed estimates
along a byte's path its code length.

Counts grow with the corpus and are never in one place. Texts are stored in chunks; a
chunk sends each distinct (context, byte) once, with its training count, to the bucket of
the two nearest context bytes. Deeper contexts live wholly inside a bucket; what crosses
buckets is bounded (65,536 byte pairs). A bucket answers every chunk with one logarithm per
distinct (context, byte). Word counts for the baseline travel the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from saleslens.llm.line_dedup import LOWER
from saleslens.llm.rows import slices
from saleslens.session import materialize

DEPTH = 5
CHUNK_BYTES = 8_000_000
BUCKETS = 128
END = b"\n"  # no word holds it
ALPHA = 0.1  # of the unigram baseline
GRAMS, WORDS = 0, 1
ASKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def serial(words: list[bytes]) -> bytes:
    """A text's canonical bytes, after ``DEPTH`` ends as context: words by one space, one end."""
    return END * DEPTH + b" ".join(words) + END


def gram_keys(text: np.ndarray) -> np.ndarray:
    """(nearest context byte, .., farthest, byte) of every place from ``DEPTH`` on."""
    n = max(len(text) - DEPTH, 0)
    wide = text.astype(np.uint64)
    key = wide[DEPTH - 1:DEPTH - 1 + n].copy()
    for back in [*range(2, DEPTH + 1), 0]:  # the byte itself last
        np.left_shift(key, np.uint64(8), out=key)
        np.bitwise_or(key, wide[DEPTH - back:DEPTH - back + n], out=key)
    return key


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Which places of ``gram_keys`` of joined texts are a text's own, not its lead of ends."""
    keep = np.ones(int(sizes.sum()), bool)
    for back in range(DEPTH):
        keep[starts + back] = False
    return keep[DEPTH:]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word) >> 1  # room for a flag
        return value


def _first_of_runs(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))


def _distinct(keys: np.ndarray) -> np.ndarray:
    ordered = np.sort(keys)
    return ordered[_first_of_runs(ordered)]


def _unique(keys: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (of 63 bits), and how often each is among the counted ones."""
    flagged = np.sort(keys << np.uint64(1) | counted)
    ordered = flagged >> np.uint64(1)
    first = _first_of_runs(ordered)
    if not len(first):
        return ordered, np.empty(0, np.int64)
    return ordered[first], np.add.reduceat((flagged & np.uint64(1)).astype(np.int64), first)


_PIECE = 1 << 16
_PIECE_PLACES = np.arange(_PIECE, dtype=np.uint64)


def _look_up(known: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The value of each gram key (48 bits). Pieces are sorted first, each key with its
    place, so that the search runs along ``known`` instead of jumping about in it."""
    out = np.empty(len(keys))
    for start in range(0, len(keys), _PIECE):
        piece = keys[start:start + _PIECE]
        packed = np.sort(piece << np.uint64(16) | _PIECE_PLACES[:len(piece)])
        ordered = packed >> np.uint64(16)
        first = _first_of_runs(ordered)
        found = values[np.searchsorted(known, ordered[first])]
        out[start + (packed & np.uint64(_PIECE - 1)).astype(np.int64)] = np.repeat(found, np.diff(first, append=len(ordered)))
    return out


def _bucket(keys: np.ndarray, kind: int, buckets: int) -> np.ndarray:
    if kind == GRAMS:  # by the two nearest context bytes
        pair = keys >> np.uint64(8 * (DEPTH - 1))
        keys = (pair * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
    return (keys % np.uint64(buckets)).astype(np.int32)


def _chunks(id_type: pa.DataType, size: int):
    """Joins texts to chunks of about ``size`` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        ids, train, parts, sizes, total = [], [], [], [], 0

        def out():
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([base + number], pa.int64()), "ids": pa.array([ids], pa.list_(id_type)),
                "train": pa.array([train], pa.list_(pa.bool_())), "sizes": pa.array([sizes], pa.list_(pa.int64())),
                "data": pa.array([b"".join(parts)], pa.binary())})

        for batch in slices(batches):
            for doc_id, learns, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = serial((text or "").encode().translate(LOWER).split())
                ids.append(doc_id)
                train.append(learns)
                parts.append(data)
                sizes.append(len(data))
                total += len(data)
                if total >= size:
                    yield out()
                    number += 1
                    ids, train, parts, sizes, total = [], [], [], [], 0
        if ids:
            yield out()

    return run


def _read_chunk(train, sizes, data):
    """(gram keys, their training flags, starts of texts among them; the same of words)."""
    sizes = np.array(sizes, np.int64)
    starts = np.cumsum(sizes) - sizes
    keep = _places(starts, sizes)
    grams = gram_keys(np.frombuffer(data, np.uint8))[keep]
    own = sizes - DEPTH
    hashes, words, lengths = _Hashes(), [], []
    for start, size in zip(starts.tolist(), sizes.tolist(), strict=True):
        text = data[start:start + size].split()
        words.append(np.fromiter(map(hashes.__getitem__, text), np.uint64, len(text)))
        lengths.append(len(text))
    learns = np.array(train, bool)
    return ((grams, np.repeat(learns, own), np.cumsum(own) - own),
            (np.concatenate(words), np.repeat(learns, lengths), np.array(lengths, np.int64)))


def _ask(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, train, sizes, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (grams, learns, _), (words, learn_words, _) = _read_chunk(train, sizes, data)
                for kind, keys, counted in ((GRAMS, grams, learns), (WORDS, words, learn_words)):
                    met, counts = _unique(keys, counted)
                    bucket = _bucket(met, kind, buckets)
                    order = np.argsort(bucket, kind="stable")
                    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
                    rows = [(b, order[ends[b]:ends[b + 1]]) for b in range(buckets) if ends[b] < ends[b + 1]]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([b for b, _ in rows], pa.int32()), pa.array([kind] * len(rows), pa.int32()),
                        pa.array([chunk] * len(rows), pa.int64()),
                        pa.array([met[at].astype("<u8").tobytes() for _, at in rows], pa.binary()),
                        pa.array([counts[at].astype("<u4").tobytes() for _, at in rows], pa.binary())], schema=ASKED)

    return run


def _add_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    joined = np.concatenate(keys)
    order = np.argsort(joined)
    joined = joined[order]
    first = np.flatnonzero(np.r_[True, joined[1:] != joined[:-1]]) if len(joined) else np.empty(0, np.int64)
    return joined[first], np.add.reduceat(np.concatenate(counts)[order], first) if len(first) else np.empty(0, np.int64)


def _model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (bucket, kind); in memory are one bucket's distinct keys, and at
    most as many waiting."""
    at, keys, counts, waiting = None, [], [], 0

    def out():
        k, c = _add_up(keys, counts)
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array([at[0]], pa.int32()), "kind": pa.array([at[1]], pa.int32()),
            "keys": pa.array([k.tobytes()], pa.large_binary()).cast(pa.binary()),
            "counts": pa.array([c.astype("<i8").tobytes()], pa.binary())})

    for batch in batches:
        for bucket, kind, k, c in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4)), strict=True):
            if (bucket, kind) != at:
                if at is not None:
                    yield out()
                at, keys, counts, waiting = (bucket, kind), [], [], 0
            keys.append(np.frombuffer(k, "<u8"))
            counts.append(np.frombuffer(c, "<u4").astype(np.int64))
            waiting += len(keys[-1])
            if waiting > max(2_000_000, len(keys[0])):
                k, c = _add_up(keys, counts)
                keys, counts, waiting = [k], [c], 0
    if at is not None:
        yield out()


_LOG_HALF, _LOG_PI = log(0.5), log(np.pi)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """log Gamma of counts and a half: exact when small, Stirling's series beyond."""
    values, at = np.unique(x, return_inverse=True)
    out = np.empty(len(values))
    small = values < 64
    out[small] = [lgamma(v) for v in values[small].tolist()]
    v = values[~small]
    out[~small] = (v - 0.5) * np.log(v) - v + 0.5 * np.log(2 * np.pi) + 1 / (12 * v) - 1 / (360 * v ** 3)
    return out[at].reshape(np.shape(x))


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - _LOG_PI


class _Level:
    """The nodes of one context length and one bit of the byte."""

    def __init__(self, combined: np.ndarray, counts: np.ndarray, bit: int):
        byte = combined & np.uint64(255)
        node = combined & ~np.uint64(255) | byte >> np.uint64(8 - bit)
        self.first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        self.of = np.cumsum(np.r_[False, node[1:] != node[:-1]])  # node of each element
        one = ((byte >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)
        self.ones = np.add.reduceat(counts * one, self.first)
        self.n = np.add.reduceat(counts, self.first)
        self.kt = (self.ones + 0.5) / (self.n + 1.0)
        self.log_kt = _log_kt(self.n - self.ones, self.ones)
        self.log_weighted, self.own = self.log_kt, np.ones(len(self.first))

    def mix(self, log_longer: np.ndarray) -> None:
        """Half the own estimate, half the product of the longer contexts'."""
        self.log_weighted = np.logaddexp(_LOG_HALF + self.log_kt, _LOG_HALF + log_longer)
        self.own = np.exp(_LOG_HALF + self.log_kt - self.log_weighted)


class Trees:
    """The context trees of a set of (context, byte) keys from ``shortest`` context bytes on."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, shortest: int):
        self.shortest = shortest
        self.sets = {DEPTH: keys}
        total, self.up = {DEPTH: counts}, {}
        for d in range(DEPTH - 1, shortest - 1, -1):
            longer = self.sets[d + 1]
            combined = longer >> np.uint64(16) << np.uint64(8) | longer & np.uint64(255)
            self.sets[d], self.up[d + 1] = np.unique(combined, return_inverse=True)
            total[d] = np.bincount(self.up[d + 1], total[d + 1], len(self.sets[d])).astype(np.int64)
        self.levels = {}
        for d in range(DEPTH, shortest - 1, -1):
            for bit in range(8):
                level = self.levels[d, bit] = _Level(self.sets[d], total[d], bit)
                if d < DEPTH:
                    child = self.levels[d + 1, bit]
                    parent = level.of[self.up[d + 1][child.first]]
                    level.mix(np.bincount(parent, child.log_weighted, len(level.first)))

    def predict(self, bit: int) -> tuple[np.ndarray, np.ndarray]:
        """Per key the mixed estimate of a one at ``bit``, and whether any context was seen."""
        place = np.arange(len(self.sets[DEPTH]))
        value, known = np.full(len(place), 0.5), np.zeros(len(place), bool)
        for d in range(DEPTH, self.shortest - 1, -1):
            level = self.levels[d, bit]
            value, known = _step(level, level.of[place], value, known)
            if d > self.shortest:
                place = self.up[d][place]
        return value, known


def _step(level, node: np.ndarray, value: np.ndarray, known: np.ndarray):
    """One context shorter: its own share of its own estimate; all of it where nothing longer was seen."""
    kt, own, seen = level.kt[node], level.own[node], level.n[node] > 0
    mixed = np.where(known, own * kt + (1 - own) * value, kt)
    return np.where(seen, mixed, value), known | seen


class Roots:
    """The trees' contexts of one and no byte, over all buckets: at most 65,536 byte pairs."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, longer: list[tuple[np.ndarray, np.ndarray]]):
        # pairs: sorted (byte before << 8 | byte); longer[bit]: sorted node keys, summed weights
        self.pairs = pairs
        self.bytes, self.up = np.unique(pairs & np.uint64(255), return_inverse=True)
        alone = np.bincount(self.up, counts, len(self.bytes)).astype(np.int64)
        self.one, self.none = [], []
        for bit in range(8):
            one, none = _Level(pairs, counts, bit), _Level(self.bytes, alone, bit)
            keys, weights = longer[bit]
            node = pairs[one.first] & ~np.uint64(255) | (pairs[one.first] & np.uint64(255)) >> np.uint64(8 - bit)
            found = np.minimum(np.searchsorted(keys, node), max(len(keys) - 1, 0))
            one.mix(np.where(keys[found] == node, weights[found], 0.0))
            none.mix(np.bincount(none.of[self.up[one.first]], one.log_weighted, len(none.first)))
            self.one.append(one)
            self.none.append(none)

    def finish(self, keys: np.ndarray, bit: int, value: np.ndarray, known: np.ndarray) -> np.ndarray:
        pair = keys >> np.uint64(8 * DEPTH) << np.uint64(8) | keys & np.uint64(255)
        place = np.searchsorted(self.pairs, pair)
        value, known = _step(self.one[bit], self.one[bit].of[place], value, known)
        return _step(self.none[bit], self.none[bit].of[self.up[place]], value, known)[0]


def _pair_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per bucket: counts of byte pairs (bit -1), and sums of weighted estimates of the
    contexts of two bytes by their one-byte context, per bit."""
    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keys, counts = np.frombuffer(k, "<u8"), np.frombuffer(c, "<i8")
            trees = Trees(keys, counts, 2)
            pair = keys >> np.uint64(8 * DEPTH) << np.uint64(8) | keys & np.uint64(255)
            parts = [(-1, *_sum_by(pair, counts.astype(float)))]
            for bit in range(8):
                level, two = trees.levels[2, bit], trees.sets[2]
                first = two[level.first]
                node = first >> np.uint64(16) << np.uint64(8) | (first & np.uint64(255)) >> np.uint64(8 - bit)
                parts.append((bit, *_sum_by(node, level.log_weighted)))
            yield pa.RecordBatch.from_pydict({
                "bit": pa.array(np.concatenate([np.full(len(n), b) for b, n, _ in parts]), pa.int64()),
                "node": pa.array(np.concatenate([n for _, n, _ in parts]).astype(np.int64)),
                "value": pa.array(np.concatenate([v for _, _, v in parts]))})


def _sum_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    met, at = np.unique(keys, return_inverse=True)
    return met, np.bincount(at, values, len(met))


def log_probabilities(keys: np.ndarray, counts: np.ndarray, roots: Roots) -> np.ndarray:
    """log10 of the mixed probability of each key's byte after its context."""
    trees, out = Trees(keys, counts, 2), np.zeros(len(keys))
    for bit in range(8):
        one = roots.finish(keys, bit, *trees.predict(bit))
        is_one = (keys >> np.uint64(7 - bit)) & np.uint64(1) == 1
        out += np.log10(np.where(is_one, one, 1 - one))
    return out


def _answer(roots_parts):
    """Rows come sorted by (bucket, kind, chunk); a bucket's model (chunk null) leads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = Roots(*roots_parts.value)
        known, values = None, None
        for batch in batches:
            rows = []
            for bucket, kind, chunk, k, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                keys = np.frombuffer(k, "<u8")
                if chunk is None:
                    counts = np.frombuffer(c, "<i8")
                    known, values = keys, log_probabilities(keys, counts, roots) if kind == GRAMS else counts.astype(float)
                else:
                    rows.append((chunk, kind, bucket, values[np.searchsorted(known, keys)].astype("<f8").tobytes()))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)],
                                             ["chunk", "kind", "bucket", "values"])

    return run


def _scores(id_type: pa.DataType, buckets: int, n_train: int, distinct: int, ends: int):
    """Rows come sorted by (chunk, kind): the texts (kind -1), then the answers."""
    end_known = int(ends > 0)
    floor = n_train + ALPHA * (distinct + 1)

    def score(texts, answers):
        ids, train, sizes, data = texts
        (grams, _, starts), (words, _, lengths) = _read_chunk(train, sizes, data)
        values = []
        for kind, keys in ((GRAMS, grams), (WORDS, words)):
            met = _distinct(keys)
            bucket, got = _bucket(met, kind, buckets), np.zeros(len(met))
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for (k, b), part in answers.items():
                if k == kind:
                    got[order[cut[b]:cut[b + 1]]] = part
            values.append(_look_up(met, got, keys) if kind == GRAMS else got[np.searchsorted(met, keys)])
        doc = np.repeat(np.arange(len(ids)), lengths)
        n = len(ids)
        base = np.bincount(doc, np.log10((values[1] + ALPHA) / floor), n) + np.log10((ends + ALPHA) / floor)
        return pa.RecordBatch.from_pydict({
            "doc_id": pa.array(ids, id_type), "held_out": pa.array([not t for t in train]),
            "n_tokens": pa.array(lengths + 1), "n_known": pa.array(np.bincount(doc, values[1] > 0, n).astype(np.int64) + end_known),
            "train_tokens": pa.array(np.full(n, n_train)), "base_score": pa.array(base),
            "score": pa.array(np.add.reduceat(values[0], starts))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, texts, answers = None, None, {}
        for batch in batches:
            for chunk, kind, bucket, part, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if chunk != at:
                    if at is not None:
                        yield score(texts, answers)
                    at, texts, answers = chunk, None, {}
                if kind < 0:
                    texts = (*rest, part)
                else:
                    answers[kind, bucket] = np.frombuffer(part, "<f8")
        if at is not None:
            yield score(texts, answers)

    return run


def score_texts(docs: DataFrame, train: Column, chunk_bytes: int = CHUNK_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities of the text, of the unigram baseline and the model).

    The model and the baseline learn from the rows where ``train`` is true (null counts as
    false). Null, empty and blank texts are one end. Repeated rows count and get a row each;
    other columns are ignored; an empty table gives an empty result. Words and their counts
    meet by a 64-bit hash. More data need more ``buckets``: a task holds one.
    """
    spark, id_field = docs.sparkSession, docs.schema["doc_id"]
    id_type = to_arrow_type(id_field.dataType)
    chunk_schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(id_field.dataType)),
                                 T.StructField("train", T.ArrayType(T.BooleanType())), T.StructField("sizes", T.ArrayType(T.LongType())),
                                 T.StructField("data", T.BinaryType())])
    chunks = materialize(docs.select("doc_id", F.coalesce(train, F.lit(False)).alias("train"), "text")
                         .mapInArrow(_chunks(id_type, chunk_bytes), chunk_schema), "chunks", "zstd")
    asked = materialize(chunks.select("chunk", "train", "sizes", "data").mapInArrow(
        _ask(buckets), "bucket int, kind int, chunk bigint, keys binary, counts binary"), "asked", "zstd")
    model = materialize(asked.repartition(2 * buckets, "bucket", "kind").sortWithinPartitions("bucket", "kind")
                        .mapInArrow(_model, "bucket int, kind int, keys binary, counts binary"), "model", "zstd")

    rows = (model.where(F.col("kind") == GRAMS).select("keys", "counts").mapInArrow(_pair_rows, "bit bigint, node bigint, value double")
            .groupBy("bit", "node").agg(F.sum("value").alias("value")).orderBy("bit", "node").collect())  # at most 9 * 65,536
    sums = {bit: ([], []) for bit in range(-1, 8)}
    for r in rows:
        sums[r.bit][0].append(r.node)
        sums[r.bit][1].append(r.value)
    parts = {b: (np.array(k, np.uint64), np.array(v, float)) for b, (k, v) in sums.items()}
    roots = spark.sparkContext.broadcast((parts[-1][0], np.rint(parts[-1][1]).astype(np.int64), [parts[b] for b in range(8)]))

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.frombuffer(c, "<i8") for c in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"n": pa.array([int(c.sum()) for c in counts], pa.int64()),
                                              "distinct": pa.array([int((c > 0).sum()) for c in counts], pa.int64())})

    seen = (model.where(F.col("kind") == WORDS).select("counts").mapInArrow(totals, "n bigint, distinct bigint")
            .agg(F.sum("n"), F.sum("distinct")).first())
    ends = chunks.agg(F.sum(F.size(F.filter("train", lambda t: t)))).first()[0] or 0

    lead = model.select("bucket", "kind", F.lit(None).cast("bigint").alias("chunk"), "keys", "counts")
    answers = materialize(
        lead.unionByName(asked.select("bucket", "kind", "chunk", "keys", F.lit(None).cast("binary").alias("counts")))
        .repartition(2 * buckets, "bucket", "kind").sortWithinPartitions("bucket", "kind", F.col("chunk").asc_nulls_first())
        .mapInArrow(_answer(roots), "chunk bigint, kind int, bucket int, values binary"), "answers", "zstd")
    texts = chunks.select("chunk", F.lit(-1).alias("kind"), F.lit(-1).alias("bucket"), F.col("data").alias("values"), "ids", "train", "sizes")
    meets = texts.unionByName(answers, allowMissingColumns=True)
    tasks = max(1, chunks.count() // 2)
    scored = _scores(id_type, buckets, (seen[0] or 0) + ends, (seen[1] or 0) + int(ends > 0), ends)
    return (meets.repartition(tasks, "chunk").sortWithinPartitions("chunk", "kind")
            .select("chunk", "kind", "bucket", "values", "ids", "train", "sizes")
            .mapInArrow(scored, T.StructType([
                id_field, T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
                T.StructField("n_known", T.LongType()), T.StructField("train_tokens", T.LongType()),
                T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])))
