"""N-gram Jaccard self-join by vertical partitioning.

The global n-gram order is the order of the n-grams' 64-bit hashes. It is cut into
fragments, and a pair is judged by its overlaps in the fragments:

* Candidates. Two sets that link differ in at most ``d`` n-grams, so of ``d + 1``
  fragments at least one is the same in both. Sets of like size use the same cut (a set
  also takes part in the next smaller size class if a partner can be there), and equal
  fragments meet by their hash. No link is missed, and texts that merely share a common
  passage do not meet, because a fragment holds n-grams from everywhere in a text. A cut
  has ``e`` fragments to spare, so at least ``e + 1`` are the same, and empty ones need
  to meet only for the rare sets that have more than ``e`` of them.
* Counting. Overlaps of a candidate pair are counted per fragment and summed.

Equal sets are one class from the start. Fragments that no other class has, nearly all,
shuffle once, as a hash and a class; a Bloom filter of the others, of bounded size, keeps
them out of the later joins. Groups never expand into all pairs: a block of
equal fragments first links its members to its leader; only members of a leader's blocks
that are then still in different components meet, in tiles of bounded size, and only if a sketch of both (a
few bits per n-gram, whose differences bound the true ones) leaves a link possible. Sets are equal, and n-grams are, when their hashes are (64 bits a gram).

Groups of more than one tile, such as the texts of one template, are cut once more. Their
n-grams get an order of their own, the rarer ones first: those of one member, of at most
the tile's square root, of at most a tile, the rest. Linked sets
share one of their first n-grams in any order: of the smaller set as many as its grams
can exceed the common ones of two sets of its size, of the larger one as many as they
exceed those with its smallest partner. Members meet under such a shared gram only, and a
gram of one member is no row at all, so texts that have more own words than links allow
never meet, however many share the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from saleslens.llm import bloom
from saleslens.llm.components import components
from saleslens.llm.line_dedup import LOWER
from saleslens.llm.rows import BROADCAST_ROWS, bounded, keep_first, slices, text_mark
from saleslens.session import materialize

GRAM_WORDS = 3
SIMILARITY = (90, 100)  # linked when 100 * intersection >= 90 * union
FRAGMENTS = 4  # of the counting step
TILE = 2000

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)  # a 64-bit mixer's factors
_P = [np.uint64((2 * i + 1) * 0x9E3779B97F4A7C15 % (1 << 64)) for i in range(16)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    x = (x ^ (x >> np.uint64(33))) * _M2
    return x ^ (x >> np.uint64(33))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def gram_set(text: str | None, hashes: dict, gram: int) -> np.ndarray:
    """The sorted hashes of a text's distinct word n-grams (a shorter text: one gram)."""
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < gram:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = len(h) - gram + 1
    total = np.zeros(n, np.uint64)
    for i in range(gram):
        total += _mix(h[i:i + n] * _P[i % 16] + np.uint64(i))
    return np.unique(_mix(total))


@dataclass(frozen=True)
class SizeClasses:
    """Size classes and their cuts: a set's partners are in its own or the next class."""

    num: int
    den: int
    bounds: np.ndarray  # largest size of each class
    parts: np.ndarray  # fragments of each class's cut
    spare: np.ndarray


def size_classes(num: int, den: int, largest: int = 1 << 40) -> SizeClasses:
    bounds = [max(1, num // (den - num))]
    while bounds[-1] < largest:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * den // num))
    parts, spare = [], []
    for low, high in zip([1, *(b + 1 for b in bounds)], bounds, strict=False):
        # linked sets, the smaller of this class, differ in at most high * (den - num) / num
        differ, e = high * (den - num) // num, 0
        for _ in range(20):  # spare enough for the empty fragments of nearly all sets
            empty = (differ + 1 + e) * math.exp(-low / (differ + 1 + e))
            more = min(low // 4, math.ceil(empty + 3 * math.sqrt(empty)))
            if more <= e:
                break
            e = more
        parts.append(differ + 1 + e)
        spare.append(e)
    return SizeClasses(num, den, np.array(bounds), np.array(parts), np.array(spare))


def _cut(grams: np.ndarray, parts: int) -> np.ndarray:
    """Ends of ``parts`` equal ranges of the hash order, as places in the sorted grams."""
    high = grams >> np.uint64(32)
    return np.searchsorted(high, (np.arange(parts + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(parts))


def _range_sums(grams: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(grams), dtype=np.uint64)])
    return np.diff(total[ends])


def fragment_names(grams: np.ndarray, classes: SizeClasses) -> np.ndarray:
    """One hash per fragment, under the cuts of the set's own and the next smaller class."""
    own, out = int(np.searchsorted(classes.bounds, len(grams))), []
    meets_smaller = own and classes.num * len(grams) <= classes.den * classes.bounds[own - 1]
    for k in (own, own - 1) if meets_smaller else (own,):
        parts = int(classes.parts[k])
        ends = _cut(grams, parts)
        place = np.arange(parts, dtype=np.uint64) * _P[1] + np.uint64(k * int(_P[2]) % (1 << 64))
        names = _mix(_range_sums(grams, ends) ^ _mix(place))
        empty = ends[1:] == ends[:-1]
        out.append(names if empty.sum() > classes.spare[k] else names[~empty])
    return np.concatenate(out)


def sketch(grams: np.ndarray) -> bytes:
    """The parity of the grams in each of a power of two of cells, by the hash's low bits.

    Two sets differ in at least as many n-grams as their sketches in cells. A sketch folds
    to half its cells by combining its halves.
    """
    cells = 1 << max(6, (6 * len(grams) - 1).bit_length())
    odd = np.zeros(cells, np.uint8)
    place, times = np.unique(grams & np.uint64(cells - 1), return_counts=True)
    odd[place.astype(np.int64)] = times & 1
    return np.packbits(odd).tobytes()


def _fold(cells: bytes, size: int) -> np.ndarray:
    out = np.frombuffer(cells, np.uint8)
    while len(out) > size:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out


def _differ(cells: np.ndarray, own: np.ndarray) -> np.ndarray:
    return np.bitwise_count(cells.view(np.uint64) ^ own.view(np.uint64)).sum(axis=-1)


def _signatures(gram: int, num: int, den: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, hashes = size_classes(num, den), _WordHashes()
        for batch in slices(batches):
            rows = {k: [] for k in ("mark", "n_shingles", "print", "names")}
            for text in batch.column(1).to_pylist():
                grams = gram_set(text, hashes, gram)
                rows["mark"].append(text_mark(text))
                rows["n_shingles"].append(len(grams))
                rows["print"].append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                rows["names"].append(fragment_names(grams, classes).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(id_type), "mark": pa.array(rows["mark"], pa.int64()),
                "n_shingles": pa.array(rows["n_shingles"], pa.int64()),
                "print": pa.array(rows["print"], pa.binary()), "names": pa.array(rows["names"], pa.binary())})

    return run


def _explode(batches: Iterator[pa.RecordBatch], filt=None) -> Iterator[pa.RecordBatch]:
    """(cid, name) per fragment; with a filter only the names that it holds."""
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            lists = [np.frombuffer(x, np.uint64) for x in part.column(1).to_pylist()]
            cid = np.repeat(part.column(0).to_numpy(), [len(x) for x in lists])
            name = np.concatenate(lists)
            if filt is not None:
                held = bloom.holds(filt, bloom.probes(name, len(filt) * 8))
                cid, name = cid[held], name[held]
            yield pa.RecordBatch.from_pydict({"cid": pa.array(cid), "name": pa.array(name.view(np.int64))})


def _filter_of(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filt = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            bloom.add(filt, bloom.probes(batch.column(0).to_numpy().view(np.uint64), bits))
        yield from bloom.shards(filt, np.zeros_like(filt))

    return run


def _sets(gram: int, fragments: int):
    """The sets and sketches of representatives; rows whose set is not the class's go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in slices(batches):
            rows = {k: [] for k in ("cid", "n", "part", "grams", "cells")}
            for cid, want, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                       batch.column(2), strict=True):
                grams = gram_set(text.as_py(), hashes, gram)
                if xxhash.xxh3_128_digest(grams.tobytes()) != want:
                    continue
                ends = _cut(grams, fragments)
                for p in range(fragments):
                    rows["cid"].append(cid)
                    rows["n"].append(len(grams))
                    rows["part"].append(p)
                    rows["grams"].append(grams[ends[p]:ends[p + 1]].tobytes())
                    rows["cells"].append(sketch(grams) if p == 0 else None)
            yield pa.RecordBatch.from_pydict({
                "cid": pa.array(rows["cid"], pa.int64()), "n": pa.array(rows["n"], pa.int64()),
                "part": pa.array(rows["part"], pa.int32()), "grams": pa.array(rows["grams"], pa.binary()),
                "cells": pa.array(rows["cells"], pa.binary())})

    return run


def _room(n: np.ndarray, m: np.ndarray | int, num: int, den: int) -> np.ndarray:
    """How many n-grams linked sets of these sizes can differ in; -1 if they cannot link."""
    fits = num * np.maximum(n, m) <= den * np.minimum(n, m)
    return np.where(fits, (den - num) * (n + m) // (den + num), -1)


def _possible(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m = (c.to_numpy() for c in batch.columns[:4])
            keep = np.zeros(len(a), bool)
            room = _room(n, m, num, den)
            for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                size = min(len(x), len(y))
                keep[i] = _differ(_fold(x, size), _fold(y, size)) <= room[i]
            yield pa.RecordBatch.from_pydict({"a": pa.array(a[keep]), "b": pa.array(b[keep])})

    return run


def _grams_of(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), np.uint64)


def _group_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The grams of members (cid, parts)."""
    for batch in slices(batches):
        keys = [_grams_of(parts.as_py()) for parts in batch.column(1)]
        yield pa.RecordBatch.from_pydict({"g": pa.array(np.concatenate(keys).view(np.int64))})


def first_grams(n: int, num: int, den: int) -> tuple[int, int]:
    """How many first n-grams a set of n must show: as the smaller of a linked pair, as the larger."""
    least_equal = -(-2 * num * n // (num + den))  # common to linked sets of n and at least n
    least_any = -(-num * n // den)
    return n - least_equal + 1, n - least_any + 1


def _first_grams_of(num: int, den: int, filters: list[Broadcast]):
    """(g, cid, component, short) of members (cid, parts, component): their first
    n-grams in the order (number of filters that hold it, hash), without those that the
    first filter, of the grams of several members, does not hold; short: also among those
    of a smaller set. A wrong answer of a filter is the same for all members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filts = [f.value for f in filters]
        for batch in slices(batches):
            keys, sizes, short = [], [], []
            for parts in batch.column(1):
                key = _grams_of(parts.as_py())
                held = [bloom.holds(f, bloom.probes(key, len(f) * 8)) for f in filts]
                smaller, larger = first_grams(len(key), num, den)
                first = np.argsort(np.sum(held, axis=0), kind="stable")[:larger]
                shared = held[0][first]
                keys.append(key[first][shared])
                sizes.append(len(keys[-1]))
                short.append(np.flatnonzero(shared) < smaller)
            cid, component = (np.repeat(c.to_numpy(), sizes) for c in (batch.column(0), batch.column(2)))
            yield pa.RecordBatch.from_pydict({"g": pa.array(np.concatenate(keys).view(np.int64)), "cid": pa.array(cid),
                                              "component": pa.array(component), "short": pa.array(np.concatenate(short))})

    return run


def _tiles(num: int, den: int):
    """Rows come sorted by (g, i, j); within a tile, left rows meet right rows; a row can be both.

    A pair that shares several whole groups is taken in the first of them only; rows of a
    group that was cut have no list of groups.
    """

    def first(own: pa.Scalar, other: pa.Scalar, g: int) -> bool:
        return own.values is None or other.values is None or g == np.intersect1d(
            own.values.to_numpy(), other.values.to_numpy(), assume_unique=True)[0]

    def pairs(rows):
        left = [r for r in rows if r[7]]
        right = [r for r in rows if r[8]]
        if not left or not right:
            return
        size = min(len(r[6]) for r in rows)
        cells = np.stack([_fold(r[6], size) for r in right])
        comps, n = (np.array([r[k] for r in right]) for k in (4, 5))
        for r in left:
            room = _room(n, r[5], num, den)
            room[comps == r[4]] = -1
            at = np.flatnonzero(room >= 0)
            own = _fold(r[6], size)
            at = at[_differ(cells[at], own) <= room[at]]
            for k in at.tolist():
                if first(r[9], right[k][9], r[0]):
                    yield (min(r[3], right[k][3]), max(r[3], right[k][3]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, seen = None, [], set()

        def out(found):
            a, b = zip(*found, strict=True) if found else ((), ())
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[:-1]), batch.column(9), strict=True):
                if row[:3] != key:
                    seen.update(pairs(rows))
                    key, rows = row[:3], []
                    if len(seen) > 50_000:
                        yield out(seen)
                        seen = set()
                rows.append(row)
        seen.update(pairs(rows))
        yield out(seen)

    return run


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                  for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(shared, pa.int64())],
                                         ["a", "b", "n", "m", "shared"])


class _Join:
    def __init__(self, docs: DataFrame, gram: int, similarity: tuple[int, int], tile: int, broadcast_rows: int,
                 max_bits: int):
        self.docs, self.gram, (self.num, self.den) = docs.select("doc_id", "text"), gram, similarity
        self.tile, self.broadcast_rows, self.max_bits = tile, broadcast_rows, max_bits
        id_field = docs.schema["doc_id"]
        self.signed = materialize(self.docs.mapInArrow(
            _signatures(gram, self.num, self.den, to_arrow_type(id_field.dataType)),
            T.StructType([id_field, T.StructField("mark", T.LongType()), T.StructField("n_shingles", T.LongType()),
                          T.StructField("print", T.BinaryType()), T.StructField("names", T.BinaryType())])),
            "signatures")
        prints = materialize(self.signed.where("print is not null").groupBy("print")
                             .agg(F.min("doc_id").alias("first_id")), "prints")
        seed = 0  # the first seed that gives every print a number of its own
        while not prints.groupBy(self.number(seed)).count().where("count > 1").isEmpty():
            seed += 1
        self.seed, self.classes = seed, prints.withColumn("cid", self.number(seed))

    @staticmethod
    def number(seed: int) -> Column:
        return F.xxhash64(F.lit(seed), "print")

    def members(self) -> DataFrame:
        """(leader, cid): classes that share a block of equal fragments with the block's
        least class, its leader; the leader is a member of its own group."""
        named = self.signed.where("print is not null").select(self.number(self.seed).alias("cid"), "names")
        schema = "cid bigint, name bigint"
        leaders = materialize(
            named.mapInArrow(_explode, schema).groupBy("name").agg(F.min("cid").alias("leader"), F.max("cid").alias("last"))
            .where("leader < last").select("name", "leader"), "leaders")
        bits = bloom.bits_for(leaders.count(), self.max_bits)
        filt = self.docs.sparkSession.sparkContext.broadcast(bloom.merged(
            leaders.select("name").mapInArrow(_filter_of(bits), bloom.SHARD_SCHEMA), bits, "once"))
        held = named.mapInArrow(lambda batches: _explode(batches, filt.value), schema)
        return materialize(held.distinct().join(leaders, "name").select("leader", "cid").distinct(), "members")

    def sets(self, members: DataFrame) -> DataFrame:
        """(cid, n, part, grams, cells): the fragments of every class that is in a block."""
        wanted = materialize(self.classes.join(members.select("cid").distinct(), "cid", "left_semi")
                             .select("cid", "print", "first_id"), "candidates")
        rows = self.docs.join(bounded(wanted, self.broadcast_rows), F.col("doc_id").eqNullSafe(F.col("first_id")))
        made = rows.select("cid", "print", "text").mapInArrow(
            _sets(self.gram, FRAGMENTS), "cid bigint, n bigint, part int, grams binary, cells binary")
        # a representative's row can be repeated
        return materialize(made.dropDuplicates(["cid", "part"]), "sets")

    def links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """The pairs (a, b) that link: overlaps counted per fragment, summed per pair."""
        left = sets.select(F.col("cid").alias("a"), F.col("n"), "part", F.col("grams").alias("x"))
        right = sets.select(F.col("cid").alias("b"), F.col("n").alias("m"), "part", F.col("grams").alias("y"))
        counted = (pairs.join(left, "a").join(right, ["b", "part"])
                   .select("a", "b", "n", "m", "x", "y")
                   .mapInArrow(_overlaps, "a bigint, b bigint, n bigint, m bigint, shared bigint"))
        total = counted.groupBy("a", "b", "n", "m").agg(F.sum("shared").alias("shared"))
        return materialize(total.where(self.den * F.col("shared") >= self.num * (F.col("n") + F.col("m") - F.col("shared")))
                           .select(F.col("a").alias("u"), F.col("b").alias("v")), "links")

    def possible(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        cells = sets.where("part = 0")
        left = cells.select(F.col("cid").alias("a"), "n", F.col("cells").alias("x"))
        right = cells.select(F.col("cid").alias("b"), F.col("n").alias("m"), F.col("cells").alias("y"))
        return materialize(pairs.join(left, "a").join(right, "b").select("a", "b", "n", "m", "x", "y")
                           .mapInArrow(_possible(self.num, self.den), "a bigint, b bigint"), "pairs")

    def across(self, members: DataFrame, parts: DataFrame, sets: DataFrame) -> DataFrame:
        """Possible pairs of members that share a group but no component yet."""
        known = members.join(parts, F.col("cid") == F.col("node"), "left").select(
            "leader", "cid", F.coalesce("component", "cid").alias("component"))
        groups = known.groupBy("leader").agg(
            F.count("*").alias("size"), F.min_by("component", "cid").alias("main"),
            F.min("component").alias("low"), F.max("component").alias("high"))
        inside = materialize(known.join(groups.where("low < high").select("leader", "size", "main"), "leader")
                             .withColumn("outside", F.col("component") != F.col("main")), "inside")
        cut = materialize(inside.where(F.col("size") > self.tile).select("leader").distinct(), "cut")
        whole = inside.join(cut, "leader", "left_anti")
        # Members outside the leader's component stand on the left of every tile of their
        # row, all members on the right of every tile of their column.
        roles = whole.select(F.col("leader").alias("g"), "cid", "component", F.col("outside").alias("left"), F.lit(True).alias("right"))
        own = whole.groupBy("cid").agg(F.sort_array(F.collect_list("leader")).alias("leaders"))
        tiled = self.tiled(roles, sets, own)
        if not cut.isEmpty():
            refined = self.cut_roles(inside.join(cut, "leader", "left_semi"), sets)
            tiled = tiled.unionByName(self.tiled(refined, sets, None))
        tiled = tiled.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
        return materialize(tiled.mapInArrow(_tiles(self.num, self.den), "a bigint, b bigint").distinct(), "across")

    def tiled(self, roles: DataFrame, sets: DataFrame, own: DataFrame | None) -> DataFrame:
        """A row per tile that a member (g, cid, component, left, right) stands in."""
        shapes = roles.groupBy("g").agg(*(F.ceil(F.sum(F.col(side).cast("int")) / self.tile).cast("int").alias(name)
                                          for side, name in (("left", "rows"), ("right", "columns")))).where("rows > 0 AND columns > 0")

        def place(name: str) -> Column:
            return F.pmod(F.xxhash64("cid"), F.col(name)).cast("int")

        def tile(i: Column, j: Column, is_left: Column, is_right: Column) -> Column:
            return F.struct(i.alias("i"), j.alias("j"), is_left.alias("left"), is_right.alias("right"))

        right = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda i: tile(
            i, place("columns"), F.col("left") & (i == place("rows")), F.lit(True)))
        left = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda j: tile(
            place("rows"), j, F.lit(True), F.lit(False)))
        # the tile where a member's row and column cross has it once
        rest = F.filter(left, lambda t: t["j"] != place("columns"))
        at = F.explode(F.when(F.col("left") & F.col("right"), F.concat(right, rest)).when(F.col("left"), left).otherwise(right))
        sketches = sets.where("part = 0").select("cid", "n", "cells")
        if own is None:
            sketches = sketches.withColumn("leaders", F.lit(None).cast("array<bigint>"))
        else:
            sketches = sketches.join(own, "cid")
        return (roles.join(shapes, "g").withColumn("at", at).join(sketches, "cid")
                .select("g", "at.i", "at.j", "cid", "component", "n", "cells", "at.left", "at.right", "leaders"))

    def cut_roles(self, inside: DataFrame, sets: DataFrame) -> DataFrame:
        """(g, cid, component, left, right): members of large groups under their first n-grams,
        a member of several such groups once.

        A member outside the component of the gram's main member meets all if the gram is
        among its few first ones, else those of whom it is.
        """
        grams = (sets.join(inside.select("cid").distinct(), "cid", "left_semi").groupBy("cid")
                 .agg(F.transform(F.sort_array(F.collect_list(F.struct("part", "grams"))), lambda x: x["grams"]).alias("parts")))
        members = materialize(inside.select("cid", "component").distinct().join(grams, "cid")
                              .select("cid", "parts", "component"), "large-groups")
        shared = materialize(members.select("cid", "parts").mapInArrow(_group_grams, "g bigint")
                             .groupBy("g").count().where("count > 1"), "shared-grams")
        filters = []
        for bound in (1, math.isqrt(self.tile), self.tile):
            held = shared.where(F.col("count") > bound).select("g")
            bits = bloom.bits_for(held.count(), self.max_bits)
            filters.append(self.docs.sparkSession.sparkContext.broadcast(
                bloom.merged(held.mapInArrow(_filter_of(bits), bloom.SHARD_SCHEMA), bits, "once")))
        first = materialize(members.mapInArrow(
            _first_grams_of(self.num, self.den, filters), "g bigint, cid bigint, component bigint, short boolean"), "first-grams")
        groups = first.groupBy("g").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                        F.max("short").alias("any"), F.min_by("component", "cid").alias("main"))
        met = first.join(groups.where("low < high AND any").select("g", "main"), "g")
        outside = F.col("component") != F.col("main")
        sides = F.array(F.struct(F.col("g"), (outside & F.col("short")).alias("left"), F.lit(True).alias("right")),
                        F.struct(F.xxhash64("g").alias("g"), (outside & ~F.col("short")).alias("left"), F.col("short").alias("right")))
        return materialize(met.select("cid", "component", F.explode(sides).alias("side"))
                           .select("side.g", "cid", "component", "side.left", "side.right").where("left OR right"), "roles")

    def run(self) -> DataFrame:
        members = self.members()
        sets = self.sets(members)
        star = members.where("cid <> leader").select(F.col("leader").alias("a"), F.col("cid").alias("b"))
        links = self.links(self.possible(star, sets), sets)
        across = self.across(members, components(links), sets)
        parts = components(links.unionByName(self.links(across, sets)))
        named = self.classes.select("cid", "print", "first_id").join(
            parts, F.col("cid") == F.col("node"), "left").withColumn("part", F.coalesce("component", "cid"))
        least = named.groupBy("part").agg(F.min("first_id").alias("component_id"))
        classes = materialize(named.join(least, "part").select(
            F.col("print").alias("p"), F.col("cid").alias("class_id"), "component_id", "part"), "class-components")
        return self.signed.join(classes, F.col("print") == F.col("p"), "left").select(
            "doc_id", "mark", "n_shingles", F.when(F.col("p").isNull(), F.col("doc_id"))
            .otherwise(F.col("component_id")).alias("component_id"), "class_id", "part")


def ngram_join(docs: DataFrame, gram: int = GRAM_WORDS, similarity: tuple[int, int] = SIMILARITY,
               tile: int = TILE, broadcast_rows: int = BROADCAST_ROWS,
               max_bits: int = bloom.MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, mark (the text's xxhash64), n_shingles,
    component_id, class_id, part.

    ``class_id`` names the set (equal sets share it), ``component_id`` is the smallest
    doc_id reachable over links, the row's own included, ``part`` the least class so reached. Null, empty and blank texts have
    no shingles, no class and link with nothing. Rows that repeat a doc_id are rows of
    their own; a null doc_id is never a component's name unless all its ids are null.
    Other columns are ignored; an empty table gives an empty result.
    """
    return _Join(docs, gram, similarity, tile, broadcast_rows, max_bits).run()


def keep_representatives(docs: DataFrame, gram: int = GRAM_WORDS,
                         similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each component: the one of the smallest doc_id (null
    last), of several texts under that id the one of the smallest hash, of repeated rows any
    one. Rows without words stay.
    """
    joined = ngram_join(docs, gram, similarity).where(F.col("part").isNotNull())
    names = materialize(joined.groupBy("part", "doc_id", "mark").agg((F.count(F.lit(1)) > 1).alias("repeated")), "names")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("least")
    first = materialize(names.groupBy("part").agg(least), "first")
    same = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("mark") == F.col("least.mark"))
    judged = materialize(names.join(first, "part").select("doc_id", "mark", "repeated", same.alias("same")), "judged")
    return keep_first(docs, judged.where("NOT same"), judged.where("same AND repeated"))
