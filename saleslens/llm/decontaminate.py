"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` stores a posting list for every word of every document. The index is cut
by documents: a shard holds about ``shard_words`` consecutive words of whole documents
and, per term, the sorted positions inside the shard, so lists of one shard can be
intersected without any further exchange and the longest list is bounded by the shard.

``phrase_matches`` walks the test items in blocks of bounded size. Per block only the
posting lists of its terms leave the index; per shard the lists of each window are
intersected, shifted by their offsets, from the rarest term on. In the same pass
proximity matches are found: an item's rarest terms within a few words of a document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.rows import drop_rows, slices, text_mark
from saleslens.session import materialize

WINDOW = 10
SLOP, NEAR_TERMS = 20, 4  # of a proximity match: words around the rarest term, and terms asked for
SHARD_WORDS = 2_000_000
BLOCK_CHARS = 4_000_000  # test items go out in blocks of at most about this size

# A byte of a word stays, A-Z lower-cased; every other ASCII byte separates words.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else
                   c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

INDEX_SCHEMA = ("shard bigint, term binary, n_places bigint, postings binary, doc_ids array<bigint>, "
                "marks array<bigint>, starts array<bigint>, lengths array<bigint>")
_ARROW_INDEX = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("n_places", pa.int64()), ("postings", pa.binary()),
                          ("doc_ids", pa.list_(pa.int64())), ("marks", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
                          ("lengths", pa.list_(pa.int64()))])


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


def _encode(ids: np.ndarray, places: np.ndarray, n_terms: int) -> pa.Array:
    """One binary value per term: its ascending places as differences, four bytes each."""
    keys = np.sort((ids.astype(np.uint64) << np.uint64(32)) | places.astype(np.uint64))
    term = (keys >> np.uint64(32)).astype(np.int64)
    place = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    step = np.diff(place, prepend=0)
    ends = np.searchsorted(term, np.arange(n_terms + 1))
    firsts = ends[:-1]
    step[firsts] = place[firsts]
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), n_terms,
        [None, pa.py_buffer((ends * 4).astype(np.int64)), pa.py_buffer(step.astype("<u4"))]
    ).cast(pa.binary())


def _places(postings: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(postings, "<u4"), dtype=np.int64)


def _index(shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, serial = TaskContext.get().partitionId() << 32, 0

        def fresh():
            terms: defaultdict = defaultdict()
            terms.default_factory = terms.__len__
            return terms, [], [], [], [], [], 0

        def shard():
            places = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, lengths, strict=True)])
            n = len(terms)
            number = pa.array(np.full(n, base + serial))
            lists = pa.nulls(n, pa.list_(pa.int64()))
            if n:
                own = np.concatenate(ids)
                yield from pa.Table.from_arrays(
                    [number, pa.array(list(terms), pa.binary()), pa.array(np.bincount(own, minlength=n)), _encode(own, places, n), lists, lists, lists, lists],
                    schema=_ARROW_INDEX).to_batches(100_000)
            yield pa.RecordBatch.from_pydict(
                {"shard": [base + serial], "term": [None], "n_places": [None], "postings": [None],
                 "doc_ids": [doc_ids], "marks": [marks], "starts": [starts], "lengths": [lengths]}, _ARROW_INDEX)

        terms, ids, doc_ids, marks, starts, lengths, at = fresh()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = words(text)
                marks.append(text_mark(text))
                ids.append(np.fromiter(map(terms.__getitem__, own), np.int64, len(own)))
                doc_ids.append(doc_id)
                starts.append(at)
                lengths.append(len(own))
                at += len(own) + 1  # a gap, so that no window spans two documents
                if at >= shard_words:
                    yield from shard()
                    serial += 1
                    terms, ids, doc_ids, marks, starts, lengths, at = fresh()
        if doc_ids:
            yield from shard()

    return run


def build_index(docs: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The stored index of ``docs`` (doc_id bigint, text).

    Per shard one row for each term and one, with a null term, that lists its documents.
    """
    return materialize(docs.select(F.col("doc_id").cast("bigint"), "text")
                       .mapInArrow(_index(shard_words), INDEX_SCHEMA), "postings", "zstd")


def _aligned(lists: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Starts of a window, given the offset and places of each of its terms."""
    lists = sorted(lists, key=lambda x: len(x[1]))
    offset, places = lists[0]
    found = places - offset
    for offset, places in lists[1:]:
        if not len(found):
            break
        at = np.searchsorted(places, found + offset)
        at[at == len(places)] = 0
        found = found[places[at] == found + offset]
    return found


def _phrases(item: list[bytes], posts: dict[bytes, np.ndarray], window: int) -> list[tuple[int, int]]:
    """(start, words) of the runs of the shard that windows of this item cover."""
    width = min(window, len(item))
    found = []
    for i in range(len(item) - width + 1):
        own = item[i:i + width]
        if all(w in posts for w in own):
            found.append(_aligned([(k, posts[w]) for k, w in enumerate(own)]))
    if not found:
        return []
    at = np.unique(np.concatenate(found))
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > width) + 1
    first, last = np.r_[0, cut], np.r_[cut, len(at)] - 1
    return list(zip(at[first].tolist(), (at[last] + width - at[first]).tolist(), strict=True))


def _rarest(item: list[bytes], counts: dict[bytes, int], n_terms: int) -> list[bytes]:
    """The item's rarest distinct terms in the whole index, the rarest first."""
    return sorted(set(item), key=lambda w: (counts.get(w, 0), w))[:n_terms]


def _near(terms: list[bytes], posts: dict[bytes, np.ndarray], starts: np.ndarray, ends: np.ndarray,
          slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, words) around each place of the first term that has all others within
    ``slop`` words of it in its own document."""
    if any(w not in posts for w in terms):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    anchor = posts[terms[0]]
    own = np.searchsorted(starts, anchor, "right") - 1
    first, last = np.maximum(starts[own], anchor - slop), np.minimum(ends[own] - 1, anchor + slop)
    low, high = anchor, anchor
    for w in terms[1:]:
        places = posts[w]
        at = np.searchsorted(places, anchor)
        before, after = places[np.maximum(at - 1, 0)], places[np.minimum(at, len(places) - 1)]
        has_before, has_after = (at > 0) & (before >= first), (at < len(places)) & (after <= last)
        place = np.where(has_before & (~has_after | (anchor - before <= after - anchor)), before, after)
        low, high = np.minimum(low, place), np.maximum(high, place)
        ok = has_before | has_after
        anchor, first, last, low, high = (x[ok] for x in (anchor, first, last, low, high))
    return low, high - low + 1


def _finder(window: int | None, slop: int | None, each_place: bool):
    """What finds an item in a shard: (start, words, near) of phrases and of proximity
    matches, either left out if its parameter is None. Without ``each_place`` a document
    has one proximity match with an item."""

    def find(item, rarest, posts, starts, ends):
        if window is not None:
            yield from ((at, n, False) for at, n in _phrases(item, posts, window))
        if slop is not None:
            low, n = _near(rarest, posts, starts, ends, slop)
            if not each_place:
                one = np.unique(np.searchsorted(starts, low, "right"), return_index=True)[1]
                low, n = low[one], n[one]
            yield from ((at, k, True) for at, k in zip(low.tolist(), n.tolist(), strict=True))

    return find


def _search(block, find):
    """Rows come sorted by shard, the row that lists its documents first."""

    def matches(shard, docs, posts):
        starts, lengths = np.array(docs[2], np.int64), np.array(docs[3], np.int64)
        ends = starts + lengths
        out: list[tuple] = []
        for item_id, item, rarest in block.value:
            for start, n, near in find(item, rarest, posts, starts, ends):
                at = int(np.searchsorted(starts, start, "right")) - 1
                if start + n <= ends[at]:
                    out.append((shard, at, docs[0][at], item_id, start - int(starts[at]), n, near))
        names = ("shard", "ordinal", "doc_id", "item_id", "start", "n_words", "near")
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
        columns = list(zip(*out, strict=True)) if out else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, docs, posts = None, None, {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != shard:
                    if shard is not None:
                        yield matches(shard, docs, posts)
                    shard, docs, posts = row[0], None, {}
                if row[1] is None:
                    docs = row[3:]
                else:
                    posts[row[1]] = _places(row[2])
        if shard is not None:
            yield matches(shard, docs, posts)

    return run


MATCH_SCHEMA = "shard bigint, ordinal bigint, doc_id bigint, item_id string, start bigint, n_words bigint, near boolean"


def _blocks(items: DataFrame, block_chars: int):
    """The items as (item_id, words) lists of bounded size, one at a time on the driver."""
    block, size = [], 0
    for row in items.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        own = words(row[1])
        if not own:
            continue
        block.append((row[0], own))
        size += len(row[1])
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def _run_blocks(index: DataFrame, items: DataFrame, find, n_terms: int, block_chars: int) -> DataFrame:
    spark, found = index.sparkSession, None
    for block in _blocks(items, block_chars):
        terms = spark.createDataFrame([(bytearray(w),) for w in {w for _, x in block for w in x}], "term binary")
        # the terms of one block: at most block_chars characters and one item more
        held = index.where("term is not null").join(F.broadcast(terms), "term", "left_semi")
        counts = {} if not n_terms else {
            bytes(r.term): r.n for r in held.groupBy("term").agg(F.sum("n_places").alias("n")).collect()}
        block = [(item_id, item, _rarest(item, counts, n_terms)) for item_id, item in block]
        needed = held.select(*index.columns).unionByName(index.where("term is null")).drop("n_places")
        rows = needed.repartition("shard").sortWithinPartitions("shard", F.col("term").asc_nulls_first())
        got = materialize(rows.mapInArrow(_search(spark.sparkContext.broadcast(block), find), MATCH_SCHEMA), "matches")
        found = got if found is None else found.unionByName(got)
    return spark.createDataFrame([], MATCH_SCHEMA) if found is None else found


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW,
                   block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Exact matches: (shard, ordinal, doc_id, item_id, start, n_words), starts counted in
    words of the document. A run joins overlapping windows of one item."""
    return _run_blocks(index, items, _finder(window, None, True), 0, block_chars).drop("near")


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = SLOP, n_terms: int = NEAR_TERMS,
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Places where the others of an item's ``n_terms`` terms that are rarest in the whole
    index stand within ``slop`` words of the rarest, in one document and any order; columns
    as those of ``phrase_matches``. Ties between terms go by their bytes."""
    return _run_blocks(index, items, _finder(None, slop, True), n_terms, block_chars).drop("near")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  shard_words: int = SHARD_WORDS, block_chars: int = BLOCK_CHARS,
                  slop: int | None = None, n_terms: int = NEAR_TERMS) -> DataFrame:
    """One row per row of ``docs``: doc_id, mark (the text's xxhash64), n_words, n_hit,
    item_ids (sorted strings), and, with a ``slop``, near_ids: the items of which the
    document holds a proximity match.

    ``n_hit`` counts the words inside any occurrence of a window of ``window`` words of an
    item (the whole item if it is shorter). Null and empty texts have no words; items
    without words match nothing; repeated items count once; an item with a null id counts
    for ``n_hit`` but is never listed. Repeated doc_ids keep a row each. Other columns are
    ignored; empty tables give an empty result or no hits. doc_id must be an integer or a
    text of one, else the cast to bigint fails.
    """
    index = build_index(docs, shard_words)
    found = _run_blocks(index, items, _finder(window, slop, False), 0 if slop is None else n_terms, block_chars)
    by_doc = (found.groupBy("shard", "ordinal")
              .agg(F.array_sort(F.collect_set(F.when(~F.col("near"), F.struct(
                  "start", (F.col("start") + F.col("n_words")).alias("end"))))).alias("runs"),
                   F.array_sort(F.collect_set(F.when(~F.col("near"), F.col("item_id")))).alias("item_ids"),
                   F.array_sort(F.collect_set(F.when(F.col("near"), F.col("item_id")))).alias("near_ids")))
    union = F.aggregate(
        "runs", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, run: F.struct(
            (acc.n + F.greatest(F.lit(0), run.end - F.greatest(acc.at, run.start))).alias("n"),
            F.greatest(acc.at, run.end).alias("at")), lambda acc: acc.n)
    directory = (index.where("term is null")
                 .select("shard", F.posexplode(F.arrays_zip("doc_ids", "marks", "lengths")).alias("ordinal", "doc"))
                 .select("shard", F.col("ordinal").cast("bigint"), "doc.doc_ids", "doc.marks", "doc.lengths"))
    listed = ["item_ids"] if slop is None else ["item_ids", "near_ids"]
    return (directory.join(by_doc.withColumn("n_hit", union), ["shard", "ordinal"], "left")
            .select(F.col("doc_ids").alias("doc_id"), F.col("marks").alias("mark"), F.col("lengths").alias("n_words"),
                    F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
                    *(F.coalesce(x, F.array().cast("array<string>")).alias(x) for x in listed)))


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any window of an item, all columns as they were."""
    gone = materialize(decontaminate(docs, items, window).where("n_hit > 0").select("doc_id", "mark"), "dropped")
    return drop_rows(docs, gone)
