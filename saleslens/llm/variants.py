"""Grouping of spelling variants by bidirectional FM-index search schemes.

The vocabulary (words, with their counts) is searched for pairs that differ by one
inserted, deleted or replaced code point. One edit leaves one half of a word as it is, so
two schemes find every partner: the left half exactly, then one edit on the way right,
and the right half exactly, then one edit on the way left. Each walks one direction of a
bidirectional FM-index over the delimited words: an interval of suffix ranks is narrowed
letter by letter, from delimiter to delimiter, for many words at once.

The vocabulary is range-sorted into blocks, once as it is spelled (walks to the right) and
once reversed (walks to the left), and each block is indexed by itself. A word visits the
blocks that hold words beginning with its exact half, mostly just one; a word of half
``h`` cannot have a partner elsewhere. Blocks have a fixed size whatever the vocabulary,
and the visitors of a block are dealt over several tasks if there are many, so neither a
hot beginning nor a hot ending fills a task.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslens.llm.rows import slices
from saleslens.session import materialize

RUN = "[A-Za-zÀ-ÿ]+"
MIN_CHARS = 7
MIN_COUNT = 2
DAMAGE = 31
FACTOR = 10
BLOCK_CHARS = 1_000_000
VISITORS = 200_000
CHUNK = 20_000  # words that walk together
COUNTED = 500_000  # words that a task counts before it passes them on


def _variant(word: str, seed: int) -> str:
    """``word`` without one of its letters where its hash in this document says so."""
    h = zlib.crc32(word.encode(), seed)
    if h % DAMAGE:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _count(pattern: str, least: int):
    """Task-side: counts of the words of documents, each batch of them once."""
    runs = re.compile(pattern)

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text or len(text) < least:
                    continue
                seed = zlib.crc32(f"{doc_id or ''}:".encode())
                # bytes.lower() changes A-Z alone
                for word, n in Counter(runs.findall(text.encode().lower().decode())).items():
                    word = _variant(word, seed)
                    if len(word) >= least:
                        counts[word] += n
            if len(counts) > COUNTED:
                yield out(counts)
                counts.clear()
        yield out(counts)

    return run


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_chars`` code points and ``min_count`` occurrences."""
    # a shorter run cannot give a word: damage only takes letters away
    pattern = RUN[:-1] + "{%d,}" % min_chars
    counts = (docs.select(F.col("doc_id").cast("string"), "text")
              .mapInArrow(_count(pattern, min_chars), "word string, n bigint"))
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- the index ------------------------------------------------------------------------

def suffix_ranks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of ``codes`` and its inverse, by doubling; the text is read as a circle."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    n, width = len(codes), 1
    while True:
        key = rank * (n + 1) + np.roll(rank, -width)
        order = np.argsort(key, kind="stable")
        met = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([0], met[1:] != met[:-1])))
        if new[order[-1]] == n - 1 or width >= n:
            return order, new
        rank, width = new, 2 * width


class OneWay:
    """FM-index of delimited words that extends a match to the right, one code point a step.

    It is built over the reversed text, so the classic backward step appends. All steps are
    on arrays: interval ``i`` is the suffix ranks ``[low[i], high[i])``. ``rank(c, i)``, how
    often symbol c occurs in the first i places of the transform, comes from one sorted
    array of (symbol, place).
    """

    def __init__(self, words: list[str]):
        text = "\0" + "\0".join(words) + "\0"
        codes = np.frombuffer(text[::-1].encode("utf-32-le"), "<u4")
        self.alphabet, codes = np.unique(codes, return_inverse=True)
        codes = codes.astype(np.int64)
        order, _ = suffix_ranks(codes)
        self.n = len(codes)
        self.bwt = codes[order - 1]
        self.places = np.sort(self.bwt * (self.n + 1) + np.arange(self.n))
        self.delimiters = len(words) + 1
        # suffixes that begin with a delimiter come first; a match that ends at a delimiter is
        # the word before it, the last word before the reversed text's first one
        ends = np.flatnonzero(codes == 0)
        number = np.empty(self.n, np.int64)
        number[ends] = len(words) - 1 - np.arange(self.delimiters)
        self.word_at = number[order[:self.delimiters]]

    def symbols(self, text: np.ndarray) -> np.ndarray:
        """The alphabet's numbers of code points that are all in it."""
        return np.searchsorted(self.alphabet, text)

    def start(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The interval of the delimiter, ``count`` times."""
        return np.zeros(count, np.int64), np.full(count, self.delimiters, np.int64)

    def step(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = symbol * (self.n + 1)
        return np.searchsorted(self.places, base + low), np.searchsorted(self.places, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, symbol) for every symbol but the delimiter that extends an interval. A
        narrow interval lists its places, a wide one tries the whole alphabet."""
        size, letters = high - low, len(self.alphabet)
        wide = np.flatnonzero(size > letters)
        narrow = np.flatnonzero(size <= letters)
        at = np.repeat(narrow, size[narrow])
        first = np.cumsum(size[narrow]) - size[narrow]
        place = np.repeat(low[narrow] - first, size[narrow]) + np.arange(len(at))
        pairs = np.unique(at * letters + self.bwt[place])
        tried = (np.repeat(wide, letters) * letters + np.tile(np.arange(letters), len(wide)))
        pairs = np.concatenate((pairs, tried))
        pairs = pairs[pairs % letters != 0]
        return pairs // letters, pairs % letters


def near_words(index: OneWay, queries: list[str], halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query number, word number) of all words of the index that share the first ``halves``
    code points of a query and differ from it by exactly one edit behind them.

    Steps are synchronous: all walks read place ``t`` of their query. A walk is clean until
    it makes its edit; an edited one must go on exactly, up to the end's delimiter.
    """
    size = np.fromiter(map(len, queries), np.int64, len(queries))
    first = np.cumsum(size) - size
    codes = np.frombuffer("".join(queries).encode("utf-32-le"), "<u4")
    letters = np.append(index.symbols(codes), 0)
    known = np.append(index.alphabet[np.minimum(letters[:-1], len(index.alphabet) - 1)] == codes, True)

    def letter(who, at):
        """Symbol of place ``at`` of queries, the delimiter behind the end, -1 if not in the index."""
        place = np.where(at < size[who], first[who] + at, len(codes))
        return np.where(known[place], letters[place], -1)

    clean = np.arange(len(queries))
    low, high = index.start(len(queries))
    # edited walks: who, interval, the next place of the query that they read
    who, elow, ehigh, reads = (np.empty(0, np.int64) for _ in range(4))
    found = []

    def advance(walks, low, high, symbol):
        ok = symbol >= 0
        low, high = index.step(low, high, np.maximum(symbol, 0))
        return ok & (low < high), low, high

    t = 0
    while len(clean) or len(who):
        new = []
        # edits of clean walks before place t: from the half on, or behind the last letter
        may = t >= halves[clean]
        at, symbol = index.branches(low[may], high[may])
        owner, alow, ahigh = clean[may][at], low[may][at], high[may][at]
        blow, bhigh = index.step(alow, ahigh, symbol)
        ok = blow < bhigh
        inside = ok & (t < size[owner]) & (symbol != letter(owner, np.full(len(owner), t)))
        new.append((owner[inside], blow[inside], bhigh[inside], np.full(inside.sum(), t + 1)))  # replaced
        # within a run of one letter an insertion or deletion is made at its end only
        ok &= symbol != letter(owner, np.full(len(owner), t))
        new.append((owner[ok], blow[ok], bhigh[ok], np.full(ok.sum(), t)))  # inserted
        here = np.full(len(clean), t)
        gone = may & (t < size[clean]) & (letter(clean, here) != letter(clean, here + 1))
        new.append((clean[gone], low[gone], high[gone], np.full(gone.sum(), t + 1)))  # deleted
        # edited walks read on: those with the edit above wait for their place
        who, elow, ehigh, reads = (np.concatenate(x) for x in zip((who, elow, ehigh, reads), *new))
        now = reads == t
        ends = now & (reads == size[who])
        ok, nlow, nhigh = advance(who, elow, ehigh, letter(who, reads))
        if (done := ends & ok).any():
            word = index.word_at[nlow[done]]
            # the text's two ends meet in the circle: no word lies between them
            found.append(np.stack((who[done], word))[:, word >= 0])
        stay = ~now | (ok & ~ends)
        moved = now & stay
        elow, ehigh, reads = np.where(moved, nlow, elow), np.where(moved, nhigh, ehigh), reads + moved
        who, elow, ehigh, reads = who[stay], elow[stay], ehigh[stay], reads[stay]
        # clean walks read place t
        ok, low, high = advance(clean, low, high, letter(clean, np.full(len(clean), t)))
        ok &= t < size[clean]
        clean, low, high = clean[ok], low[ok], high[ok]
        t += 1
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)  # several edits may give one word
    return pairs[0], pairs[1]


# --- blocks ----------------------------------------------------------------------------

OUT = "word string, n_near bigint, form_n bigint, form string"
VISIT = "block int, part int, word string, n bigint, own boolean"


def _oriented(word: str, left: bool) -> str:
    return word if left else word[::-1]


def _half(size: int, left: bool) -> int:
    return size // 2 if left else size - size // 2


def _visits(bounds: list[str], parts: list[int], left: bool):
    """Task-side: each word as an entry of its own block, to all of the block's parts, and as
    a visitor, to one part, of each block that can hold words beginning with its half."""
    edges = bounds[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from bisect import bisect_right

        for batch in slices(batches, 20_000):
            rows = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spelled = _oriented(word, left)
                half = spelled[:_half(len(word), left)]
                own = bisect_right(edges, spelled)
                rows += [(own, p, word, n, True) for p in range(parts[own])]
                draw = zlib.crc32(word.encode())
                for block in range(bisect_right(edges, half), bisect_right(edges, half + "\U0010FFFF") + 1):
                    rows.append((block, draw % parts[block], word, n, False))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                columns, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.bool_()))], ["block", "part", "word", "n", "own"])

    return run


def _search(left: bool):
    """Task-side: one part of a block. Its own words are indexed, its visitors searched; the
    walk to the left leaves to the other what shares the left half too."""

    def run(table: pa.Table) -> pa.Table:
        own = table.column("own").to_numpy(zero_copy_only=False)
        words, counts = table.column("word").to_pylist(), table.column("n").to_numpy()
        entries = [w for w, o in zip(words, own) if o]
        visitors = [w for w, o in zip(words, own) if not o]
        entry_n = counts[own]
        if not entries or not visitors:
            return pa.table({"word": pa.array([], pa.string()), "n_near": pa.array([], pa.int64()),
                             "form_n": pa.array([], pa.int64()), "form": pa.array([], pa.string())})
        index = OneWay([_oriented(w, left) for w in entries])
        found: dict[str, list] = {}
        for start in range(0, len(visitors), CHUNK):
            chunk = visitors[start:start + CHUNK]
            halves = np.fromiter((_half(len(w), left) for w in chunk), np.int64, len(chunk))
            for q, e in zip(*(x.tolist() for x in near_words(index, [_oriented(w, left) for w in chunk], halves))):
                word, other = chunk[q], entries[e]
                if not left and word[:len(word) // 2] == other[:len(word) // 2]:
                    continue
                best = found.setdefault(word, [0, 0, ""])
                best[0] += 1
                n = int(entry_n[e])
                if n > best[1] or n == best[1] and other < best[2]:
                    best[1:] = n, other
        rows = list(found.values())
        return pa.table({"word": pa.array(list(found), pa.string()), "n_near": pa.array([r[0] for r in rows], pa.int64()),
                         "form_n": pa.array([r[1] for r in rows], pa.int64()), "form": pa.array([r[2] for r in rows], pa.string())})

    return run


def _one_side(words: DataFrame, left: bool, chars: int, block_chars: int, visitors: int) -> DataFrame:
    key = F.col("word") if left else F.reverse("word")
    blocks = max(1, math.ceil(chars / block_chars))
    if blocks == 1:
        bounds = [""]
    else:
        placed = words.select(key.alias("key")).repartitionByRange(blocks, "key").groupBy(F.spark_partition_id().alias("p"))
        # one row per block reaches the driver
        bounds = sorted(r.least for r in placed.agg(F.min("key").alias("least")).collect()) or [""]
    counted = words.mapInArrow(_visits(bounds, [1] * len(bounds), left), VISIT).where(~F.col("own")).groupBy("block").count()
    parts = [1] * len(bounds)
    if len(bounds) > 1:
        for r in counted.collect():  # one row per block
            parts[r.block] = math.ceil(r["count"] / visitors)
        parts = [max(1, p) for p in parts]
    visits = words.mapInArrow(_visits(bounds, parts, left), VISIT)
    # as many tasks as parts: few bytes a part, but each is a lot of work
    return visits.repartition(sum(parts), "block", "part").groupBy("block", "part").applyInArrow(_search(left), OUT)


def forms(words: DataFrame, factor: int = FACTOR, block_chars: int = BLOCK_CHARS, visitors: int = VISITORS) -> DataFrame:
    """(word, n, n_near, form, form_n) of a vocabulary (word, n) of distinct words.

    ``form`` is the near word of largest n (ties: the smallest in code-point order), if that
    is at least ``factor`` times the word's own; ``n_near`` counts the near words.
    """
    words = materialize(words.select("word", "n"), "vocabulary")
    chars = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    sides = [materialize(_one_side(words, left, chars, block_chars, visitors), "near") for left in (True, False)]
    # UTF-8 bytes sort as code points do: the smallest word of the largest count
    best = F.min(F.struct((-F.col("form_n")).alias("m"), "form"))
    near = sides[0].unionByName(sides[1]).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    strong = -F.col("best.m") >= factor * F.col("n")
    return words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(strong, F.col("best.form")).alias("form"), F.when(strong, -F.col("best.m")).alias("form_n"))


def roots(rows: DataFrame) -> DataFrame:
    """Adds ``root``: the last word on the way from form to form.

    Counts grow by the factor at each form, so a way has few steps and no circle. Words with
    a form point to it; pointers are doubled until none moves.
    """
    links = materialize(rows.where(F.col("form").isNotNull()).select("word", F.col("form").alias("to")), "links")
    while True:
        onward = links.select(F.col("word").alias("via"), F.col("to").alias("next"))
        moved = links.join(onward, links["to"] == onward["via"], "left")
        new = materialize(moved.select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "links")
        links = new.select("word", "to")
        if new.where("moved").isEmpty():
            break
    return rows.join(links, "word", "left").withColumn("root", F.coalesce("to", "word")).drop("to")


def spelling_variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, factor: int = FACTOR,
                      block_chars: int = BLOCK_CHARS, visitors: int = VISITORS) -> DataFrame:
    """One row per word of ``docs``: word, form, root, n, n_near, form_n.

    Words are read from whole texts and damaged by a hash of document and word; null texts
    have none, a null id counts as empty text, rows that repeat count again. Words of any
    length are searched whole. Other columns are ignored; without words the result is empty.
    """
    named = materialize(forms(vocabulary(docs, min_chars, min_count), factor, block_chars, visitors), "forms")
    return roots(named).select("word", "form", "root", "n", "n_near", "form_n")
