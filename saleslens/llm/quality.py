"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. Only the
counts of vote patterns leave the tasks (at most 3 ** labellers rows); expectation-
maximisation over them estimates each labeller's accuracy and the posterior of each
pattern. The posteriors then label a bounded, hashed sample of documents, on which a
linear scorer over hashed word shapes is trained; the scorer judges every document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from saleslens.llm.rows import drop_rows, slices, text_mark
from saleslens.session import materialize

DIMS = 1 << 14
TRAIN_DOCS = 8000
THRESHOLD = 0.5
SHRINK = 8  # features of a short text pull less
PIECE = 64  # kinds a shape; a longer word has several
LONG = 127  # in place of the length of such a word
ABSTAIN, BAD, GOOD = 0, 1, 2

# Votes by a measure of the text: (name, bad when outside this range, good when inside
# this one, fewest words for a vote). Between the ranges a labeller abstains.
LABELLERS = (
    ("symbol_runs", (0.0, 0.05), (0.0, 0.005), 1),
    ("letters", (0.85, 1.0), (0.93, 1.0), 20),
    ("capitals", (0.0, 0.4), (0.0, 0.1), 10),
    ("exclamations", (0.0, 0.3), (0.0, 0.05), 1),
    ("wordless", (0.0, 0.15), (0.0, 0.05), 10),
    ("echoes", (0.0, 0.3), (0.0, 0.1), 10),
    ("distinct", (0.25, 1.0), (0.45, 1.0), 20),
    ("repeated_trigrams", (0.0, 0.5), (0.0, 0.2), 20),
    ("short_words", (0.05, 0.48), (0.15, 0.45), 20),
)


class _Kinds(dict):
    """Character -> kind, for str.translate."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = kind = "A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c
        return kind


_KINDS = _Kinds()
_RUN = re.compile(r"(.)\1+", re.S)
_SYMBOL_RUN = re.compile(r"[^aA9]\+")
_SYMBOL_RUN_OF_KINDS = re.compile(r"([^aA9])\1\1|[^aA9+]\+")  # the same before kinds are shortened


def shape(kinds: str) -> str:
    """The shape of a word's kinds: runs shortened to one, of three and more marked +."""
    return _RUN.sub(lambda m: m[1] + "+" if len(m[0]) > 2 else m[1], kinds)


def _place(form: str) -> int:
    return zlib.crc32(form.encode()) & (DIMS - 1)


def _flags(kinds: str, symbol_run: bool, lower: int, upper: int) -> int:
    return (symbol_run | (not lower and upper > 1) << 1 | ("!" in kinds) << 2
            | (not lower + upper and "9" not in kinds) << 3)


def long_word(word: str) -> tuple[list[int], int, int]:
    """Shapes' hashes of the pieces, flags and letters of a whole word of any length."""
    kinds = word.translate(_KINDS)
    lower, upper = kinds.count("a"), kinds.count("A")
    places = [_place(shape(kinds[i:i + PIECE])) for i in range(0, len(kinds), PIECE)]
    return places, _flags(kinds, bool(_SYMBOL_RUN_OF_KINDS.search(kinds)), lower, upper), lower + upper


class _Forms(dict):
    """kinds -> shape's hash (14 bits) << 18 | flags (4) << 14 | letters << 7 | length."""

    def __missing__(self, kinds: str) -> int:
        if len(self) > 100_000:
            self.clear()
        form = shape(kinds)
        lower, upper = kinds.count("a"), kinds.count("A")
        flags = _flags(kinds, bool(_SYMBOL_RUN.search(form)), lower, upper)
        value = self[kinds] = _place(form) << 18 | flags << 14 | lower + upper << 7 | len(kinds)
        return value


class _Words(dict):
    """word -> hash (32 bits) << 31 | what ``_Forms`` has of its kinds (letters a/A, digits 9,
    other characters as they are), or ``LONG`` for words of more than ``PIECE`` characters."""

    def __init__(self):
        super().__init__()
        self.forms = _Forms()

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        if len(word) > PIECE:  # not kept: such words are many and long
            return zlib.crc32(word.encode()) << 31 | LONG
        value = self[word] = zlib.crc32(word.encode()) << 31 | self.forms[word.translate(_KINDS)]
        return value


@dataclass
class Reading:
    """What labellers and scorer read off a text."""

    n: int
    word: np.ndarray
    shape: np.ndarray  # of every word, or of every piece of a long one
    seen: np.ndarray  # trigrams that came before in the text
    echo: np.ndarray
    measures: list[float]


def read(text: str | None, cache: dict) -> Reading:
    words = text.split() if text else []
    n = len(words)
    code = np.fromiter(map(cache.__getitem__, words), np.int64, n)
    word = code >> 31
    shapes, flags, letters, lengths = (code >> 18) & (DIMS - 1), (code >> 14) & 15, (code >> 7) & 127, code & 127
    pieces, after = [], []
    for i in np.flatnonzero(lengths == LONG).tolist():
        (shapes[i], *rest), flags[i], letters[i] = long_word(words[i])
        lengths[i] = len(words[i])
        pieces += rest
        after += [i + 1] * len(rest)
    if pieces:
        shapes = np.insert(shapes, after, pieces)
    echo = word[1:] == word[:-1]
    tri = (word[:-2] * 1_000_003 + word[1:-1]) * 1_000_003 + word[2:] if n > 2 else word[:0]
    _, first = np.unique(tri, return_index=True)
    seen = np.ones(len(tri), bool)
    seen[first] = False
    d = max(n, 1)
    measures = [
        (flags & 1).sum() / d, letters.sum() / max(lengths.sum(), 1), ((flags >> 1) & 1).sum() / d,
        ((flags >> 2) & 1).sum() / d, ((flags >> 3) & 1).sum() / d, echo.sum() / d,
        len(np.unique(word)) / d, seen.sum() / max(len(tri), 1), (lengths <= 3).sum() / d]
    return Reading(n, word, shapes, seen, echo, measures)


def votes(reading: Reading) -> list[int]:
    out = []
    for value, (_, (low, high), (least, most), words) in zip(reading.measures, LABELLERS, strict=True):
        if reading.n < words:
            out.append(ABSTAIN)
        else:
            out.append(GOOD if least <= value <= most else ABSTAIN if low <= value <= high else BAD)
    return out


def _pattern(vote: list[int]) -> int:
    return sum(v * 3 ** i for i, v in enumerate(vote))


def features(reading: Reading) -> np.ndarray:
    """Hashed places of shapes, pairs of shapes, echoes and repeated trigrams."""
    s = reading.shape
    pairs = ((s[:-1] * 31 + s[1:]) * 2_654_435_761 >> 7) & (DIMS - 1)
    return np.concatenate([s, pairs, np.full(int(reading.echo.sum()), 1), np.full(int(reading.seen.sum()), 2)])


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns: the posterior of "good" per pattern, and P(good vote | class,
    the labeller votes), classes bad and good.

    ``patterns`` is (patterns, labellers) of votes. Abstaining says nothing (short texts
    abstain more, good or bad). Starts from the share of good votes.
    """
    cast, yes = (patterns != ABSTAIN).astype(float), (patterns == GOOD).astype(float)
    good = (yes.sum(1) + 0.5) / (cast.sum(1) + 1)
    for _ in range(rounds):
        weight = np.stack([(1 - good) * counts, good * counts])
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        # smoothed: no vote ever counts as impossible
        given = (weight @ yes + 0.5) / (weight @ cast + 1)
        logs = np.log(prior)[:, None] + np.log(given) @ yes.T + np.log(1 - given) @ (cast - yes).T
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return good, given


def sparse_features(reading: Reading) -> tuple[np.ndarray, np.ndarray]:
    """The distinct places of a text's features and their shrunk mean."""
    places = features(reading)
    met, times = np.unique(places, return_counts=True)
    return met.astype("<i4"), (times * (10 / (len(places) + SHRINK))).astype("<f4")


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 300, rate: float = 2.0,
          ridge: float = 1e-5) -> np.ndarray:
    """Weights of a logistic scorer (bias last) on ``sparse_features``, by Adagrad."""
    row = np.repeat(np.arange(len(rows)), [len(p) for p, _ in rows])
    place = np.concatenate([np.empty(0, np.int32), *[p for p, _ in rows]])
    value = np.concatenate([np.empty(0, np.float32), *[v for _, v in rows]])
    w, squares = np.zeros(DIMS + 1), np.full(DIMS + 1, 1e-8)
    for _ in range(rounds):
        margin = np.bincount(row, value * w[place], len(rows)) + w[DIMS]
        error = 1 / (1 + np.exp(-margin)) - target
        slope = np.bincount(place, value * error[row], DIMS) / len(rows) + ridge * w[:DIMS]
        slope = np.append(slope, error.mean())
        squares += slope ** 2
        w -= rate * slope / np.sqrt(squares) * 0.1
    return w


def _vote_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _Words()
    for batch in slices(batches):
        codes = [_pattern(votes(read(x.as_py(), cache))) for x in batch.column(0)]
        code, n = np.unique(np.array(codes, np.int64), return_counts=True)
        yield pa.RecordBatch.from_pydict({"pattern": pa.array(code), "n": pa.array(n.astype(np.int64))})


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = _Words()
    for batch in slices(batches):
        made = [read(x.as_py(), cache) for x in batch.column(0)]
        sparse = [sparse_features(r) for r in made]
        yield pa.RecordBatch.from_pydict({
            "pattern": pa.array([_pattern(votes(r)) for r in made], pa.int64()),
            "places": pa.array([p.tobytes() for p, _ in sparse], pa.binary()),
            "values": pa.array([v.tobytes() for _, v in sparse], pa.binary())})


def text_scores(weights: np.ndarray, texts, cache: dict) -> list[float]:
    out = []
    for text in texts:
        reading = read(text, cache)
        if not reading.n:
            out.append(0.0)
            continue
        places = features(reading)
        margin = weights[places].sum() * 10 / (len(places) + SHRINK) + weights[DIMS]
        out.append(float(1 / (1 + np.exp(-np.clip(margin, -50, 50)))))
    return out


@dataclass
class QualityModel:
    weights: np.ndarray
    accuracies: dict[str, float]  # P(vote is right | the labeller votes)


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> QualityModel:
    """The label model over all documents, the scorer over about ``train_docs`` of them
    (those with the smallest hashes; never more)."""
    rows = docs.select("text").mapInArrow(_vote_codes, "pattern bigint, n bigint").groupBy("pattern").agg(
        F.sum("n").alias("n")).collect()  # at most 3 ** labellers rows
    if not rows:
        return QualityModel(np.zeros(DIMS + 1), {})
    codes = np.array([r.pattern for r in rows])
    patterns = codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    counts = np.array([r.n for r in rows], float)
    good, given = label_model(patterns, counts)
    posterior = dict(zip(codes.tolist(), good.tolist(), strict=True))
    order = F.xxhash64("doc_id", "text")
    share = min(1.0, 1.5 * train_docs / counts.sum() + 1e-9)
    sample = (docs.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)))
              .select("text", order.alias("order")).orderBy("order").limit(train_docs).select("text")
              .mapInArrow(_sample_features, "pattern bigint, places binary, values binary").collect())
    weights = train([(np.frombuffer(r.places, "<i4"), np.frombuffer(r.values, "<f4")) for r in sample],
                    np.array([posterior.get(r.pattern, 0.5) for r in sample]))
    cast, prior = patterns != ABSTAIN, good * counts
    voted = np.stack([((counts - prior)[:, None] * cast).sum(0), (prior[:, None] * cast).sum(0)])
    right = (voted[0] * (1 - given[0]) + voted[1] * given[1]) / np.maximum(voted.sum(0), 1e-9)
    return QualityModel(weights, {x[0]: float(r) for x, r in zip(LABELLERS, right, strict=True)})


def score(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, mark (the text's xxhash64), quality_score in 0..1,
    keep.

    Null, empty and blank texts score 0 and are rejected. Any number of repeated rows or
    ids, ties and extra columns are fine; an empty table gives an empty result.
    """
    id_field, weights = docs.schema["doc_id"], docs.sparkSession.sparkContext.broadcast(model.weights)
    kind = to_arrow_type(id_field.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _Words()
        for batch in slices(batches):
            texts = batch.column(1).to_pylist()
            got = np.array(text_scores(weights.value, texts, cache), float)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0).cast(kind), "mark": pa.array(map(text_mark, texts), pa.int64()),
                "quality_score": pa.array(got), "keep": pa.array(got >= threshold)})

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([
        id_field, T.StructField("mark", T.LongType()), T.StructField("quality_score", T.DoubleType()), T.StructField("keep", T.BooleanType())]))


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns as they were."""
    gone = materialize(score(docs, model, threshold).where("not keep").select("doc_id", "mark"), "dropped")
    return drop_rows(docs, gone)
