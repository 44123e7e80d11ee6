"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Words are folded first: lower case, look-alike letters of other scripts and full-width
forms to Latin, digits and signs that stand for letters back to them. The lexicon (words
and word beginnings) and its weights are learned from labelled documents, as are the
exception phrases: a hit next to a word that makes it harmless does not count. A
document's score is a logistic function of its summed weights, plain and per length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from saleslens.llm.rows import slices
from saleslens.session import materialize

TOXIC_DOCS, CLEAN_DOCS = 4000, 16000  # bounds of the training sample
MIN_SUPPORT = 8  # toxic documents that hold a pattern, however many there are
MIN_VARIETY = 0.8  # different surroundings among them
MIN_WEIGHT = float(np.log(4))  # log odds, exceptions aside
FALSE_ENTRIES = 0.05  # patterns that chance alone may be expected to bring into the lexicon
SHINGLE, HASHES = 3, 4  # texts that share so many min-hashes of word groups are copies
DOUBTFUL_SHARE, DOUBTFUL_EVIDENCE = 0.7, 4.0  # whole words that exceptions may yet clear: relative rate and evidence
STEMS = range(4, 9)  # lengths of word beginnings
THRESHOLD = 0.7
MARK = " "  # stands at both ends of every word, so a pattern can be anchored

# Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ї": "i", "ј": "j",
    "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "χ": "x", "ε": "e",
    "η": "n", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l", "ⅼ": "l", "ⅰ": "i",
}
# Digits and signs that stand for letters inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}

_FULL_WIDTH = {0xFF01 + i: 0x21 + i for i in range(94)}
_LOOKALIKE = str.maketrans(HOMOGLYPHS) | _FULL_WIDTH
_SUBSTITUTE = str.maketrans(SUBSTITUTES)
_LATIN = re.compile(r"[a-z]")
_ORDINAL = re.compile(r"\d+(?:st|nd|rd|th)")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INVISIBLE = re.compile("[­​-‍⁠﻿]")


def fold(word: str) -> str:
    """A word's folded form, without punctuation at its ends; empty if nothing is left."""
    word = word.lower()
    if not word.isascii():
        word = _INVISIBLE.sub("", word)
        plain = word.translate(_LOOKALIKE).lower()
        # a word of another script that keeps letters of its own is no disguise
        if _LATIN.search(word) or all(c.isascii() for c in plain if c.isalpha()):
            word = plain
    inner = _EDGES.sub("", word)
    if inner.isalpha() or not _LATIN.search(word):
        return inner
    if _ORDINAL.fullmatch(inner):
        return inner
    whole = _EDGES.sub("", word.rstrip("!|.,;:?").lstrip("!|").translate(_SUBSTITUTE))
    # digits left over are a number: covid19
    return whole if any(c.isalpha() for c in inner) and not any(c.isdigit() for c in whole) else inner


class _Folds(dict):
    def __missing__(self, word: str) -> str:
        if len(self) > 150_000:
            self.clear()
        value = self[word] = fold(word)
        return value


def folded_words(text: str | None, folds: dict) -> list[str]:
    return [w for w in map(folds.__getitem__, text.split()) if w] if text else []


def patterns_of(words: set[str]) -> set[str]:
    """The candidate patterns of a document: whole words and word beginnings."""
    out = {MARK + w + MARK for w in words if len(w) >= 3}
    for w in words:
        out.update(MARK + w[:n] for n in STEMS if len(w) > n)
    return out


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    exceptions: list[str]  # " word word " phrases; a hit inside one does not count
    logistic: np.ndarray  # bias, summed weight, weight per length

    def parts(self):
        """What tasks need, in plain types."""
        return self.lexicon, self.exceptions, self.logistic.tolist()


class Scorer:
    def __init__(self, lexicon: dict[str, float], exceptions: list[str], logistic):
        self.words, self.phrases = ahocorasick.Automaton(), ahocorasick.Automaton()
        for pattern, weight in lexicon.items():
            self.words.add_word(pattern, (pattern, weight))
        for phrase in exceptions:
            self.phrases.add_word(phrase, phrase)
        for automaton in (self.words, self.phrases):
            if len(automaton):
                automaton.make_automaton()
        self.logistic, self.folds, self.weights = np.array(logistic), _Folds(), {}

    def hit(self, word: str) -> tuple[float, str]:
        """The heaviest pattern in a folded word, weight first; (0, "") if there is none."""
        got = self.weights.get(word)
        if got is None:
            if len(self.weights) > 150_000:
                self.weights.clear()
            hits = self.words.iter(MARK + word + MARK) if len(self.words) else ()
            got = self.weights[word] = max(((w, p) for _, (p, w) in hits), default=(0.0, ""))
        return got

    def hits(self, text: str | None) -> tuple[list[tuple[float, str]], int]:
        """(weight, pattern) of the hits outside exception phrases, and the number of words."""
        words = folded_words(text, self.folds)
        hits = {i: h for i, h in enumerate(map(self.hit, words)) if h[1]}
        if hits and len(self.phrases):
            starts = np.cumsum([0, *(len(w) + 1 for w in words)])  # of each word's mark
            for end, phrase in self.phrases.iter(MARK + MARK.join(words) + MARK):
                first = int(np.searchsorted(starts, end - len(phrase) + 1))
                last = int(np.searchsorted(starts, end))
                for i in range(first, last):
                    hits.pop(i, None)
        return list(hits.values()), len(words)

    def measure(self, text: str | None) -> tuple[float, int]:
        """Summed weight of the hits, and the number of words."""
        hits, n = self.hits(text)
        return float(sum(w for w, _ in hits)), n

    def score(self, text: str | None) -> float:
        return float(_logistic(self.logistic, *_inputs(*self.measure(text))))


def _inputs(total, n):
    return np.log1p(total), np.log1p(100 * total / np.maximum(n, 1))


def _logistic(w: np.ndarray, a, b):
    return 1 / (1 + np.exp(-np.clip(w[0] + w[1] * a + w[2] * b, -30, 30)))


def _fit_logistic(total: np.ndarray, n: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Newton's method with a small ridge; classes weigh as in the labelled data."""
    x = np.column_stack([np.ones(len(total)), *_inputs(total, n)])
    w = np.zeros(3)
    for _ in range(rounds):
        p = _logistic(w, x[:, 1], x[:, 2])
        slope = x.T @ (p - toxic) + 1e-3 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _pattern_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per candidate pattern, toxic ones (t) and others (c)."""
    folds, counts = _Folds(), (Counter(), Counter())
    for batch in slices(batches):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[toxic].update(patterns_of(set(folded_words(text, folds))))
    patterns = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_pydict({"pattern": pa.array(patterns, pa.string()),
                                      "t": pa.array([counts[1][p] for p in patterns], pa.int64()),
                                      "c": pa.array([counts[0][p] for p in patterns], pa.int64())})


def _holders(wanted):
    """(pattern, context) per document and wanted pattern: the words around one place of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folds = _Folds()
        for batch in slices(batches):
            patterns, contexts = [], []
            for text in batch.column(0).to_pylist():
                words, own = ["", *folded_words(text, folds), ""], {}
                for i, w in enumerate(words[1:-1], 1):
                    for pattern in patterns_of({w}) & wanted.value:
                        own.setdefault(pattern, words[i - 1] + MARK + words[i + 1])
                patterns += own
                contexts += own.values()
            yield pa.RecordBatch.from_pydict({"pattern": pa.array(patterns, pa.string()), "context": pa.array(contexts, pa.string())})

    return run


def _neighbours(lexicon):
    """Counts of the phrases that a hit forms with the word before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, counts = Scorer(lexicon.value, [], [0, 0, 0]), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = folded_words(text, scorer.folds)
                own = set()
                for i, w in enumerate(words):
                    if scorer.hit(w)[1]:
                        own |= {MARK + MARK.join(words[j:j + 2]) + MARK for j in (i - 1, i) if 0 <= j < len(words) - 1}
                counts.update((phrase, toxic) for phrase in own)
        yield pa.RecordBatch.from_pydict({"phrase": pa.array([p for p, _ in counts], pa.string()),
                                          "toxic": pa.array([t for _, t in counts], pa.int32()),
                                          "n": pa.array(list(counts.values()), pa.int64())})

    return run


def _hit_counts(parts):
    """Documents per pattern hit outside exceptions, by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, counts = Scorer(*parts.value), Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts.update((p, toxic) for p in {p for _, p in scorer.hits(text)[0]})
        yield pa.RecordBatch.from_pydict({"pattern": pa.array([p for p, _ in counts], pa.string()),
                                          "toxic": pa.array([t for _, t in counts], pa.int32()),
                                          "n": pa.array(list(counts.values()), pa.int64())})

    return run


def _measures(parts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*parts.value)
        for batch in batches:
            got = [scorer.measure(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(1), "total": pa.array([t for t, _ in got], pa.float64()),
                                              "n": pa.array([n for _, n in got], pa.int64())})

    return run


def _varied(held: DataFrame) -> dict[str, int]:
    """Documents of the patterns that enough of them hold, in ever different surroundings.

    Text that merely is copied along with a toxic word has the same surroundings.
    ``held``: (pattern, context), a row per document and pattern.
    """
    n = F.col("n")
    fit = (held.groupBy("pattern").agg(F.count("*").alias("n"), F.countDistinct("context").alias("around"))
           .where((n >= MIN_SUPPORT) & (F.col("around") >= MIN_VARIETY * n)))
    return {r.pattern: r.n for r in fit.collect()}


def _choose(docs: dict[str, int], clean: dict[str, int], weight) -> dict[str, float]:
    """A word's beginning takes the place of its forms if it holds more documents than each."""
    out: dict[str, float] = {}
    begun: set[str] = set()  # beginnings of the chosen ones
    for pattern in sorted(docs, key=lambda p: (-docs[p], -len(p), p)):
        own = {pattern[:n] for n in range(1, len(pattern) + 1)}
        if pattern not in begun and own.isdisjoint(out):
            out[pattern] = weight(docs[pattern], clean.get(pattern, 0))
            begun |= own
    return out


def _unlike(sample: DataFrame) -> DataFrame:
    """One of documents that share ``HASHES`` min-hashes of their groups of ``SHINGLE``
    words: copies teach nothing. Unlike texts share words, but hardly such groups."""
    names = [f"h{i}" for i in range(HASHES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = np.random.default_rng(0).integers(1 << 62, size=(HASHES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in slices(batches):
            least = []
            for text in batch.column(0).to_pylist():
                words = (text or "").lower().split()
                groups = {" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
                own = np.array([xxhash.xxh64_intdigest(g) for g in groups], np.uint64)
                least.append((own * odd).min(axis=1).view(np.int64))
            made = np.array(least, np.int64).reshape(-1, HASHES)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(made[:, i]) for i in range(HASHES))],
                                             ["text", "toxic", *names])

    hashed = sample.select("text", "toxic").mapInArrow(run, "text string, toxic int, " + ", ".join(f"{n} bigint" for n in names))
    return hashed.dropDuplicates(["toxic", *names])


def least_evidence(tried: int) -> float:
    """The likelihood ratio statistic that, of ``tried`` patterns that say nothing, about
    ``FALSE_ENTRIES`` exceed."""
    return NormalDist().inv_cdf(1 - FALSE_ENTRIES / (2 * max(tried, 1))) ** 2


def _sample(docs: DataFrame, labels: DataFrame, toxic_docs: int, clean_docs: int) -> DataFrame:
    """(text, toxic) of the labelled documents with the smallest hashes, a bounded number.

    The ids are chosen first and broadcast, so no text of other documents moves. An id with
    several labels is toxic if one of them says so.
    """
    known = materialize(labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic")), "known")
    first = F.xxhash64("doc_id")
    n = dict(known.groupBy("toxic").count().collect())

    def least(toxic: int, most: int) -> DataFrame:
        # the cut leaves about half as many again, so tasks send few rows to the one that sorts
        own, share = known.where(F.col("toxic") == toxic), 1.5 * most / max(n.get(toxic, 0), 1)
        cut = own.where(first < int((share - 0.5) * (1 << 64))) if share < 1 else own
        return cut.orderBy(first).limit(most)

    chosen = least(1, toxic_docs).unionByName(least(0, clean_docs))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")
    return materialize(rows.limit(toxic_docs + clean_docs), "labelled")


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS) -> ToxicityModel:
    """Learn lexicon, exceptions and score from docs (doc_id, text) and labels (doc_id, toxic).

    At most ``toxic_docs`` toxic and ``clean_docs`` other documents are used, with every
    pattern in them; what chance brings grows with the number of patterns, so the evidence
    asked for does too. Null labels, null ids and null texts teach nothing; repeated rows
    count once, other columns not at all. Without toxic documents the lexicon is empty and
    every score the same.
    """
    spark = docs.sparkSession
    both = materialize(_unlike(_sample(docs, labels, toxic_docs, clean_docs)).select("text", "toxic").repartition(16), "lessons")
    sizes = dict(both.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)

    def weight(t: int, c: int) -> float:
        return float(np.log((t + 0.5) / (n_toxic + 1)) - np.log((c + 0.5) / (n_clean + 1)))

    rate = n_toxic / max(n_toxic + n_clean, 1)
    t, c = F.col("t"), F.col("c")
    odds = F.log((t + 0.5) / (n_toxic + 1.0)) - F.log((c + 0.5) / (n_clean + 1.0))
    ratio = 2 * (t * F.log(t / ((t + c) * rate)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - rate)))).otherwise(0.0))
    counts = both.mapInArrow(_pattern_counts, "pattern string, t bigint, c bigint").groupBy("pattern").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c"))
    met = materialize(counts.where(t >= MIN_SUPPORT), "candidates")
    enough = least_evidence(met.count())

    def speaks(t: int, c: int) -> bool:
        """Whether the log odds are clearly positive."""
        evidence = 2 * sum(k * np.log(k / ((t + c) * r)) for k, r in ((t, rate), (c, 1 - rate)) if k)
        return weight(t, c) >= MIN_WEIGHT and evidence >= enough

    whole = F.col("pattern").endswith(MARK) & (ratio >= DOUBTFUL_EVIDENCE) & (c * n_toxic <= DOUBTFUL_SHARE * t * max(n_clean, 1))
    wanted = {r.pattern: r.c for r in met.where((odds >= MIN_WEIGHT) & (ratio >= enough) | whole).collect()}
    held = both.where("toxic = 1").select("text").mapInArrow(
        _holders(spark.sparkContext.broadcast(set(wanted))), "pattern string, context string")
    lexicon = _choose(_varied(held), wanted, weight)

    near = both.mapInArrow(_neighbours(spark.sparkContext.broadcast(lexicon)), "phrase string, toxic int, n bigint").groupBy("phrase").agg(
        F.sum(F.expr("if(toxic = 1, n, 0)")).alias("t"), F.sum(F.expr("if(toxic = 1, 0, n)")).alias("c"))
    exceptions = sorted(r.phrase for r in near.where((c >= 3) & (odds < 0)).collect())

    # Only words that are clearly rarer in other documents, exceptions aside, stay in the lexicon.
    left: dict[str, list[int]] = {}
    for r in (both.mapInArrow(_hit_counts(spark.sparkContext.broadcast((lexicon, exceptions, [0, 0, 0]))),
                              "pattern string, toxic int, n bigint").groupBy("pattern", "toxic").agg(F.sum("n").alias("n")).collect()):
        left.setdefault(r.pattern, [0, 0])[r.toxic] += r.n
    lexicon = {p: weight(t, c) for p, (c, t) in left.items() if t >= MIN_SUPPORT and speaks(t, c)}
    kept = Scorer(lexicon, [], [0, 0, 0])
    exceptions = [p for p in exceptions if any(kept.hit(w)[1] for w in p.split())]

    parts = spark.sparkContext.broadcast((lexicon, exceptions, [0, 0, 0]))
    read = both.mapInArrow(_measures(parts), "toxic int, total double, n bigint").toPandas()
    logistic = _fit_logistic(read.total.to_numpy(), read.n.to_numpy(), read.toxic.to_numpy()) if len(read) else np.zeros(3)
    return ToxicityModel(lexicon, exceptions, logistic)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1).

    Null, empty and blank texts score as texts without hits. Repeated rows get a row each;
    other columns are ignored; an empty table gives an empty result.
    """
    id_field, parts = docs.schema["doc_id"], docs.sparkSession.sparkContext.broadcast(model.parts())
    kind = to_arrow_type(id_field.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*parts.value)
        for batch in slices(batches):
            got = [scorer.score(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).cast(kind), "score": pa.array(got, pa.float64())})

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([id_field, T.StructField("score", T.DoubleType())]))
