"""Secret scan: patterns, and zstandard novelty primed with a dictionary.

Patterns report assignments of credentials, access keys and long hexadecimal runs. The
novelty scan looks at other unbroken strings near words that speak of credentials, before or after them: a
compressor primed with the corpus's identifiers and common words measures how many bytes
the string adds to the text around it. Names and prose compress away; a string that adds
about as many bytes as noise of its own alphabet is reported.
"""

from __future__ import annotations

import heapq
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from saleslens.llm.rows import slices
from saleslens.session import materialize

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the maximal runs of 32 and more
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{8,}={0,2}")  # '=' only as padding: WORD=value has a value

# Words that speak of credentials; lower case.
SENSITIVE = (b"password", b"passwd", b"passphrase", b"secret", b"token", b"apikey", b"api_key", b"api-key",
             b"access_key", b"private_key", b"credential", b"bearer", b"authorization", b"signature", b"auth_")
SENSITIVE_RE = re.compile("|".join(x.decode() for x in SENSITIVE), re.I | re.A)

REACH = 64  # characters between the word and the candidate, on either side
# Of fewer bits, a byte more or less would decide; names are letters, numbers digits only.
LEAST_BITS, LEAST_BITS_ALONE = 48, 96
CONTEXT = 256  # characters of surrounding text on either side
PIECE = 32
NOVELTY = 0.9
DIGITS, LOWERS, UPPERS = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DICTIONARY_WORDS = 4096

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
HEX_MARK = bytes(1 if chr(c) in "0123456789abcdef" else 0 for c in range(256))


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the patterns, in code points."""
    raw = text.encode()
    low, out = raw.translate(LOWER), []
    if any(w in low for w in (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in raw:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    if b"\1" * 32 in raw.translate(HEX_MARK):
        out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return out


def alphabet(string: str) -> str:
    """The letters and digits that a string like this one is drawn from."""
    own = set(string)
    for hexadecimal in (DIGITS + "abcdef", DIGITS + "ABCDEF"):
        if own & set(DIGITS) and own & set(hexadecimal[10:]) and own & set(DIGITS + LOWERS + UPPERS) <= set(hexadecimal):
            return hexadecimal
    return "".join(kind for kind in (DIGITS, LOWERS, UPPERS) if not own.isdisjoint(kind))


def long_enough(string: str) -> bool:
    """Whether noise of the string's alphabet and length holds the bits of a credential."""
    kinds, n = alphabet(string), sum(c.isalnum() for c in string)
    digits = sum(c.isdigit() for c in string)
    return n * math.log2(len(kinds) or 1) >= (LEAST_BITS if 0 < digits < n else LEAST_BITS_ALONE)


class Novelty:
    """How new a string is, given the text around it and a dictionary: the bytes it adds
    when compressed, as a share of those that noise of the same length and alphabet adds,
    with other signs where the string has them. Of a longer string, the newest piece of
    ``PIECE`` characters counts."""

    def __init__(self, dictionary: bytes):
        primed = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if len(dictionary) >= 8 else {}
        self.compressor = zstandard.ZstdCompressor(level=9, write_content_size=False, **primed)
        draw = random.Random(0)
        self.draws = [draw.random() for _ in range(2 * PIECE)]

    def added(self, around: bytes, string: bytes) -> int:
        return len(self.compressor.compress(around + string)) - len(self.compressor.compress(around))

    def noise(self, piece: str, kinds: str) -> bytes:
        return "".join(kinds[int(x * len(kinds))] if c.isalnum() else c for c, x in zip(piece, self.draws, strict=False)).encode()

    def __call__(self, text: str, start: int, end: int) -> float:
        around = (text[max(0, start - CONTEXT):start] + text[end:end + CONTEXT] + "\n").encode()
        ends = [*range(start + PIECE, end - PIECE // 2 + 1, PIECE), end]
        kinds, best = alphabet(text[start:end]), 0.0
        for left, right in zip([start, *ends], ends, strict=False):
            piece = text[left:right]
            best = max(best, self.added(around, piece.encode()) / max(1, self.added(around, self.noise(piece, kinds))))
        return best


def near_strings(text: str) -> Iterator[tuple[int, int]]:
    """The unbroken strings within reach of a word, in order, each as a whole; a word in a
    string cuts it."""
    words = [m.span() for m in SENSITIVE_RE.finditer(text)]
    for (_, left), (right, _) in zip([(0, -REACH - 1), *words], [*words, (len(text) + REACH + 1, 0)], strict=True):
        for m in CANDIDATE.finditer(text, max(left, 0), min(right, len(text))):
            if m.start() - left <= REACH or right - m.end() <= REACH:
                # after the word itself, _ and - only join
                yield m.start() + (len(m[0]) - len(m[0].lstrip("_-")) if m.start() == left else 0), m.end()


def novel_spans(text: str, novelty: Novelty, known: list[tuple[int, int, str]], least: float) -> list[tuple[int, int, str]]:
    low = text.encode().translate(LOWER)
    if not any(w in low for w in SENSITIVE):
        return []
    known = sorted(known)
    starts, reached = [s for s, _, _ in known], [0, *accumulate((e for _, e, _ in known), max)]
    out = []
    for start, end in near_strings(text):
        if reached[bisect_left(starts, end)] <= start and long_enough(text[start:end]) and novelty(text, start, end) >= least:
            out.append((start, end, "novel"))
    return out


def find_spans(text: str | None, novelty: Novelty, least: float = NOVELTY) -> list[tuple[int, int, str]]:
    if not text:
        return []
    spans = pattern_spans(text)
    spans += novel_spans(text, novelty, spans, least)
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _identifiers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of letters-only words and identifiers of five to forty bytes, per task."""
    counts: Counter = Counter()

    def out():
        kept = {w: n for w, n in counts.items() if 5 <= len(w) <= 40 and not any(48 <= c <= 57 for c in w)}
        return pa.RecordBatch.from_pydict({"word": pa.array(list(kept), pa.binary()), "n": pa.array(list(kept.values()), pa.int64())})

    for batch in batches:
        for text in batch.column(0).to_pylist():
            if text:
                counts.update(text.encode().split())
        if len(counts) > 1_000_000:
            yield out()
            counts.clear()
    yield out()


def identifier_dictionary(docs: DataFrame, words: int = DICTIONARY_WORDS) -> bytes:
    """The corpus's ``words`` commonest identifiers, commonest last (nearest to the text)."""
    counts = materialize(docs.select("text").mapInArrow(_identifiers, "word binary, n bigint")
                         .groupBy("word").agg(F.sum("n").alias("n")), "words")
    level = F.floor(F.log2("n") * 16).cast("int")
    cut = held = 0
    for cut, n in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):  # at most 16 * 63 rows
        held += n
        if held >= words:
            break
    # written: candidates, few more than the words wanted, meet in a task, the driver gets the chosen ones
    top = materialize(counts.where(level >= cut).orderBy(F.desc("n"), "word").limit(words), "identifiers").collect()
    best = heapq.nsmallest(words, ((-r.n, bytes(r.word)) for r in top))
    return b" ".join(w for _, w in reversed(best))


def secret_scan(docs: DataFrame, dictionary: bytes | None = None, novelty: float = NOVELTY) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans array<struct<kind, start, end>>.

    Spans are in code points, end exclusive, ordered by start and kind. Novel strings never
    overlap the patterns' spans. Null and empty texts have none; repeated rows get a row
    each; other columns are ignored; an empty table gives an empty result. Without a
    ``dictionary`` the one of ``docs`` itself is counted first.
    """
    if dictionary is None:
        dictionary = identifier_dictionary(docs)
    id_field, primer = docs.schema["doc_id"], docs.sparkSession.sparkContext.broadcast(dictionary)
    kind = to_arrow_type(id_field.dataType)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Novelty(primer.value)
        for batch in slices(batches):
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in find_spans(text, measure, novelty)]
                     for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0).cast(kind), "spans": pa.array(found, pa.list_(span))})

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([id_field, T.StructField("spans", T.ArrayType(
        T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))]))
