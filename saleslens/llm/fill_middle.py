"""Fill-in-middle transformation over a Roaring-style set of line boundaries.

The places where a text may be cut (0 and every line end, in code points) are kept as a
set of integers in the manner of Roaring bitmaps: places are grouped by their high 16
bits, and each group is a container of the smallest of three kinds, an array of the low
bits, a bitmap of 2 ** 16 bits or a list of runs. Cumulative cardinalities over the
containers let ``select(k)`` find the container of the k-th place by binary search and
the place by a local select. The two cut places of a text are two such selects.

A text is a row of its own and no row meets another, so the plan has no shuffle: hashes,
the assembled output and the restored text are JVM expressions, only the places are found
in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from saleslens.llm.rows import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
HIGH = 16
WORD_BITS = 64
BITMAP_BYTES = (1 << HIGH) // 8


class ArrayContainer:
    """Low bits in ascending order."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class BitmapContainer:
    """One bit per low value; set bits before each 64-bit word are counted once."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << HIGH, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1
        return at * WORD_BITS + (word & -word).bit_length() - 1


class RunContainer:
    """Starts of runs of consecutive values, with the values before each run counted."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def container(low: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container of ascending low values: 2 bytes a value, 4 a run, or 8 KiB."""
    first = np.flatnonzero(np.diff(low, prepend=low[0] - 2) != 1)
    array, runs = 2 * len(low), 2 + 4 * len(first)
    if runs < min(array, BITMAP_BYTES):
        return RunContainer(low[first], np.diff(first, append=len(low)))
    return ArrayContainer(low) if array <= BITMAP_BYTES else BitmapContainer(low)


class BoundarySet:
    """An ascending set of places with ``len`` and ``select``."""

    def __init__(self, places: np.ndarray):
        high = places >> HIGH
        cuts = np.flatnonzero(np.diff(high, prepend=-1))
        self.high = high[cuts]
        self.containers = [container(part & ((1 << HIGH) - 1)) for part in np.split(places, cuts[1:])]
        self.before = np.append(cuts, len(places))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The place that k others come before."""
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.high[at]) << HIGH) + self.containers[at].select(k - int(self.before[at]))


def boundaries(text: str) -> BoundarySet:
    """0 and the end of each line of ``text``, in code points."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.flatnonzero(codes == 10) + 1
    if len(text) and (not len(ends) or ends[-1] < len(text)):
        ends = np.append(ends, len(text))
    return BoundarySet(np.concatenate(([0], ends)).astype(np.int64))


CUTS = T.StructType([T.StructField("__n", T.LongType()), T.StructField("__low", T.LongType()),
                     T.StructField("__high", T.LongType())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of lines and the two cut places of ``__text``."""
    kinds = [to_arrow_type(f.dataType) for f in CUTS]
    for batch in slices(batches):
        found = []
        for text, h1, h2 in zip(batch.column("__text"), batch.column("__h1").to_pylist(), batch.column("__h2").to_pylist()):
            places = boundaries(text.as_py())
            low, high = sorted((h1 % len(places), h2 % len(places)))
            found.append((len(places) - 1, places.select(low), places.select(high)))
        new = [pa.array(column, kind) for column, kind in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds]
        yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *CUTS.names])


def _part(text: Column, start: Column, end: Column) -> Column:
    return F.substr(text, (start + 1).cast("int"), (end - start).cast("int"))


def fill_middle(docs: DataFrame, rate: int = 100, spm: int = 50, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: doc_id, n, form, prefix_chars, middle_chars, output.

    ``n`` counts lines; ``rate`` of 100 texts are transformed, ``spm`` of 100 of them with
    the suffix first. The draws come from the id alone (a null id counts as empty text), so
    rows that repeat an id are cut by the same draws. Null texts are empty; empty texts and
    those that hold a marker are plain: the output is the text, both counts are null. Texts
    are cut whole whatever their length; other columns are ignored, an empty table gives an
    empty result.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(key, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"__h{i + 1}") for i in range(4)]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__text"), *draws)
    out = rows.mapInArrow(_cut, T.StructType([*rows.schema.fields, *CUTS.fields]))
    text, low, high = F.col("__text"), F.col("__low"), F.col("__high")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | text.contains(mark)
    form = (F.when((text == "") | marked | (F.col("__h3") % 100 >= rate), F.lit("plain"))
            .when(F.col("__h4") % 100 < spm, F.lit("spm")).otherwise(F.lit("psm")))
    prefix, middle = _part(text, F.lit(0), low), _part(text, low, high)
    suffix = _part(text, high, F.length(text).cast("bigint"))
    output = (F.when(F.col("form") == "plain", text)
              .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
              .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle)))
    cut = F.col("form") != "plain"
    return out.withColumn("form", form).select(
        "doc_id", F.col("__n").alias("n"), "form", F.when(cut, low).alias("prefix_chars"),
        F.when(cut, high - low).alias("middle_chars"), output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. Markers are found from the left: a transformed
    text holds none itself, and none can arise where parts and markers meet."""
    size = len(MIDDLE)
    head = F.substring_index(output, MIDDLE, 1)
    middle = F.substr(output, F.length(head) + (size + 1))
    body = F.substr(head, F.lit(size + 1))

    def first(mark: str) -> Column:
        return F.substring_index(body, mark, 1)

    def second(mark: str) -> Column:
        return F.substr(body, F.length(first(mark)) + (size + 1))

    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(first(SUFFIX), middle, second(SUFFIX)))
            .otherwise(F.concat(second(PREFIX), middle, first(PREFIX))))
