"""Exact deduplication by deterministic block naming.

The normalised text of every row is cut into blocks of a fixed number of code points.
The distinct blocks are sorted and numbered, so each block gets an integer name that no
other block has. Adjacent names are then paired, the distinct pairs sorted and numbered
again, and so on until one name per row is left: rows have equal texts exactly when
they have the same number of blocks and the same last name.

Everything is DataFrame code. Blocks are combined map-side before their one shuffle (a
text copied a million times ships once per task). A block's hash only routes it: hashes
shared by different blocks are found while naming, and those blocks are then looked up
by their whole text, so a collision can never merge two texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslens.llm.rows import keep_first
from saleslens.session import materialize

BLOCK_CHARS = 1024
WHITESPACE = r"[\x20\x09-\x0D]+"


def squeezed(text: Column) -> Column:
    """``text`` without any white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITESPACE, "")


def _blocks(text: Column, size: int) -> Column:
    return (F.when(text == "", F.array(F.lit("")))
            .otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0))))


def _hash(block: Column, bits: int) -> Column:
    h = F.xxhash64(block)
    return h if bits == 64 else h.bitwiseAND(F.lit((1 << bits) - 1))


def _name_blocks(texts: DataFrame, size: int, bits: int) -> DataFrame:
    """(h, block, name): one row per distinct block; ``block`` only where its hash clashes."""
    blocks = texts.select(F.explode(_blocks(F.col("norm"), size)).alias("block"))
    met = (blocks.groupBy(_hash(F.col("block"), bits).alias("h"))
           .agg(F.collect_set("block").alias("same_hash")))
    ordered = (met.select("h", (F.size("same_hash") > 1).alias("clash"),
                          F.explode("same_hash").alias("block"))
               .sortWithinPartitions("block"))
    return materialize(ordered.select(
        "h", F.when(F.col("clash"), F.col("block")).alias("block"),
        F.monotonically_increasing_id().alias("name")), "block-names")


def _first_names(texts: DataFrame, names: DataFrame, size: int, bits: int) -> DataFrame:
    """(rid, n, pos, name, row): one row per block; ``row`` rides with the first block."""
    rows = (texts.select(F.monotonically_increasing_id().alias("rid"), "norm",
                         F.struct("doc_id", "n_chars", "mark",
                                  F.unhex(F.sha2("norm", 256)).alias("sha")).alias("row"))
            .select("rid", "row", _blocks(F.col("norm"), size).alias("blocks"))
            .select("rid", "row", F.size("blocks").alias("n"), F.posexplode("blocks"))
            .select("rid", "n", "pos", F.col("col").alias("block"),
                    F.when(F.col("pos") == 0, F.col("row")).alias("row"),
                    _hash(F.col("col"), bits).alias("h")))
    clashes = names.where(F.col("block").isNotNull())
    if clashes.isEmpty():
        named = rows.drop("block").join(names.drop("block"), "h")
    else:
        marked = rows.join(clashes.select("h").distinct().withColumn("clash", F.lit(True)),
                           "h", "left")
        rows = marked.withColumn("block", F.when(F.col("clash"), F.col("block"))).alias("r")
        named = rows.join(names.alias("m"), (F.col("r.h") == F.col("m.h"))
                          & F.col("r.block").eqNullSafe(F.col("m.block")))
        named = named.select("rid", "n", "pos", "m.name", "row")
    return materialize(named.select("rid", "n", "pos", "name", "row"), "block-level")


def _pair_up(level: DataFrame) -> DataFrame:
    """Name adjacent pairs of names; a row's odd last name is paired with -1."""
    left = F.col("pos") % 2 == 0
    pairs = materialize(
        level.groupBy("rid", "n", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
        .agg(F.max(F.when(left, F.col("name"))).alias("a"),
             F.coalesce(F.max(F.when(~left, F.col("name"))), F.lit(-1)).alias("b"),
             F.max("row").alias("row")), "pairs")
    names = materialize(pairs.select("a", "b").distinct().sortWithinPartitions("a", "b")
                        .withColumn("name", F.monotonically_increasing_id()), "pair-names")
    return materialize(pairs.join(names, ["a", "b"]).select("rid", "n", "pos", "name", "row"),
                       "pair-level")


def identities(docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_bits: int = 64) -> DataFrame:
    """(rid, doc_id, n_chars, sha, mark, n, name) per row of ``docs``.

    Two rows have equal (n, name) exactly when their squeezed texts are equal; ``rid``
    tells rows apart that share a doc_id.
    """
    texts = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("mark"))
             .select("doc_id", squeezed(F.col("text")).alias("norm"),
                     F.length("text").cast("long").alias("n_chars"), "mark"))
    level = _first_names(texts, _name_blocks(texts, block_chars, hash_bits), block_chars,
                         hash_bits)
    longest = level.agg(F.max("n")).first()[0] or 1
    done, width = [], 1
    while True:
        # rows of at most `width` blocks have one name left
        done.append(level.where(F.col("n") <= width))
        if width >= longest:
            break
        level = _pair_up(level.where(F.col("n") > width))
        width *= 2
    return reduce(DataFrame.unionByName, done).select(
        "rid", "row.doc_id", "row.n_chars", "row.sha", "row.mark", "n", "name")


def exact_dedup(docs: DataFrame, block_chars: int = BLOCK_CHARS, hash_bits: int = 64) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, mark, keep_mark.

    Rows are equal when their texts are after deleting white space (null text: empty).
    Of equal rows the one with most code points stays, then the smallest doc_id (of any
    type that sorts, null last), then the first row of repeated ones. Empty tables give an
    empty result; other columns of ``docs`` are ignored. ``hash_bits`` below 64 only forces
    clashes in tests. ``mark`` is the original text's xxhash64, ``keep_mark`` that of the
    row that stays.
    """
    ids = identities(docs, block_chars, hash_bits)
    best = F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid", "mark")
    groups = materialize(ids.groupBy("n", "name").agg(
        F.min(best).alias("best"), F.count("*").alias("group_size")), "copies")
    return ids.join(groups, ["n", "name"]).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), "mark", F.col("best.mark").alias("keep_mark"))


def keep_one(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    rows = exact_dedup(docs, block_chars).where(~F.col("kept"))
    same = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("mark") == F.col("keep_mark"))
    dropped = materialize(rows.select("doc_id", "mark", same.alias("same")), "dropped")
    return keep_first(docs, dropped.where("NOT same"), dropped.where("same"))
