"""Mixing sources to target weights by temperature.

The weight of a source is its token share to the power ``a``, normalised: a = 1 keeps the
corpus, a = 0 weighs all sources alike. The exponent is bisected, on a grid of 2 ** -20,
to the smallest one whose mix has at most the target entropy and repeats no source more
often than allowed (both fall as ``a`` grows). Each source then fills its token budget
with permutations of its documents, one per epoch. In the last one a document that no
longer fits is passed over and the next ones that do are taken, so what stays free is less
than any document left out of it. The sources are dealt into blocks, each with every
source's share, in hashed order.

All DataFrame code: shares and the bisection are aggregates over one row per source,
evaluated for 15 exponents a time; the running totals inside a permutation come from
hash buckets (about the square root of a source's documents each), so a source with a
third of all rows is spread over many tasks. Documents passed over split the last epoch
into runs: each pass over what is left finds every source's next run, and reads in order
only the buckets in which that run lies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslens.llm.rows import bounded
from saleslens.session import materialize

TOKEN = r"[^\x20\x09-\x0D]+"
GRID = 1 << 20
FLATTEN = 0.5
MAX_REPEATS = 4.0
BLOCK_TOKENS = 1 << 18
SEED = 17


def _draw(*parts: Column) -> Column:
    """A hash of the parts as a number in [0, 2 ** 52): 13 hex digits of their md5."""
    text = F.concat_ws(":", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint")


def _mix_at(shares: DataFrame, steps: list[int], budget_share: float) -> list[tuple[float, float]]:
    """Per exponent (in grid steps): the mix's entropy and its largest repetition."""
    p, aggs = F.col("share"), []
    for i, step in enumerate(steps):
        a = step / GRID
        aggs += [F.sum(F.pow(p, F.lit(a))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(a)) * F.log(p)).alias(f"s{i}"),
                 F.max(F.pow(p, F.lit(a - 1.0))).alias(f"r{i}")]
    row = shares.agg(*aggs).first()
    return [(math.log(row[f"z{i}"]) - step / GRID * row[f"s{i}"] / row[f"z{i}"],
             budget_share * row[f"r{i}"] / row[f"z{i}"]) for i, step in enumerate(steps)]


def fit_exponent(shares: DataFrame, target_entropy: float, max_repeats: float, budget_share: float) -> int:
    """The smallest grid step whose mix meets the target entropy and the repetition limit."""

    def fits(at: tuple[float, float]) -> bool:
        return at[0] <= target_entropy + 1e-12 and at[1] <= max_repeats + 1e-12

    low, high = -1, GRID  # low does not fit, high does
    if not fits(_mix_at(shares, [high], budget_share)[0]):
        raise ValueError("no exponent up to 1 meets the target entropy and the repetition limit")
    while high - low > 1:
        width = max(1, (high - low) // 16)
        steps = [s for s in range(low + width, high, width)][:15]
        for step, at in zip(steps, _mix_at(shares, steps, budget_share), strict=True):
            if fits(at):
                high = step
                break
            low = step
    return high


def source_weights(tokens: DataFrame, budget_share: float = 1.0, flatten: float = FLATTEN,
                   max_repeats: float = MAX_REPEATS) -> DataFrame:
    """(source, tokens, n_docs, weight, budget) from (source, tokens) per document.

    The target entropy lies the fraction ``flatten`` of the way from the corpus's entropy
    to that of equal weights; the budget is ``budget_share`` of the corpus's tokens.
    """
    totals = materialize(tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")), "sources")
    whole = totals.agg(F.sum("tokens").alias("n"), F.count("*").alias("sources")).first()
    total = whole.n or 1
    shares = totals.withColumn("share", F.col("tokens") / F.lit(total).cast("double"))
    if not whole.sources:
        return shares.select("source", "tokens", "n_docs", F.lit(0.0).alias("weight"), F.lit(0).cast("bigint").alias("budget"))
    natural = _mix_at(shares, [GRID], budget_share)[0][0]
    target = natural + flatten * (math.log(whole.sources) - natural)
    a = F.lit(fit_exponent(shares, target, max_repeats, budget_share) / GRID)
    z = shares.agg(F.sum(F.pow("share", a))).first()[0]
    weight = F.pow("share", a) / F.lit(z)
    return shares.select("source", "tokens", "n_docs", weight.alias("weight"),
                         F.floor(weight * F.lit(budget_share * total) + 1e-6).cast("bigint").alias("budget"))


def _refilled(used: DataFrame, left: DataFrame) -> DataFrame:
    """``used`` with the documents of ``left`` that still fit, taken in the order of the last
    epoch's draw.

    Each pass takes, per source, the next run of documents that fit one after the other:
    candidates are those no longer than the room, and a running total over them ends where
    one does not fit, which no later pass can take either.
    """
    budgets = used.unionByName(left.withColumn("start", F.lit(None).cast("bigint")).withColumn("n_tokens", F.lit(0).cast("bigint")))
    rooms = materialize(budgets.groupBy("source").agg((F.first("budget") - F.sum("n_tokens")).alias("room"))
                        .where("room > 0").select(F.col("source").alias("of"), "room"), "rooms")
    parts, here = [used], F.col("source").eqNullSafe(F.col("of"))
    while True:
        fitting = left.join(bounded(rooms), here).where("n_tokens <= room").drop("of")
        along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        near = (fitting.groupBy("source", "room", "bucket").agg(F.sum("n_tokens").alias("n"))
                .withColumn("offset", F.coalesce(F.sum("n").over(along), F.lit(0)))
                .where("offset < room").select(F.col("source").alias("of"), F.col("bucket").alias("b"), "offset"))
        inside = Window.partitionBy("source", "bucket").orderBy("draw", "doc_id", "rid").rowsBetween(Window.unboundedPreceding, -1)
        ahead = F.col("offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
        taken = materialize(
            fitting.join(bounded(materialize(near, "near")), here & (F.col("bucket") == F.col("b"))).withColumn("ahead", ahead)
            .where(F.col("ahead") + F.col("n_tokens") <= F.col("room"))
            .withColumn("start", F.col("budget") - F.col("room") + F.col("ahead"))
            .select(*used.columns, "room"), "refill")
        if taken.isEmpty():
            break
        parts.append(taken.drop("room"))
        rooms = materialize(taken.groupBy("source").agg((F.first("room") - F.sum("n_tokens")).alias("room"))
                            .where("room > 0").select(F.col("source").alias("of"), "room"), "rooms")
        # taken documents are the first that fit: what is left lies behind them
        last = materialize(taken.groupBy("source").agg(F.max(F.struct("draw", "doc_id", "rid")).alias("last"))
                           .select(F.col("source").alias("of"), "last"), "last")
        left = (left.join(bounded(last), here).where(F.struct("draw", "doc_id", "rid") > F.col("last")).drop("of", "last"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, budget_share: float = 1.0, flatten: float = FLATTEN, max_repeats: float = MAX_REPEATS,
        block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """The mix, one row per use of a document: doc_id, source, epoch, block, place, n_tokens.

    ``place`` orders a block (from 1). No source exceeds its budget of white-space
    separated tokens, and what it leaves free is less than its shortest unused document. A null source is a source of its own; null, empty and blank texts
    have no tokens and are no part of the mix; repeated rows are documents of their own
    (ties are broken by their place in the table). Other columns are ignored; an empty
    table gives an empty result.
    """
    n_tokens = F.coalesce(F.regexp_count("text", F.lit(TOKEN)), F.lit(0)).cast("bigint")
    rows = materialize(docs.select("doc_id", "source", n_tokens.alias("n_tokens")).where("n_tokens > 0")
                       .withColumn("rid", F.monotonically_increasing_id()), "tokens")
    weights = materialize(source_weights(rows, budget_share, flatten, max_repeats), "weights")
    named = weights.withColumnRenamed("source", "of").withColumn("epochs", F.expr("budget div tokens"))
    drawn = (rows.join(named, F.col("source").eqNullSafe(F.col("of")))
             .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("epochs"))))
             .withColumn("draw", _draw(F.col("epoch"), F.col("doc_id")))
             .withColumn("bucket", F.floor(F.col("draw") * F.ceil(F.sqrt("n_docs")) / F.lit(float(1 << 52)))))
    inside = Window.partitionBy("source", "epoch", "bucket").orderBy("draw", "doc_id", "rid")
    local = materialize(
        drawn.withColumn("before", F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens"))
        .select("doc_id", "source", "epoch", "bucket", "draw", "rid", "n_tokens", "before", "tokens", "budget"), "permutations")
    along = Window.partitionBy("source", "epoch").orderBy("bucket")
    offsets = materialize(
        local.groupBy("source", "epoch", "bucket").agg(F.sum("n_tokens").alias("n"))
        .withColumn("offset", F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
        .select(F.col("source").alias("of"), F.col("epoch").alias("e"), F.col("bucket").alias("b"), "offset"), "offsets")
    placed = materialize(local.join(offsets, F.col("source").eqNullSafe(F.col("of")) & (F.col("epoch") == F.col("e"))
                                    & (F.col("bucket") == F.col("b")))
                         .withColumn("start", F.col("epoch") * F.col("tokens") + F.col("offset") + F.col("before"))
                         .drop("of", "e", "b", "offset", "before"), "placed")
    used = _refilled(placed.where(F.col("start") + F.col("n_tokens") <= F.col("budget")),
                     placed.where(F.col("start") + F.col("n_tokens") > F.col("budget")).drop("start"))
    blocks = F.lit(max(1, math.ceil((weights.agg(F.sum("budget")).first()[0] or 0) / block_tokens)))
    used = used.withColumn("block", F.floor(F.col("start") * blocks / F.col("budget")))
    order = Window.partitionBy("block").orderBy("draw", "source", "doc_id", "epoch", "rid")
    return used.select("doc_id", "source", "epoch", "block", F.row_number().over(order).cast("bigint").alias("place"), "n_tokens")
