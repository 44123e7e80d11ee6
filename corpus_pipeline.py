"""The training-data pipeline: ``documents`` in, a training mix out.

Every stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each result
as Parquet to the shared checkpoint folder and reads it back for the next. All stages but
the last keep the columns of ``documents`` and only ever drop whole rows. A stage's
result must be stored before the next stage starts, which removes its intermediates.

Null, empty and blank texts go in the first stage; rows that repeat an id and a text go in
the second; a component whose ids are all null keeps all its rows; extra columns pass
through; an empty table gives an empty mix.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from saleslens.llm.decontaminate import keep_clean
from saleslens.llm.exact_dedup import keep_one
from saleslens.llm.mixing import mix
from saleslens.llm.ngram_join import keep_representatives
from saleslens.llm.quality import fit, keep_good
from saleslens.session import materialize, release_scratch, scratch_scope

_written: dict[str, list[str]] = {}


def _stage(work):
    """Give a stage a scratch folder of its own and remove those of earlier stages."""

    @functools.wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        scopes = _written.setdefault(spark.sparkContext.applicationId, [])
        while scopes:
            release_scratch(spark, scopes.pop())
        with scratch_scope(work.__name__) as scope:
            scopes.append(scope)
            return work(spark, docs, sf_dir)

    return stage



@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; it is fitted on this stage's input."""
    return keep_good(docs, fit(docs))


@_stage
def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the smallest id."""
    return keep_one(docs)


@_stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: the one whose id names it."""
    return keep_representatives(docs, gram=5, similarity=(80, 100))


@_stage
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: doc_id, source, epoch, block, place, n_tokens."""
    return mix(docs)


STAGES = [("quality", quality), ("exact_copies", exact_copies), ("near_copies", near_copies),
          ("benchmark_leaks", benchmark_leaks), ("source_mix", source_mix)]

ORACLE_SQL = None  # SQL cannot express the quality classifier


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
