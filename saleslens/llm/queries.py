"""The registered queries of the operators: whole tables, production parameters.

Every query is a thin projection of its operator's real output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslens.llm import toxicity
from saleslens.llm.decontaminate import SLOP, decontaminate
from saleslens.llm.exact_dedup import exact_dedup
from saleslens.llm.fill_middle import fill_middle, restored
from saleslens.llm.html_text import extract
from saleslens.llm.line_dedup import line_dedup
from saleslens.llm.lm_score import score_texts
from saleslens.llm.mixing import mix
from saleslens.llm.ngram_join import ngram_join
from saleslens.llm.packing import pack
from saleslens.llm.quality import fit, score
from saleslens.llm.secrets import secret_scan
from saleslens.llm.variants import spelling_variants


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def _fold(doc_id, folds: int):
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(_fold(F.col("doc_id"), 3) != 1)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", (F.coalesce(_fold(F.col("doc_id"), 3), F.lit(0)) == 1).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), F.coalesce(_fold(F.col("doc_id"), 10), F.lit(1)) != 0)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), slop=SLOP)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"), F.size("near_ids").cast("bigint").alias("n_near"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(table(spark, sf_dir, "documents"))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(listed(F.filter("spans", lambda s: s.kind != "novel")), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("mark", "keep_mark")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs)).drop("mark")


def op11_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_toxicity, op3_lm_score, op4_html_text, op5_mix_sources, op6_decontaminate, op7_secrets, op8_exact_dedup,
                                  op9_ngram_join, op10_quality, op11_pack, op12_fill_middle, op13_spelling_variants)}
