"""Every stage of the pipeline against a brute-force version of it, on its own input."""

import re

import pytest

import corpus_pipeline
from saleslens.llm import queries_sql
from saleslens.llm.decontaminate import words
from saleslens.llm.quality import THRESHOLD, _Words, fit, text_scores
from tests.llm.helpers import SF, docs_frame, duck, linked_components, squeeze


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        out[name] = (docs, spark.read.parquet(path), path)
        docs = out[name][1]
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def pairs(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_columns(stages):
    for name, (before, after, _) in list(stages.items())[:-1]:
        assert after.columns == before.columns, name
        assert after.exceptAll(before).isEmpty(), name


def test_quality_stage(spark, stages):
    before, after, _ = stages["quality"]
    weights, cache = fit(before).weights, _Words()
    rows = pairs(before)
    want = sorted(i for (i, _), s in zip(rows, text_scores(weights, (t for _, t in rows), cache), strict=True) if s >= THRESHOLD)
    assert ids(after) == want
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = {i for i, q in labels.items() if q == 1}
    assert len(clean - set(want)) <= 0.02 * len(clean)


def test_exact_stage(stages):
    before, after, _ = stages["exact_copies"]
    best = {}
    for i, t in pairs(before):
        best[squeeze(t)] = max(best.get(squeeze(t), (-1, 0)), (len(t), -i))
    assert ids(after) == sorted(-i for _, i in best.values())


def test_near_stage(stages):
    before, after, _ = stages["near_copies"]
    groups = linked_components(pairs(before), 5, 80, 100)
    assert ids(after) == sorted(i for i, (_, c) in groups.items() if i == c)


def test_leak_stage(spark, stages):
    before, after, _ = stages["benchmark_leaks"]
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        own = words(r.text)
        n = min(10, len(own))
        windows |= {(n, *own[i:i + n]) for i in range(len(own) - n + 1) if n}
    sizes = {w[0] for w in windows}
    want = []
    for i, t in pairs(before):
        own = words(t)
        if not any((n, *own[k:k + n]) in windows for n in sizes for k in range(len(own) - n + 1)):
            want.append(i)
    assert ids(after) == sorted(want)


def test_mix_stage(stages):
    _, after, _ = stages["source_mix"]
    source = list(stages.values())[-2][2]
    got = after.toPandas()
    want = duck(queries_sql.OP5, documents=source)[list(got.columns)]
    order = list(got.columns)
    got, want = (d.astype(str).sort_values(order).reset_index(drop=True) for d in (got, want))
    assert got.equals(want) and len(got)


def test_run_equals_the_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF).exceptAll(stages["source_mix"][1]).isEmpty()


def test_stages_on_odd_rows(spark):
    text = "Plain words of an ordinary sentence that goes on for a while, as sentences do."
    odd = [(1, None), (2, ""), (3, " \n"), (4, text, "a"), (4, text, "a"), (5, text + " ", None), (None, text.replace("Plain", "Other"), "b"), (6, "x" * 50_000)]
    for rows in ([], odd):
        docs = docs_frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SF)
            assert kept.columns == docs.columns and kept.count() <= len(rows), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 0


def test_no_name_is_left_out():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_copies", "near_copies", "benchmark_leaks", "source_mix"]
    assert re.search(r"def run\(spark", open(corpus_pipeline.__file__).read())
