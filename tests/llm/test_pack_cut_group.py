"""Packing, fill-in-middle and spelling variants against brute force and exact round trips."""

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saleslens.llm import packing, queries, queries_sql, variants
from saleslens.llm.fill_middle import ArrayContainer, BitmapContainer, BoundarySet, RunContainer, boundaries, container, fill_middle, restored
from saleslens.llm.tokens import Encoder
from tests.llm.helpers import LOWER, SF, docs_frame, duck, rows_of

public_tokenizers = pytest.importorskip("public_tokenizers")
BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", ["op12_fill_middle", "op13_spelling_variants"])
def test_query_matches_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = duck(queries_sql.ORACLE_SQL[name])[list(got.columns)]
    order = list(got.columns)
    got, want = (d.astype(object).where(d.notna(), None).astype(str).replace(r"\.0$", "", regex=True)
                 .sort_values(order).reset_index(drop=True) for d in (got, want))
    assert len(got) and got.equals(want)


# --- 11: packing ------------------------------------------------------------------------

PARTS = ["a", "b", "Z", "é", "ß", "×", "'s", "'t", "'", "'re", "ll", " ", "  ", "\n", "\t", " \n", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0",
         " ", " ", "​", " ", " ", "　", "’", "1", "22", "½", ".", ",", "!", "(", '"', "_", "-", "<|endoftext|>",
         "漢", "ア", "д", "ಠ", "😀", "́", "\x00", "﻿", "᠎"]


def test_chunks_give_the_tokenizer_s_own_ids():
    """Whatever meets at a cut, the ids are those of the whole text."""
    encoder, draw = Encoder(BPE), random.Random(3)
    for _ in range(8):
        texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(1500)] + [None, ""]
        ids, at = encoder.encode(pa.array(texts, pa.string()), 2)
        want = encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [[*w.ids, 2] for w in want]


def test_encoder_forgets_and_reads_a_slice(monkeypatch):
    monkeypatch.setattr("saleslens.llm.tokens.KNOWN", 50)
    monkeypatch.setattr("saleslens.llm.tokens.SEGMENT", 7)
    encoder = Encoder(BPE)
    texts = pa.array([f"word{i} of row {i}.\n\n  The end{i}" for i in range(80)])
    whole = [[*e.ids, 2] for e in encoder.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
    for part in (texts, texts.slice(11, 40), texts.slice(79)):
        ids, at = encoder.encode(part, 2)
        first = texts.to_pylist().index(part[0].as_py())
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == whole[first:first + len(part)]


def best_fit_decreasing(sizes, capacity):
    gaps, n = [], 0
    for size in sorted(sizes, reverse=True):
        i = bisect.bisect_left(gaps, size)
        if i == len(gaps):
            n, gap = n + 1, capacity - size
        else:
            gap = gaps.pop(i) - size
        if gap:
            bisect.insort(gaps, gap)
    return n


def check_packing(rows, sizes, capacity):
    """Every piece once, no sequence over its capacity; how many sequences."""
    assert sorted(r.id for r in rows) == list(range(len(sizes)))
    held = Counter()
    for r in rows:
        held[r.sequence_id] += sizes[r.id]
    assert all(n <= capacity for n in held.values())
    return len(held)


@pytest.mark.parametrize("rows_a_task", [2_000_000, 60])
@pytest.mark.parametrize("kind", ["uniform", "halves", "one size", "small", "skewed"])
def test_best_fit_is_close_to_the_sequential_one(spark, kind, rows_a_task):
    draw = random.Random(5)
    sizes = {"uniform": [draw.randint(1, 100) for _ in range(600)], "halves": [51 + draw.randint(0, 3) for _ in range(150)],
             "one size": [34] * 301, "small": [draw.randint(1, 4) for _ in range(900)],
             "skewed": [7] * 300 + [draw.randint(1, 100) for _ in range(300)]}[kind]
    frame = spark.createDataFrame(list(enumerate(sizes)), "id bigint, size bigint")
    n = check_packing(packing.best_fit(frame, 100, rows_a_task).collect(), sizes, 100)
    assert n <= 1.02 * best_fit_decreasing(sizes, 100) + 1


def test_small_pieces_need_few_rounds(spark, monkeypatch):
    rounds, plain = [], packing._round
    monkeypatch.setattr(packing, "_round", lambda *a: rounds.append(1) or plain(*a))
    packing.best_fit(spark.createDataFrame([(i, 1 + i % 3) for i in range(4000)], "id bigint, size bigint"), 1024)
    assert len(rounds) <= 6


def test_ranges_match_late_gaps_with_waiting_pieces():
    # tasks: 0 leaves 5 pieces; 1 has 2 late gaps and 3 pieces; 2 has 7 late gaps
    assert packing._across([(0, 0, 5), (1, 2, 3), (2, 7, 0)]) == [(0, 0, 1, 0, 2), (1, 0, 2, 0, 3), (0, 2, 2, 3, 3)]


def test_cut_longer_documents():
    assert packing._cut(10, 4) == [(0, 2), (2, 4), (6, 4)] and packing._cut(8, 4) == [(0, 4), (4, 4)]
    assert packing._cut(4, 4) == [(0, 4)] and packing._cut(1, 4) == [(0, 1)]


EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "word " * 3000), (5, "x"), (5, "x"), (5, "another text under the id"), (None, "no id"),
        (6, "é漢😀" * 50)]


def test_pack_edges(spark):
    got = packing.pack(docs_frame(spark, EDGE), BPE, capacity=64, keep_ids=True)
    rows, encoder = got.collect(), Encoder(BPE)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids"]
    texts = Counter()
    for i, t in EDGE:
        ids = [*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        for k, (start, n) in enumerate(packing._cut(len(ids), 64)):
            part = np.array(ids[start:start + n], "<u4")
            texts[i, k, start, n, zlib.crc32(part.tobytes()), tuple(part.tolist())] += 1
    assert texts == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in rows)
    at = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 64
    joined = {r.sequence_id: r.ids for r in packing.sequences(got).collect()}
    assert all(joined[r.sequence_id][r.offset:r.offset + r.length] == r.ids for r in rows) and len(joined) == len(at)
    assert packing.pack(docs_frame(spark, []), BPE).collect() == []


def test_pack_query_fills_its_sequences(spark):
    rows = queries.op11_pack(spark, SF).toPandas()
    held = rows.groupby("sequence_id").length.sum()
    assert held.max() <= 1024 and len(held) <= best_fit_decreasing(rows.length.tolist(), 1024) + 2
    assert rows.doc_id.nunique() == spark.read.parquet(f"{SF}/documents.parquet").count()


# --- 12: fill-in-middle -------------------------------------------------------------------

def test_containers_select_alike():
    draw = np.random.default_rng(1)
    kinds = {ArrayContainer: np.sort(draw.choice(1 << 16, 3000, False)), BitmapContainer: np.sort(draw.choice(1 << 16, 30_000, False)),
             RunContainer: np.concatenate((np.arange(5, 9000), np.arange(20_000, 60_000)))}
    for kind, low in kinds.items():
        made = container(low)
        assert type(made) is kind
        assert [made.select(k) for k in range(0, len(low), 97)] == low[::97].tolist() and made.select(len(low) - 1) == low[-1]
    places = np.concatenate([low + (high << 16) for high, low in zip((0, 3, 70_000), kinds.values())])
    both = BoundarySet(places)
    assert len(both) == len(places) and [both.select(k) for k in range(0, len(places), 331)] == places[::331].tolist()


def brute_fim(doc_id, text, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    form = "spm" if h4 % 100 < spm else "psm"
    out = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), out


LINES = [(i, "\n".join("é😀x<P" * (j % 5) for j in range(i % 9)) + "\n" * (i % 3)) for i in range(60)] + [
    (100, None), (101, ""), (102, "\n"), (103, "a <P> b\nc"), (104, "<M>"), (105, "no <S\n>"), (106, "\n" * 150_000), (107, "ab\n" * 90_000),
    (108, "x" * 70_000 + "\n" + "y" * 70_000), (109, "\r\n\x0b\x85 line"), (None, "one\ntwo\nthree"), (110, "a\nb\nc"), (110, "a\nb\nc"),
    (110, "other\ntext"), (111, "<\nP>\n<S\n>")]


@pytest.mark.parametrize("rate, spm", [(100, 50), (40, 0), (100, 100), (0, 50)])
def test_fill_middle_edges(spark, rate, spm):
    out = fill_middle(docs_frame(spark, LINES), rate, spm)
    assert rows_of(out) == sorted((brute_fim(i, t, rate, spm) for i, t in LINES), key=repr)
    back = out.select("doc_id", restored(F.col("output"), F.col("form")).alias("text"))
    assert rows_of(back) == sorted(((i, t or "") for i, t in LINES), key=repr)


def test_boundaries_are_line_ends():
    for _, text in LINES:
        text = text or ""
        ends = np.cumsum([0, *map(len, re.findall(r"[^\n]*\n|[^\n]+", text))])
        found = boundaries(text)
        assert len(found) == len(ends)
        assert all(found.select(k) == ends[k] for k in range(0, len(ends), max(1, len(ends) // 50)))


# --- 13: spelling variants ----------------------------------------------------------------

def differ_by_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_forms(counts, factor=10):
    near = {w: [v for v in counts if differ_by_one(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) if vs else None for w, vs in near.items()}
    form = {w: f if f and counts[f] >= factor * counts[w] else None for w, f in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), counts[form[w]] if form[w] else None) for w, n in counts.items()), key=repr)


def brute_vocabulary(rows, least=7, count=2):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 31 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= count}


@pytest.mark.parametrize("block_chars, visitors", [(1_000_000, 200_000), (300, 200_000), (300, 10)])
def test_forms_of_random_words(spark, block_chars, visitors):
    """Two letters make repeats, doubled letters and hot halves; small blocks split them."""
    draw = random.Random(9)
    words = {"".join(draw.choices("aé", k=draw.randint(3, 9))) for _ in range(500)} | {"aaaaaaa" + x for x in "bcdefghijklmnop"}
    counts = {w: draw.choice([2, 3, 25, 40, 300, 4000]) for w in words} | {"longword" * 400: 50, "longword" * 399 + "longwird": 3}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = variants.roots(variants.forms(frame, 10, block_chars, visitors)).select("word", "form", "root", "n", "n_near", "form_n")
    assert rows_of(got) == brute_forms(counts)


def test_index_walks_find_what_edits_find():
    draw = random.Random(2)
    words = sorted({"".join(draw.choices("abc", k=draw.randint(2, 6))) for _ in range(200)})
    index = variants.OneWay(words)
    queries_ = words[::3] + ["zzz", "abz", "a"]
    halves = np.array([len(q) // 2 for q in queries_])
    q, w = variants.near_words(index, queries_, halves)
    want = {(a, b) for a in queries_ for b in words if differ_by_one(a, b) and b[:len(a) // 2] == a[:len(a) // 2]}
    # an edit in the left half that leaves its spelling is found too; nothing else is
    assert {(queries_[i], words[j]) for i, j in zip(q.tolist(), w.tolist())} == want


def test_spelling_variants_edges(spark):
    base = "Reference reference REFERENCE Straße straße ÀÉÎÕÜßß ÀÉÎÕÜßß ×÷×÷×÷× word_word123wordword "
    rows = [(i, base + "referencs " * (i % 2)) for i in range(70)] + [
        (200, None), (201, ""), (202, "short"), (None, base), (203, "refarence referencees" * 2), (203, "refarence"), (204, "y" * 9000 + " " + "y" * 9000 + " " + "y" * 9001 + " " + "y" * 9001)]
    got = variants.spelling_variants(docs_frame(spark, rows))
    assert rows_of(got) == brute_forms(brute_vocabulary(rows))
    assert got.where("form IS NOT NULL").count() > 0
    assert variants.spelling_variants(docs_frame(spark, [])).collect() == []
