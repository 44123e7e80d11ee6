"""Fixtures and brute-force twins for the operators' tests."""

import hashlib
import os
import re

import duckdb
from pyspark.sql import types as T

WS = " \t\n\x0b\x0c\r"
SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Extra columns carry names that operators use inside.
DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *(T.StructField(n, T.StringType()) for n in ("name", "mark", "key", "rid", "block", "h", "n", "keep", "part", "chunk", "epoch", "of"))])


def docs_frame(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    return spark.createDataFrame(
        [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), *["x"] * 12) for r in rows], DOC_SCHEMA)


def rows_of(frame, *columns):
    return sorted((tuple(r[c] for c in columns or frame.columns) for r in frame.collect()), key=repr)


def duck(sql, sf=SF, **views):
    con = duckdb.connect()
    for t in "documents benchmark labels pages".split():
        path = views.get(t) or f"{sf}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con.execute(sql).df()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def grams(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def linked_components(rows, k, num, den):
    """{doc_id: (shingles, component)} by comparing all pairs."""
    sets = [(i, grams(t, k)) for i, t in rows]
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and den * len(a & b) >= num * len(a | b):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return {i: (len(a), find(i)) for i, a in sets}
