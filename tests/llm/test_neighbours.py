"""Nearest neighbours against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from llm.neighbours import Index, nearest
from llm.queries import op4_nearest_neighbours


def brute(rows, asked, k):
    """Of usable rows (vec_id, vector): the k nearest of each that is asked for."""
    found = {}
    for i, v in rows:
        if i is not None and v and len(v) == 3 and all(x is not None and math.isfinite(x) for x in v) and any(v):
            found[i] = np.array(v, dtype=float)
    out = []
    for q in found:
        if asked(q):
            near = sorted((-float((found[q] * v).sum()), i) for i, v in found.items() if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:k])]
    return sorted(out)


def test_whole_share_is_exact(spark):
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(random.integers(-3, 4, 3))]) for i in range(300)]
    rows += [(1000, None), (1001, []), (1002, [0.0, 0.0, 0.0]), (1003, [1.0, None, 2.0]), (1004, [1.0, float("nan"), 2.0]), (1005, [float("inf"), 0.0, 1.0])]
    rows += [(1020, [1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (40, rows[40][1])] + [(2000 + i, [1.0, 1.0, 1.0]) for i in range(80)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, leaf int").repartition(3)
    got = nearest(df, F.col("vec_id") % 20 == 0, Index(k=7, share=100.0, block=16)).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 20 == 0, 7)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0, 3.0]), (5, [1.0, 0.0, 3.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in nearest(df, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 5, 10.0)]
    assert nearest(df.where("vec_id = 0"), F.lit(True)).collect() == [] and nearest(df.limit(0), F.lit(True)).collect() == []


def test_recall_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    found = {}
    for r in op4_nearest_neighbours(spark, sf_dir).collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    shares = []
    for i in np.flatnonzero(ids % 20 == 0):
        scores = vectors @ vectors[i]
        scores[i] = -np.inf
        shares.append(len(set(ids[np.lexsort((ids, -scores))[:20]]) & set(found[ids[i]])) / 20)
    assert np.mean(shares) >= 0.92 and all(len(x) == 20 for x in found.values())
