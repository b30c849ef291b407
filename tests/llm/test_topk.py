import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tasador.llm import topk as T


def brute(rows, k=5, scale=256.0):
    vecs = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x * scale) < 2**62 for x in v):
            v = [math.floor(x * scale) for x in v]
            vecs[i] = min(vecs.get(i, v), v)
    out = []
    for q, v in vecs.items():
        if q % 50 == 0:
            scored = sorted((-max(min(sum(a * b for a, b in zip(v, w, strict=True)), 2**63 - 1), -(2**63)), i) for i, w in vecs.items() if i != q and len(w) == len(v))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, rank string, score int").repartition(4)
    return sorted(map(tuple, T.top_k(df, F.col("id") % 50 == 0, **kw).collect()))


@pytest.mark.parametrize("block,group", [(2048, 512), (40, 3)])
def test_against_brute_force(spark, block, group):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(500, 8))
    v[100:250] = v[100]  # many copies: ties
    rows = [(int(i), [float(x) for x in v[i]]) for i in range(500)]
    rows += [(500, None), (550, [float("nan")] * 8), (600, [math.inf] + [0.0] * 7), (None, [1.0] * 8), (650, [None] + [1.0] * 7), (3, [9.0] * 8), (50, rows[50][1])]
    rows += [(700, [0.0] * 8), (750, [1.0, 2.0]), (751, [2.0, 1.0]), (800, []), (801, []), (850, [1.0, 1.0, 1.0]), (900, [1e9] * 8), (950, [1e16] * 8), (951, [-1e16] * 8), (952, [1e300] * 8)]
    assert run(spark, rows, block_rows=block, group_rows=group) == brute(rows)


def test_stops_before_the_end():
    """On vectors of few large components the bound falls below the kth score early."""
    rng = np.random.default_rng(2)
    v = np.floor(256 * np.where(rng.random((4000, 16)) < 0.1, rng.exponential(2, (4000, 16)), 0)).astype(np.int64)
    block = T.Block(np.arange(4000), v)
    seen = []
    exact = T.products
    try:
        T.products = lambda a, q: seen.append(len(a)) or exact(a, q)
        ids, scores = block.search(0, v[0] + np.eye(16, dtype=np.int64)[3] * 700, 5, -np.inf)
    finally:
        T.products = exact
    assert sum(seen) < 2500 and len(ids) == 5
    s = v @ (v[0] + np.eye(16, dtype=np.int64)[3] * 700)
    s[0] = -(2**60)
    assert scores.tolist() == sorted(s.tolist())[::-1][:5]


def test_floor_keeps_what_reaches_it():
    v = np.array([[3], [2], [2], [1]])
    ids, scores = T.Block(np.arange(4), v).search(9, np.array([1]), 2, 2.0)
    assert ids.tolist() == [0, 1] and scores.tolist() == [3, 2]


def test_few_and_no_rows(spark):
    assert run(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.0])]) == [(0, 1, 1, 32768)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []
