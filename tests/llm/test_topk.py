import math
import random

import numpy as np
from pyspark.sql import functions as F

from leadforge.llm import topk


def brute(rows, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    ok = list({(i, tuple(v)) for i, v in ok})
    out = []
    for i, q in ok:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i and len(v) == len(q))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.12) for _ in range(8)]) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(30)] + [(350, [0.0] * 8), (2000, [1.0] * 8), (50_000, [0.5, -0.5]), (50_001, [0.25, 0.1])]
    rows += [(3000, None), (3050, [None] + [0.1] * 7), (3100, [float("nan")] * 8), (3150, [float("inf")] * 8), (None, [0.1] * 8), rows[100], rows[100]]
    rows = [r for i, r in enumerate(rows) if not (r[0] == 350 and i < 700)]
    monkeypatch.setattr(topk, "CANDIDATES", 100)
    monkeypatch.setattr(topk, "QUERIES", 6)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "7 AS score", "7 AS block", "true AS is_query")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()))
    assert got == brute(rows, 5)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0
    assert topk.top_k(df.filter("vec_id IN (50, 51)"), F.col("vec_id") % 50 == 0, 5).count() == 1


def test_stops_early_where_scores_concentrate():
    rng = np.random.default_rng(0)
    v = np.floor(256 * np.abs(rng.standard_normal((5000, 3))) ** 3)
    lists = topk.Lists(np.arange(5000), v)
    q = np.array([5.0, 1.0, 1.0])
    got, scored = lists.search(-1, q, 5)
    order = np.lexsort((np.arange(5000), -(v @ q)))[:5]
    assert [i for i, _ in got] == order.tolist() and scored < 1000


def test_exact_types():
    assert topk.exact_type(100, 64) is np.float32 and topk.exact_type(10**5, 64) is np.float64 and topk.exact_type(10**9, 64) is np.int64
