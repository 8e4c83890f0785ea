import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadforge.llm import hardneg
from leadforge.llm.hardneg import CoverTree, Spec


def brute(rows):
    ok = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, lab, q in ok:
        if i % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, lj == lab) for j, lj, v in ok if j != i and len(v) == len(q))
        for s, j, _ in [x for x in scored if x[2]][:5]:
            able = [(t, u) for t, u, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(i, j, r + 1, u, -s, -t) for r, (t, u) in enumerate(able)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.05, 0.4])
def test_equals_brute_force(spark, monkeypatch, spread):
    rng = random.Random(3)
    heart = [[rng.gauss(0, 0.3) for _ in range(6)] for _ in range(4)]
    rows = [(i, [x + rng.gauss(0, spread) for x in heart[i % 4]], rng.randrange(3)) for i in range(900)]
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(60)] + [(5000, [0.0] * 6, 1), (5050, [0.5, -0.5], 1), (5051, [0.5, 0.25], 1), (5052, [0.25, 0.0], 2)]
    rows += [(6000, None, 1), (6050, [None] + [0.1] * 5, 1), (6100, [float("nan")] * 6, 1), (6150, [float("inf")] * 6, 1), (None, [0.1] * 6, 1), (6200, [0.1] * 6, None), rows[100], rows[100]]
    monkeypatch.setattr(hardneg, "CANDIDATES", 150)
    monkeypatch.setattr(hardneg, "QUERIES", 7)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "7 AS score", "7 AS block", "7 AS key", "7 AS dim", "7 AS rank")
    got = sorted(map(tuple, hardneg.hard_negatives(df, F.col("vec_id") % 50 == 0).collect()))
    assert got == brute(rows) and got
    assert hardneg.hard_negatives(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert hardneg.hard_negatives(df.filter("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


def tree_of(n, dim, seed, clusters=0):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, dim))
    if clusters:
        v = 0.05 * v + rng.standard_normal((clusters, dim))[rng.integers(0, clusters, n)]
    return CoverTree.build(np.arange(n), rng.integers(0, 3, n), np.floor(256 * v).astype(np.int64)), rng


def test_nodes_cover_and_separate():
    tree, _ = tree_of(600, 4, 1)
    n, x = tree.nodes, tree.ints.astype(float)
    x = np.column_stack([x, np.sqrt(np.maximum(0, tree.m2 - (x * x).sum(axis=1)))])

    def points(i):
        if not n["children"][i]:
            return list(range(n["point"][i], n["point"][i] + n["points"][i]))
        return [p for c in range(n["child"][i], n["child"][i] + n["children"][i]) for p in points(c)]

    assert sorted(points(0)) == list(range(600))
    for i in range(len(n["centre"])):
        d = np.linalg.norm(x[points(i)] - x[n["centre"][i]], axis=1)
        assert d.max() <= n["radius"][i] + 1e-6 * np.sqrt(tree.m2)
        if n["children"][i]:
            kids = np.arange(n["child"][i], n["child"][i] + n["children"][i])
            assert (n["radius"][kids] <= n["radius"][i] / 2 + 1e-6).all()
            c = x[n["centre"][kids]]
            apart = np.linalg.norm(c[:, None] - c[None], axis=2) + 1e12 * np.eye(len(kids))
            assert apart.min() > n["radius"][i] / 2 - 1e-3


def test_descent_skips_most_of_clustered_data():
    tree, rng = tree_of(4000, 16, 2, clusters=40)
    q = tree.ints[17]
    scores = tree.ints @ q
    best = int(scores.max())
    specs = [Spec(None, None, True, 5), Spec(*hardneg.window(best, 50, 95), False, 3)]
    label = int(tree.labels[17])
    (a, b), scored = tree.search(int(tree.ids[17]), label, q, specs)
    rows = sorted((-s, i) for i, s, lab in zip(tree.ids.tolist(), scores.tolist(), tree.labels.tolist()) if lab == label and i != tree.ids[17])
    assert [(i, s) for i, s in a] == [(i, -s) for s, i in rows[:5]]
    low, high = hardneg.window(best, 50, 95)
    rows = sorted((-s, i) for i, s, lab in zip(tree.ids.tolist(), scores.tolist(), tree.labels.tolist()) if lab != label and low <= s <= high)
    assert [(i, s) for i, s in b] == [(i, -s) for s, i in rows[:3]]
    assert scored < 1500


def test_large_components_stay_exact():
    v = np.array([[10**9, 3], [10**9, 4], [-(10**9), 1], [10**9, 3]], np.int64)
    tree = CoverTree.build(np.arange(4), np.array([0, 0, 1, 1]), v)
    (a,), _ = tree.search(-1, 0, np.array([2, 1], np.int64), [Spec(None, None, True, 2)])
    assert a == [(1, 2 * 10**9 + 4), (0, 2 * 10**9 + 3)]


def test_window_is_exact():
    for score in range(-60, 300):
        low, high = hardneg.window(score, 50, 95)
        for s in range(-80, 320):
            assert (50 * score <= 100 * s <= 95 * score) == (low <= s <= high)
