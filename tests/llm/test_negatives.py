"""Hard negatives against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tessera.llm import negatives

NAN, INF = float("nan"), float("inf")


def brute(rows, every=100, k=5, n=10, lower=30, upper=90, scale=256):
    """Plain twin: ``rows`` of id, label and integer vector."""
    out = []
    for i, label, q in rows:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j, other) for j, other, v in rows if j != i)
        for p, j, _ in [s for s in scored if s[2] == label][:k]:
            fit = [(s, m) for s, m, other in scored if other != label and lower * -p <= 100 * -s <= upper * -p]
            out += [(i, j, rank + 1, m, -p, -s) for rank, (s, m) in enumerate(fit[:n])]
    return sorted(out)


def whole(x, scale=256):
    return [int(v) for v in np.floor(scale * np.asarray(x, float))]


def found(df, **more):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in negatives.mine(df, **more).select(*columns).collect())


@pytest.mark.parametrize("kind", ["random", "clustered", "tied"])
def test_equals_brute_force(spark, monkeypatch, kind):
    """Small blocks, strides and batches of members."""
    for name, value in (("BLOCK", 150), ("LEAST", 40), ("MEMBERS", 7), ("STRIDE", 16)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(4)
    n = 700
    x = rng.normal(size=(n, 6)).astype(np.float32)
    if kind == "clustered":
        x = (rng.normal(size=(9, 6))[rng.integers(0, 9, n)] * 3 + 0.2 * x).astype(np.float32)
    if kind == "tied":
        x = rng.integers(-1, 2, (n, 6)).astype(np.float32)
        x[: n // 3] = x[0]  # a third of all rows are one vector
    label = np.where(rng.random(n) < 0.4, 3, rng.integers(0, 5, n))
    ids = rng.permutation(n) * 5
    rows = [(int(i), int(c), [float(z) for z in v]) for i, c, v in zip(ids, label, x)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert found(df) == brute([(i, c, whole(v)) for i, c, v in rows]) != []


def test_odd_rows(spark):
    rows = [(0, 1, [1.0, 0.0]), (100, 1, [1.0, 0.5]), (100, 1, [2.0, 0.0]), (7, 2, [0.5, 0.0]), (8, 2, [0.6, 9.0]),
            (9, 3, [0.0, 0.0]), (None, 1, [1.0, 0.0]), (10, None, [1.0, 0.0]), (11, 1, None), (12, 2, [NAN, 1.0]),
            (13, 2, [INF, 1.0]), (14, 2, [None, 1.0]), (15, 2, [1.0, 2.0, 3.0]), (200, 9, [1.0, 1.0]), (16, 2, [0.5, 0.0]),
            (16, 2, [0.5, 0.0]), (300, 2, [-1.0, 0.0]), (400, 3, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, label int, embedding array<double>, id string, cluster int")
    kept = {0: (1, [1.0, 0.0]), 100: (1, [1.0, 0.5]), 7: (2, [0.5, 0.0]), 8: (2, [0.6, 9.0]), 9: (3, [0.0, 0.0]),
            200: (9, [1.0, 1.0]), 16: (2, [0.5, 0.0]), 300: (2, [-1.0, 0.0]), 400: (3, [0.0, 0.0])}
    assert found(df) == brute([(i, c, whole(v)) for i, (c, v) in kept.items()]) != []


def test_values_beyond_doubles(spark):
    rng = np.random.default_rng(5)
    rows = [(i * 20, int(i % 3), [float(z) for z in rng.integers(-9, 10, 3) * 10.0 ** 6]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert found(df) == brute([(i, c, whole(v)) for i, c, v in rows]) != []
    huge = spark.createDataFrame([(0, 1, [1e307]), (1, 1, [1e307]), (2, 2, [5e306])],
                                 "vec_id long, label int, embedding array<double>")
    assert found(huge) == []  # clipped scores are equal: outside the band


def test_empty_and_lonely(spark):
    df = spark.createDataFrame([(0, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert found(df) == found(df.limit(0)) == []


def test_bounds_hold_and_end_the_walk():
    rng = np.random.default_rng(6)
    z = np.floor(256 * rng.normal(size=(4000, 8)) * rng.lognormal(0, 1.5, (4000, 1)))
    q = np.floor(256 * (rng.normal(size=8) + 0.05 * rng.normal(size=(20, 8))))
    block = negatives.Block(np.arange(4000), np.zeros(4000, int), z)
    order, bound = block.ranked(q)
    assert (np.diff(bound) <= 0).all()
    assert (q @ z[order].T <= bound * negatives.lengths(q)[:, None] + 1e-6).all()
    # the walk gives the same when every list but the needed beginning is wrong
    want = np.sort(q @ z.T, axis=1)[:, -5:]
    need = max(int((bound * negatives.lengths(q)[i] >= want[i, 0]).sum()) for i in range(20))
    assert need < 2000
    spoiled = z.copy()
    spoiled[order[need + negatives.STRIDE:]] = 1e9
    walked = negatives.Block(np.arange(4000), np.zeros(4000, int), spoiled)
    walked.ranked = lambda members: (order, bound)
    m, _, _, s = negatives.walk(walked, np.full(20, -1), np.zeros(20, int), q, 5, True)
    for i in range(20):
        assert sorted(s[m == i])[-5:] == want[i].tolist()
