"""Vector searches against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tessera.llm import ann, queries, topk, vectors

NAN, INF = float("nan"), float("inf")


def brute(ids, x, every, k, score, keep=None):
    out = {}
    for i, q in zip(ids, x):
        if i % every:
            continue
        found = sorted((-score(q, v) if keep == "largest" else score(q, v), j) for j, v in zip(ids, x) if j != i)[:k]
        out[i] = [(j, -s if keep == "largest" else s) for s, j in found]
    return out


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


@pytest.fixture(scope="module")
def table(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    rows = sorted((r["vec_id"], r["embedding"]) for r in df.collect())
    return df, [i for i, _ in rows], np.array([v for _, v in rows], float)


def test_topk_equals_brute_force(spark, sf_small, table):
    _, ids, x = table
    z = np.floor(256 * x).astype(int)
    want = brute(ids, z, 50, 5, lambda a, b: int(a @ b), "largest")
    assert by_query(queries.op10_topk(spark, sf_small)) == want


def lists_of(v):
    return topk.Lists(np.arange(len(v)) * 10, v)


def test_topk_ties_skew_and_large_values():
    rng = np.random.default_rng(0)
    for scale, kind in ((3, np.float32), (10 ** 5, np.float64), (10 ** 9, object), (10 ** 300, object)):
        v = rng.integers(-9, 10, (60, 5)).astype(float) * (scale / 9)
        v[20:30] = v[20]  # ties
        v = topk.integers(v, 1)
        assert topk.exact_type(v, v) is kind
        lists = lists_of(v)
        ids = lists.ids
        a, b, s = topk.top(lists, ids[:9], v[:9], 4)
        for i in range(9):
            want = sorted(((-int(sum(int(p) * int(q) for p, q in zip(v[i], v[j]))), ids[j]) for j in range(60) if j != i))
            clip = lambda x: max(min(x, 2 ** 63 - 1), -2 ** 63)
            want = sorted((-clip(-w), j) for w, j in want)[:4]
            assert [(-w, j) for w, j in want] == list(zip(s[a == i].tolist(), ids[b[a == i]].tolist()))


def test_topk_bounds_hold_at_every_depth():
    rng = np.random.default_rng(1)
    v, q = rng.normal(size=(50, 6)), rng.normal(size=(7, 6))
    lists = lists_of(v)
    exact = q @ v.T
    for depth in (1, 10, 25, 49, 50):
        low, high = lists.read(np.maximum(q, 0), np.minimum(q, 0), depth)
        assert (low <= exact + 1e-9).all() and (exact <= high + 1e-9).all()
        for i in range(7):  # what was read and the rest are the score
            assert np.allclose(lists.rest(q[i], np.arange(50), low[i], depth), exact[i])
    assert np.allclose(low, exact) and np.allclose(high, exact)


def test_reading_stops_early_where_few_components_matter(monkeypatch):
    """With one dominant component the bounds decide before the end, each
    query stops by itself, and only its own survivors are read on."""
    rng = np.random.default_rng(2)
    v = np.round(rng.normal(size=(400, 3)) * [1000, 1, 1])
    q = np.array([[10.0, 1.0, 0.0], [1.0, 1000.0, 1000.0], [-10.0, 0.0, 1.0]])
    asked, depths = [], []
    rest, read = topk.Lists.rest, topk.Lists.read
    monkeypatch.setattr(topk.Lists, "rest", lambda self, w, places, low, depth: asked.append(len(places)) or rest(self, w, places, low, depth))
    monkeypatch.setattr(topk.Lists, "read", lambda self, up, down, depth: depths.append(len(up)) or read(self, up, down, depth))
    a, b, s = topk.top(lists_of(v), np.array([-1, -2, -3]), q, 5)
    for i in range(3):
        assert s[a == i].tolist() == sorted((q[i] @ v.T).tolist(), reverse=True)[:5]
    assert max(asked) < 40 and depths[0] == 3 > depths[-1]
    # the lists decide: sums that are not read are not in the result
    monkeypatch.setattr(topk.Lists, "rest", lambda self, w, places, low, depth: low)
    assert topk.top(lists_of(v), np.array([-1, -2, -3]), q, 5)[2].tolist() != s.tolist()


def test_nearest_recall_and_scores(table):
    df, ids, x = table
    want = brute(ids, x, 100, 10, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())))
    got = by_query(ann.nearest(df))
    assert set(got) == set(want)
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    place = {i: n for n, i in enumerate(ids)}
    for i, rows in got.items():
        assert [s for _, s in rows] == sorted(s for _, s in rows)
        for j, s in rows:
            assert s == pytest.approx(np.linalg.norm(x[place[i]] - x[place[j]]), rel=1e-12)


@pytest.mark.parametrize("width", [8, 16])
@pytest.mark.parametrize("radius", [0, 3, 9, 17, 24, 40, 64])
def test_probing_retrieves_every_code_within_the_radius(radius, width):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 256, 8, dtype=np.uint8)
    codes = np.array([base ^ np.packbits(rng.random(64) < rng.random()) for _ in range(500)])
    index = ann.Index(codes, width)
    want = np.flatnonzero(ann.hamming(codes, base) <= radius)
    assert index.within(base, radius).tolist() == want.tolist()


def test_learned_rotation_is_orthogonal(table):
    _, _, x = table
    coder = ann.learn(x)
    assert np.allclose(coder.turn.T @ coder.turn, np.eye(coder.turn.shape[1]))


ROWS = [(0, [1.0, 0.0]), (100, [1.0, 0.1]), (100, [0.0, 5.0]), (200, None), (300, [NAN, 1.0]), (400, [INF, 1.0]),
        (500, [None, 1.0]), (600, [0.0, 0.0]), (None, [1.0, 1.0]), (700, [1.0, 2.0, 3.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]),
        (3, [-1.0, 0.5])]


def test_odd_vectors(spark):
    df = spark.createDataFrame([(i, v, "x") for i, v in ROWS], "vec_id long, embedding array<float>, id string")
    kept = {0: [1.0, 0.0], 100: [0.0, 5.0], 1: [1.0, 0.0], 2: [1.0, 0.0], 3: [-1.0, 0.5]}
    ids, x = list(kept), np.array(list(kept.values()))
    got = by_query(ann.nearest(df))
    want = brute(ids, x, 100, 10, lambda a, b: float(np.sqrt(((a - b) ** 2).sum())))
    assert {i: [j for j, _ in r] for i, r in got.items()} == {i: [j for j, _ in r] for i, r in want.items()}
    ids, x = [*ids, 600], np.vstack([x, [0.0, 0.0]])
    z = np.floor(256 * x).astype(int)
    assert by_query(topk.search(df)) == brute(ids, z, 50, 5, lambda a, b: int(a @ b), "largest")


def test_empty_and_lonely_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")
    for some in (df, df.limit(0)):
        assert ann.nearest(some).count() == 0 and topk.search(some).count() == 0


def test_blocks_do_not_change_the_result(table, monkeypatch):
    df, _, _ = table
    whole, near = by_query(topk.search(df)), by_query(ann.nearest(df))
    for name, value in (("BLOCK", 64), ("LEAST", 16), ("QUERIES", 3)):
        monkeypatch.setattr(vectors, name, value)
    assert by_query(topk.search(df)) == whole and by_query(ann.nearest(df)) == near


def test_candidates_are_shuffled_once(table, monkeypatch):
    """The rows that reach the tasks are every candidate once and the
    queries once a block, whatever the number of blocks."""
    df, ids, _ = table
    monkeypatch.setattr(vectors, "BLOCK", 50)
    plan = topk.search(df)._jdf.queryExecution().optimizedPlan().toString()
    generated = [x for x in plan.splitlines() if "Generate explode" in x]
    assert len(generated) == 1 and "CoGroup" not in plan


def test_a_third_of_the_rows_with_one_id(spark):
    rng = np.random.default_rng(3)
    rows = [(50, [float(x) for x in rng.normal(size=4)]) for _ in range(100)]
    rows += [(i, [float(x) for x in rng.normal(size=4)]) for i in range(200, 400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    own = [(50, min(v for i, v in rows if i == 50)), *rows[100:]]
    ids, x = [i for i, _ in own], np.array([v for _, v in own])
    assert vectors.one_each(vectors.clean(df)).count() == 201
    z = np.floor(256 * x).astype(int)
    assert by_query(topk.search(df)) == brute(ids, z, 50, 5, lambda a, b: int(a @ b), "largest")


def test_numbers_beyond_doubles(spark):
    rows = [(i, [float(i) * 1e306, 1.0]) for i in (0, 50, 3, 7, -2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_query(topk.search(df))
    assert got[50] == [(3, 2 ** 63 - 1), (7, 2 ** 63 - 1), (0, 65536), (-2, -2 ** 63)]
