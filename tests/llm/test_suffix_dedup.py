"""Repeated passages against a dictionary of all windows."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import queries, suffix_dedup


def twin(texts, span):
    """The runs that go, by counting every window."""
    texts = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - span + 1):
            if count[t[i:i + span]] > 1:
                gone[i:i + span] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone])))
        out.append((len(t), list(zip(edges[::2].tolist(), edges[1::2].tolist())), bytes(b for b, g in zip(t, gone) if not g)))
    return out


def found(df, **more):
    return sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"]))
                  for r in suffix_dedup.remove(df, **more).collect())


def wanted(rows, span):
    return sorted(((i is not None, i or 0), n, spans, kept)
                  for (i, _), (n, spans, kept) in zip(rows, twin([t for _, t in rows], span)))


def test_query_equals_counting_all_windows(spark, sf_small, texts):
    ids = sorted(texts)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_suffix_dedup(spark, sf_small).collect()}
    want = {i: (n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest())
            for i, (n, spans, kept) in zip(ids, twin([texts[i] for i in ids], 400))}
    assert got == want and sum(n for _, n, _, _ in want.values()) > 0


@pytest.fixture(scope="module")
def passages():
    rng = np.random.default_rng(7)
    word = ["".join(rng.choice(list("aeioukstné"), rng.integers(1, 9))) for _ in range(60)]
    text = lambda n: " ".join(rng.choice(word, n))
    common, other = text(30), text(25)
    rows = [(i, text(rng.integers(0, 40))) for i in range(60)]
    rows += [(100 + i, f"{text(rng.integers(0, 9))} {common} {text(rng.integers(0, 9))}") for i in range(120)]
    rows += [(300 + i, common[:i * 3] + other + common[i:]) for i in range(40)]
    rows += [(400 + i, rows[0][1]) for i in range(70)]  # a hot group of copies
    rows += [(500, "ab" * 900), (501, "x" * 1500), (502, "b" + "ab" * 60), (None, other), (None, None), (503, ""), (503, other),
             (503, other), (504, "é" * 50), (505, "y" * 63), (506, "z" * 64)]
    return rows


@pytest.mark.parametrize("limits", [{}, {"SHARD": 600, "PIECE": 200, "MERGED": 50, "HOT": 5}])
def test_small_windows_equal_counting(spark, monkeypatch, passages, limits):
    """Split anchors, pieces, ranges and hot texts do not change the result."""
    for name, value in limits.items():
        monkeypatch.setattr(suffix_dedup, name, value)
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in passages], "doc_id long, text string, a int, kept string")
    assert found(df, span=64, gram=8) == wanted(passages, 64)


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert found(df) == []
    assert found(spark.createDataFrame([(1, "a" * 399), (2, None)], df.schema)) == [
        ((True, 1), 399, [], b"a" * 399), ((True, 2), 0, [], b"")]


@pytest.mark.parametrize("letters", [1, 2, 4, 255])
def test_suffix_arrays_and_common_prefixes(letters):
    rng = np.random.default_rng(letters)
    for n in (1, 7, 100, 3000):
        x = rng.integers(1, letters + 1, n).astype(np.uint8)
        if n > 50:
            x[n // 2:n // 2 + 45] = x[:45]
            x[-100:] = x[:100]
        b = x.tobytes()
        sa, first = suffix_dedup.suffix_array(x, 64)
        heads = [b[i:i + 64] for i in sa]
        assert sorted(sa.tolist()) == list(range(n)) and heads == sorted(heads)
        got = suffix_dedup.common_prefixes(x, sa, first, 64)
        for r in range(1, n):
            p, q, k = int(sa[r - 1]), int(sa[r]), 0
            while k < 64 and max(p, q) + k < n and b[p + k] == b[q + k]:
                k += 1
            assert got[r] == k


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, 4000).astype(np.uint8)
    _, whole = suffix_dedup.anchors(x, 400, 32)
    for i in (0, 17, 999, 3600):
        _, alone = suffix_dedup.anchors(x[i:i + 400], 400, 32)
        assert len(alone) == 1 and whole[i] == i + alone[0]


def test_merging_adds_the_runs():
    rng = np.random.default_rng(2)
    runs, total = [], Counter()
    for run in range(5):
        keys = sorted(rng.choice(200, 80, replace=False).tolist(), key=lambda k: (k % 3, k))
        r = np.zeros(80, suffix_dedup.CLASS)
        r["high"], r["low"] = [(k % 3) << 62 for k in keys], keys
        r["weight"], r["a"], r["c"], r["offset"] = rng.integers(1, 3, 80), run, keys, range(80)
        runs.append(r)
        for k, w in zip(keys, r["weight"].tolist()):
            total[k] += w
    want = [(int(x["a"]), int(x["c"]), int(x["offset"])) for r in runs for x in r if x["weight"] < 2 and total[int(x["c"])] > 1]
    got = suffix_dedup.merge(pa.table({"run": [r.tobytes() for r in runs]})).to_pylist()
    assert [tuple(x.values()) for x in got] == want and want


def test_no_shard_grows_far_over_its_size(spark, monkeypatch, passages):
    """Anchors that fill a shard or an eighth of one share it with no other."""
    judge, size = suffix_dedup.shard, 2048

    def bounded(span, ranges):
        run = judge(span, ranges)

        def checked(table):
            if sum(map(len, table.column("bytes").to_pylist())) > 2 * size:
                raise ValueError("a shard is too large")
            return run(table)

        return checked

    monkeypatch.setattr(suffix_dedup, "SHARD", size)
    monkeypatch.setattr(suffix_dedup, "shard", bounded)
    df = spark.createDataFrame(passages, "doc_id long, text string")
    assert found(df, span=64, gram=8) == wanted(passages, 64)
