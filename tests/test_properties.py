"""Property tests (hypothesis) and scorer equivalence."""

from __future__ import annotations

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import order as O
from tessera.operators import running as RN
from tessera.operators import score as SC
from tessera.operators import series as T


@settings(max_examples=8, deadline=None)
@given(n=st.integers(0, 400), size=st.integers(1, 60), step=st.integers(1, 60))
def test_window_count_formula(spark, n, size, step):
    from tessera.operators.windows import window_ids
    df = spark.range(n).select(F.col("id").alias("i"), F.lit(n).cast("long").alias("n"))
    got = df.select(F.explode(window_ids(F.col("i"), F.col("n"), size, step)).alias("k")).distinct().count()
    expected = max(0, (n - size) // step + 1) if n >= size else 0
    assert got == expected


@settings(max_examples=5, deadline=None)
@given(a=st.floats(-5, 5), b=st.floats(-5, 5), gaps=st.lists(st.integers(1, 400_000_000), min_size=2, max_size=12))
def test_resample_line_is_the_line(spark, a, b, gaps):
    ts = [0]
    for g in gaps:
        ts.append(ts[-1] + g)
    if ts[-1] < 1_000_000_000:
        ts.append(1_000_000_000 + ts[-1])
    rows = [("s", 0, "A", s, t, a * t / 1e9 + b, 0.0, 0.0) for s in ("accel", "gyro") for t in ts]
    rd = spark.createDataFrame(rows, "subject_id string, device int, activity string, sensor string, "
                                     "timestamp long, x double, y double, z double")
    spec = T.SeriesSpec()
    g = T.resample(T.dedupe(T.cluster(rd, spec), spec), spec).where("sensor = 'accel'").collect()
    lo, hi = ts[0], ts[-1]
    n = (hi - lo) // spec.period
    assert sorted(r["i"] for r in g) == list(range(n))
    for r in g:
        t = lo + r["i"] * (hi - lo) / (n - 1)
        assert math.isclose(r["x"], a * t / 1e9 + b, abs_tol=1e-9)


def test_split_disjoint_and_complete(spark):
    subs = spark.range(137).select(F.col("id").cast("string").alias("subject_id"))
    sp = O.subject_split(subs)
    assert sp.count() == 137 and sp.select("subject_id").distinct().count() == 137


def test_global_rank_is_a_permutation(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    r = O.global_rank(df, ["v"], "rank").collect()
    assert sorted(x["rank"] for x in r) == list(range(1000))
    assert all(x["rank"] == x["v"] for x in r)


def test_running_sum_matches_python(spark):
    rows = [(k, i, (i * 31 + k) % 2 == 0) for k in range(3) for i in range(200)]
    df = spark.createDataFrame(rows, "key int, seq int, correct boolean").repartition(5)
    out = RN.running_accuracy(df, ["key"], ["seq"]).collect()
    for r in out:
        seen = [x for x in rows if x[0] == r["key"] and x[1] <= r["seq"]]
        assert r["n_seen"] == len(seen) and r["n_correct"] == sum(x[2] for x in seen)


def test_pandas_scorer_equals_jvm(spark):
    rows = [("a", [0.0, 1.0, 2.0]), ("a", [0.5, 1.0, 2.5]), ("b", [3.0, 3.0, 3.0]), ("c", [-1.0, 0.0, 9.0])]
    df = spark.createDataFrame(rows, "label string, features array<double>")
    model = SC.CentroidModel.fit(df, "features", "label")
    jvm = model.with_logits(df).select("label", "logits").collect()
    py = SC.score_with(df, SC.centroid_fn(model), 3, "features", ["label"]).collect()
    for a, b in zip(sorted(jvm, key=str), sorted(py, key=str)):
        assert all(math.isclose(x, y, abs_tol=1e-12) for x, y in zip(a["logits"], b["logits"]))


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", [0.0, 1.0]), ("b", [2.0, 2.0])], "label string, features array<double>")
    m = SC.CentroidModel.fit(df, "features", "label")
    m.save(str(tmp_path / "m"))
    m2 = SC.CentroidModel.load(spark, str(tmp_path / "m"))
    assert sorted(m2.table.collect()) == sorted(m.table.collect()) == [(0, "a", [0.0, 1.0]), (1, "b", [2.0, 2.0])]
    assert (m2.n_classes, m2.dims) == (2, 2)
