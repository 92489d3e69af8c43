"""Skewed and damaged inputs, the store, training and session rules."""

from __future__ import annotations

import math
import os
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import session
from tessera.operators import order as O
from tessera.operators import series as T
from tessera.operators import stats as ST
from tessera.operators.score import MODEL, CentroidModel, score_with
from tessera.operators.windows import window_cells
from tessera.plans import catalog as C
from tessera.plans import tables as TB
from tessera.plans import training
from tessera.plans.pipeline import build_windows, rejections
from tessera.sources import store
from tessera.streaming import consumer as CS
from tessera.streaming import messages as MS

SPEC = T.SeriesSpec(key=("sid",), sensors=("a", "b"), ts="ts", axes=("x", "y"), period=10, min_overlap=10, bucket=5000)
SCHEMA = "sid string, sensor string, ts long, x double, y double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def readings(spark, sid, stamps):
    return [(sid, s, t, math.sin(t), float(t)) for t in stamps for s in ("a", "b")]


# ---- series ------------------------------------------------------------

def test_a_complete_reading_wins_over_one_with_a_null(spark):
    rows = [("s", "a", 5, 1.0, None), ("s", "a", 5, 7.0, 2.0), ("s", "a", 5, 8.0, 1.0), ("s", "a", 6, None, None),
            ("s", "a", 6, None, 3.0), ("s", "a", 6, 4.0, None)]
    got = {r["ts"]: (r["x"], r["y"]) for r in T.dedupe(spark.createDataFrame(rows, SCHEMA), SPEC).collect()}
    assert got == {5: (7.0, 2.0), 6: (4.0, None)}


def test_one_far_off_reading_leaves_the_other_series_as_they_are(spark):
    """With a limit of grid points per reading its series is turned away."""
    spec = replace(SPEC, max_fill=100_000)
    good = readings(spark, "good", range(0, 2000, 7))
    bad = readings(spark, "bad", [0, 10, 20, 10 ** 15])

    def windows(rows):
        res = build_windows(spark.createDataFrame(rows, SCHEMA), spec, size=24, step=12)
        return ({(r["sid"], r["k"]): tuple(r["features"]) for r in res.windows.collect()},
                {r["sid"]: r["reason"] for r in rejections(res.bounds, spec).collect()})

    alone, none = windows(good)
    both, rejected = windows(good + bad)
    assert alone and both == alone and not none and rejected == {"bad": "sparse"}


def test_a_stored_grid_with_errors_is_found_out(spark):
    rows = [(k, s, t, math.sin(t / 900), float(t)) for k in ("u", "v") for s in ("a", "b")
            for t in [*range(0, 9000, 37), *range(31000, 40000, 11)]]  # a gap over several buckets
    dd = T.dedupe(T.with_bucket(spark.createDataFrame(rows, SCHEMA), SPEC), SPEC)
    bounds = T.classify(T.overlap_bounds(dd, SPEC), SPEC)
    grid, ok = T.resample(dd, SPEC, bounds), T.eligible(bounds, SPEC)
    for r in T.interpolation_error(grid, dd, ok, SPEC).collect():
        assert r["max_err_x"] < 1e-9 and r["max_err_y"] < 1e-6 and r["n_points"] == 3999
    wrong = grid.withColumn("x", F.when((F.col("sid") == "u") & (F.col("i") == 2000), F.col("x") + 0.25).otherwise(F.col("x")))
    got = {(r["sid"], r["sensor"]): r["max_err_x"] for r in T.interpolation_error(wrong, dd, ok, SPEC).collect()}
    assert got["u", "a"] == pytest.approx(0.25) and got["v", "a"] < 1e-9


def test_tasks_of_the_grid_check_follow_from_its_times(spark, monkeypatch):
    rows = [(k, s, t, math.sin(t / 900), float(t)) for k in ("u", "v") for s in ("a", "b") for t in range(0, 9000, 37)]
    dd = T.dedupe(T.with_bucket(spark.createDataFrame(rows, SCHEMA), SPEC), SPEC)
    ok = T.eligible(T.classify(T.overlap_bounds(dd, SPEC), SPEC), SPEC)
    grid = T.resample(dd, SPEC)
    points = 2 * sum(r["n"] for r in ok.collect())
    monkeypatch.setattr(T, "ERROR_POINTS", 90)
    e = T.interpolation_error(grid, dd, ok, SPEC)
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert f", {-(-points // 90)}), REPARTITION_BY_NUM" in plan
    got = e.collect()
    assert len(got) == 4 and sum(r["n_points"] for r in got) == points and max(r["max_err_x"] for r in got) < 1e-9


def test_ranges_are_expanded_in_bounded_steps(spark, monkeypatch):
    monkeypatch.setattr(T, "EXPAND", 7)
    df = spark.createDataFrame([(0, 20), (5, 5), (13, 29)], "lo long, hi long")
    got = sorted(tuple(r) for r in T.explode_range(df, F.col("lo"), F.col("hi"), "i").collect())
    assert got == sorted((lo, hi, i) for lo, hi in [(0, 20), (5, 5), (13, 29)] for i in range(lo, hi + 1))


def test_any_rate_gives_an_exact_grid(spark):
    spec = T.SeriesSpec.for_rate(30, 10 ** 9, key=("sid",), sensors=("a",), ts="ts", axes=("x",))
    b = spark.createDataFrame([("s", 9, 0, 10 ** 9, 0, 10 ** 9)], "sid string, n_a long, min_a long, max_a long, a long, b long")
    assert T.classify(b, spec).first()["n"] == 30
    assert T.SeriesSpec.for_rate(50, 10 ** 9).period == 20_000_000


def test_every_event_is_a_reading_or_a_counted_rejection(spark, sf_small):
    events = TB.table(spark, sf_small, "events")
    lost = TB.rejected_events(events).agg(F.sum("n_rows")).first()[0] or 0
    assert C._readings(spark, sf_small).count() + lost == events.count()


# ---- statistics --------------------------------------------------------

def test_values_that_most_rows_share_fill_no_partition(spark):
    long = spark.range(60_000).select(F.lit("c").alias("channel"),
                                      F.when(F.col("id") % 10 < 9, 0.0).otherwise(F.col("id").cast("double")).alias("value"))
    r = ST.counted_values(long, ["channel"])
    sizes = [x["count"] for x in r.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 6001 and r.agg(F.sum("c")).first()[0] == 60_000
    values = np.array([x["value"] for x in long.collect()])
    got = {x["p"]: x["q"] for x in ST.exact_quantiles(long, ["channel"], [0.0, 0.25, 0.9, 0.95, 0.999, 1.0]).collect()}
    for p, q in got.items():
        assert q == pytest.approx(np.quantile(values, p))


def test_quantiles_skip_null_and_nan(spark):
    rows = [("a", v) for v in (1.0, None, float("nan"), 3.0, 3.0)] + [("b", 5.0), ("c", None)]
    got = {(r["channel"], r["p"]): r["q"] for r in ST.exact_quantiles(
        spark.createDataFrame(rows, "channel string, value double"), ["channel"], [0.25, 0.5]).collect()}
    assert got == {("a", 0.25): 2.0, ("a", 0.5): 3.0, ("b", 0.25): 5.0, ("b", 0.5): 5.0}


def test_automatic_bins_equal_numpy(spark):
    rng = np.random.default_rng(0)
    data = {"n": rng.normal(size=500), "e": rng.exponential(size=900), "c": np.ones(20)}
    long = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs], "channel string, value double")
    got = {r["channel"]: r["bins"] for r in ST.automatic_bins(long).collect()}
    for k, vs in data.items():
        assert got[k] == len(np.histogram_bin_edges(vs, "auto")) - 1


def test_channel_statistics_gather_no_window(spark, sf_small):
    for q in (C.q_channel_stats, C.q_histogram, C.q_corr_matrix, C.q_array_summary, C.q_finite_check, C.q_standardize):
        assert "collect_list" not in plan(q(spark, sf_small))


def test_sample_of_everything_keeps_everything(spark):
    assert O.hash_sample(spark.range(500), 1.0, 1, "id").count() == 500
    assert O.hash_sample(spark.range(500), 0.0, 1, "id").count() == 0
    assert all("f" * 13 < O.hash_threshold(f) for f in (1.0, 1.5))


# ---- scoring and training ----------------------------------------------

def test_model_of_many_classes(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("label"),
                                  F.array(F.col("id").cast("double"), F.lit(1.0)).alias("features"))
    assert CentroidModel.fit(df).n_classes == 3000


def test_score_with_hands_over_floats_and_keeps_the_session(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    df = spark.range(50).select("id", F.array(F.col("id").cast("double"), F.lit(0.5)).alias("features"))

    def fn(x):
        assert x.dtype == np.float32 and len(x) <= 8
        return np.stack([x[:, 0], -x[:, 0]], axis=1)

    rows = score_with(df, fn, 2, batch_rows=8).collect()
    assert sorted(r["logits"][0] for r in rows) == list(map(float, range(50)))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_training_on_subjects_predicts_the_others(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(f"s{s}", c, i, 240, float(rng.normal(3 * "AB".index(c), 1)), float(rng.normal()))
            for s in range(10) for c in "AB" for i in range(240)]
    aligned = spark.createDataFrame(rows, "subject_id string, label string, i long, n long, ax double, gx double")
    cells = window_cells(aligned, ["subject_id", "label"], ["ax", "gx"], 24, 12)
    features = training.window_features(cells, ["subject_id", "label"], ["ax", "gx"])
    split = O.subject_split(features)
    train = features.join(split.where("split = 'train'"), "subject_id", "left_semi")
    held = features.join(split.where("split = 'train'"), "subject_id", "left_anti")
    assert train.count() and held.count()
    model = training.fit(train, ["ax", "gx"])
    assert training.accuracy(model, held) > 0.95
    loss = training.history(model)
    assert len(loss) > 2 and loss[-1] < loss[0]
    training.save(model, str(tmp_path / "model"))
    again = training.load(spark, str(tmp_path / "model"))
    assert training.accuracy(again, held) == training.accuracy(model, held)


def test_epochs_differ(spark, sf_small):
    assert len({r["tr_loss"] for r in C.q_epoch_metrics(spark, sf_small).collect()}) == 3


def test_splitting_windows_leaks_and_splitting_subjects_does_not(spark, sf_small):
    leaking = {r["split_by"]: r["n_leaking"] for r in C.q_split_leakage(spark, sf_small).collect()}
    assert leaking["subject"] == 0 and leaking["window"] > 0


# ---- streams -----------------------------------------------------------

def test_only_messages_of_the_right_shape_count(spark, tmp_path):
    good = '{"device":"phone","subject_id":"s","activity":"A","features":[[0.0,0.0],[1.0,1.0]],"seq":%d}'
    lines = [good % 0, good % 1, (good % 2).replace("[0.0,0.0]", "[0.0]"), (good % 3).replace("[0.0,0.0],", ""),
             (good % 4).replace("[0.0,0.0]", "[null,0.0]"), (good % 5).replace("[[0.0,0.0],[1.0,1.0]]", "[]"),
             (good % 6).replace('"activity":"A",', ""), "{bad", "", (good % 7).replace("[0.0,0.0]", "null")]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / "m"))
    model = CentroidModel.of(spark.createDataFrame([(0, "A", [0.0, 0.0, 1.0, 1.0]), (1, "B", [5.0, 5.0, 5.0, 5.0])], MODEL))
    decoded = MS.decode(spark.read.text(str(tmp_path / "m")), 2, 2)
    assert [r["seq"] for r in decoded.where("valid").orderBy("seq").collect()] == [0, 1]
    scored = CS.score_messages(MS.decode(MS.read_files(spark, str(tmp_path / "m")), 2, 2), model, 2)
    q, log = CS.run_update(spark, CS.accuracy_state(scored, ["device"]), "t-shapes", ["device"])
    q.awaitTermination()
    (r,) = CS.read_changelog(spark, log, ["device"]).collect()
    assert r["total"] == 2
    q, out = CS.run_append(spark, CS.dead_letters(MS.decode(MS.read_files(spark, str(tmp_path / "m")), 2, 2)), "t-dead")
    q.awaitTermination()
    assert sorted(x["value"] for x in spark.read.parquet(out).collect()) == sorted(lines[2:])


# ---- store and session -------------------------------------------------

def test_store(spark, tmp_path):
    base = str(tmp_path / "slice_025")
    df = spark.range(25).select("id", F.array(F.lit(1.0)).alias("features"))
    store.write_windows(df, f"{base}/a.parquet", rows_per_file=10)
    assert len([f for f in os.listdir(f"{base}/a.parquet") if f.endswith(".parquet")]) >= 3
    for name in ("slice_024.parquet", "slice_025.parquet"):
        df.coalesce(1).write.parquet(f"{base}/{name}.d")
        (part,) = [f for f in os.listdir(f"{base}/{name}.d") if f.endswith(".parquet")]
        os.makedirs(f"{base}/files", exist_ok=True)
        os.link(f"{base}/{name}.d/{part}", f"{base}/files/{name}")
    # the folder's name holds the excluded word, only one file's name does
    got = store.read_parquet_excluding(spark, f"{base}/files/*.parquet", "025")
    assert got.count() == 25
    assert store.read_parquet_excluding(spark, f"{base}/files/*.parquet").count() == 50
    for args in ((f"{base}/none/*.parquet",), (f"{base}/files/*.parquet", "slice")):
        with pytest.raises(FileNotFoundError):
            store.read_parquet_excluding(spark, *args)
    pred = spark.createDataFrame([(1, 1, 0.9, 0.1)], "y_true int, y_pred int, confidence double, xentropy double")
    thr = spark.createDataFrame([(0.1,)], "threshold_95 double")
    store.save_validation(pred, thr, f"{base}/val")
    p, t = store.load_validation(spark, f"{base}/val")
    assert p.collect() == pred.collect() and t.collect() == thr.collect()


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        session.checkpoint_dir(Session)
