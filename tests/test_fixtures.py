"""Hand-made edge cases (FIXTURES.md section 2)."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import lookup as L
from tessera.operators import metrics as M
from tessera.operators import order as O
from tessera.operators import series as T
from tessera.operators.windows import finite_windows, sliding_windows, windows_from_grid, zscore_features
from tessera.sources import sensor_files as SF
from tessera.streaming import messages as MS

SPEC = T.SeriesSpec()  # 50 Hz on ns, x/y/z, accel+gyro


def _write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture()
def raw_dir(tmp_path):
    base = tmp_path / "raw"
    _write(base / "phone" / "accel" / "data_1600_accel_phone.txt", [
        "1600,A,100,1.0,2.0,3.5;",
        "1600,A,101,1.0E-4,2.0,9.5E-4;",
        "1600,A,102,bad,2.0,3;",
        "1600,A,103",
        "1600,B,104,1,2,3;,extra",
        "1600,B,105,1,2,-;",
    ])
    _write(base / "phone" / "gyro" / "data_1600_gyro_phone.txt", ["1600,A,100,0,0,0;"])
    return str(base)


def test_csv_cleaning(spark, raw_dir):
    r = {row["timestamp"]: row for row in SF.readings(spark, raw_dir).where("sensor = 'accel'").collect()}
    assert r[100]["z"] == 3.5
    assert r[101]["x"] == 1.0e-4 and r[101]["z"] is None       # exponent stripped -> NULL
    assert 102 not in r and 103 not in r                          # bad x, short line dropped
    assert r[104]["z"] == 3.0                                     # extra field ignored
    assert r[105]["z"] is None                                    # sign only
    assert r[100]["device"] == 0 and r[100]["subject_id"] == "1600"


def test_keep_exponent(spark, raw_dir):
    r = {row["timestamp"]: row for row in SF.readings(spark, raw_dir, keep_exponent=True).collect()}
    assert math.isclose(r[101]["z"], 9.5e-4)


def test_inventory(spark, raw_dir):
    inv = {(r["device_name"], r["sensor"]): r for r in SF.inventory(spark, raw_dir).collect()}
    assert inv[("phone", "accel")]["files"] == 1 and not inv[("phone", "accel")]["missing"]
    assert inv[("watch", "gyro")]["missing"] and inv[("watch", "gyro")]["files"] == 0


def _readings(spark, rows):
    return spark.createDataFrame(rows, "subject_id string, device int, activity string, sensor string, "
                                       "timestamp long, x double, y double, z double")


def test_duplicate_timestamp_keeps_smallest_row(spark):
    rd = _readings(spark, [("s", 0, "A", "accel", 5, 2.0, 0.0, 9.0), ("s", 0, "A", "accel", 5, 1.0, 7.0, 8.0)])
    out = T.dedupe(T.cluster(rd, SPEC), SPEC).collect()
    assert len(out) == 1 and (out[0]["x"], out[0]["y"], out[0]["z"]) == (1.0, 7.0, 8.0)


def _pair(spark, accel_ts, gyro_ts, key="s"):
    rows = [(key, 0, "A", "accel", t, float(t) / 1e9, 0.0, 0.0) for t in accel_ts]
    rows += [(key, 0, "A", "gyro", t, 0.0, float(t) / 1e9, 0.0) for t in gyro_ts]
    return _readings(spark, rows)


def test_rejections(spark):
    rd = _pair(spark, [0], [0, 10], "one").unionByName(
        _pair(spark, [0, 999_999_999], [0, 999_999_999], "short")).unionByName(
        _pair(spark, [0, 1_000_000_000], [0, 1_000_000_000], "ok")).unionByName(
        _pair(spark, [0, 5], [], "missing"))
    dd = T.dedupe(T.cluster(rd, SPEC), SPEC)
    b = {r["subject_id"]: r for r in T.classify(T.overlap_bounds(dd, SPEC), SPEC).collect()}
    assert b["one"]["reason"] == "too_few_samples"
    assert b["short"]["reason"] == "short_overlap"
    assert b["ok"]["reason"] is None and b["ok"]["n"] == 50
    assert b["missing"]["reason"] == "missing_sensor"


def test_grid_point_on_reading_and_line(spark):
    # line through (0, 0) and (2e9, 2): every grid value is t/1e9
    rd = _pair(spark, [0, 2_000_000_000], [0, 700_000_000, 2_000_000_000])
    dd = T.dedupe(T.cluster(rd, SPEC), SPEC)
    g = T.resample(dd, SPEC).where("sensor = 'accel'").orderBy("i").collect()
    n = 100
    assert [r["i"] for r in g] == list(range(n))
    for r in g:
        assert math.isclose(r["x"], 2.0 * r["i"] / (n - 1), abs_tol=1e-12)
    assert g[0]["x"] == 0.0 and g[-1]["x"] == 2.0


def test_bucketed_segments_equal_unbucketed(spark):
    ts = [0, 300_000_000, 900_000_000, 1_500_000_000, 2_600_000_000, 4_000_000_000]
    rd = _pair(spark, ts, ts)
    small = T.SeriesSpec(bucket=700_000_000)  # forces segments across bucket edges and an empty bucket
    a = T.resample(T.dedupe(T.cluster(rd, SPEC), SPEC), SPEC).orderBy("sensor", "i").collect()
    b = T.resample(T.dedupe(T.cluster(rd, small), small), small).orderBy("sensor", "i").collect()
    assert [(r["sensor"], r["i"]) for r in a] == [(r["sensor"], r["i"]) for r in b]
    for ra, rb in zip(a, b):
        assert math.isclose(ra["x"], rb["x"], abs_tol=1e-12) and math.isclose(ra["y"], rb["y"], abs_tol=1e-12)


@pytest.mark.parametrize("n,expected", [(99, 0), (100, 1), (149, 1), (150, 2)])
def test_window_counts(spark, n, expected):
    al = spark.range(n).select(F.lit("s").alias("key"), F.col("id").alias("i"), F.lit(n).cast("long").alias("n"),
                               F.col("id").cast("double").alias("c"))
    w = sliding_windows(al, ["key"], ["c"], 100, 50).collect()
    assert len(w) == expected
    for r in w:
        assert r["features"] == [float(r["k"] * 50 + j) for j in range(100)]


def test_finite_filter(spark):
    df = spark.createDataFrame([(1, [1.0, float("nan")]), (2, [1.0, float("inf")]), (3, [1.0, None]), (4, [1.0, 2.0])],
                               "id int, features array<double>")
    assert [r["id"] for r in finite_windows(df).collect()] == [4]
    assert sorted(r["id"] for r in finite_windows(df, check_inf=False).collect()) == [2, 4]


def test_constant_channel_zscore(spark):
    df = spark.createDataFrame([([5.0, 1.0, 5.0, 2.0, 5.0, 3.0],)], "features array<double>")
    z = zscore_features(df, 2).first()["features"]
    assert z[0] == 0.0 and z[2] == 0.0 and z[4] == 0.0
    assert math.isclose(z[1], -1.0 / (math.sqrt(2 / 3) + 1e-5))


def test_fused_windows_match_two_step(spark):
    ts = list(range(0, 4_100_000_000, 37_000_000))  # n = 203 -> 3 windows
    rd = _pair(spark, ts, ts[::2])
    dd = T.dedupe(T.cluster(rd, SPEC), SPEC)
    g = T.resample(dd, SPEC)
    fused = {r["k"]: r["features"] for r in windows_from_grid(g, SPEC, 100, 50).collect()}
    two = {r["k"]: r["features"] for r in sliding_windows(T.align(g, SPEC), list(SPEC.key), SPEC.channels, 100, 50)
           .collect()}
    assert fused.keys() == two.keys() and len(fused) == 3
    for k in fused:
        assert fused[k] == two[k]
    z1 = {r["k"]: r["features"] for r in windows_from_grid(g, SPEC, 100, 50, zscore=True).collect()}
    z2 = {r["k"]: r["features"] for r in zscore_features(
        sliding_windows(T.align(g, SPEC), list(SPEC.key), SPEC.channels, 100, 50), 6).collect()}
    for k in z1:
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(z1[k], z2[k]))


def test_codes(spark):
    df = spark.createDataFrame([("N",), (" A ",), ("B",)], "code string")
    out = df.select(L.code_to_name(L.trim_code("code")).alias("n")).collect()
    assert [r["n"] for r in out] == ["Unknown (N)", "Walking", "Jogging"]


def test_resolve_classes(spark):
    df = spark.createDataFrame([(0, "A"), (1, "Walking"), (2, "Fast Jogging"), (3, "zzz")], "idx int, name string")
    out = df.select(L.resolve_class("name", "idx").alias("l")).collect()
    assert [r["l"] for r in out] == ["A", "A", "B", "Class-3"]


def test_absent_class_metrics(spark):
    classes = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "idx int, class_name string")
    pred = spark.createDataFrame([(0, 0), (1, 0), (1, 1)], "y_true int, y_pred int")
    acc = {r["idx"]: r["accuracy"] for r in M.per_class_accuracy(pred, classes).collect()}
    assert acc == {0: 1.0, 1: 0.5, 2: 0.0}
    rep = {r["class_name"]: r for r in M.classification_report(pred, classes).collect()}
    assert rep["c"]["support"] == 0 and rep["c"]["precision"] == 0.0
    cm = M.confusion_long(pred, classes).collect()
    assert len(cm) == 9 and sum(r["count"] for r in cm) == 3


def test_dead_letter(spark):
    raw = spark.createDataFrame([("{bad",), ('{"device":"phone","subject_id":"1","activity":"A",'
                                            '"features":[[1.0],[2.0]],"seq":0}',)], "value string")
    d = MS.decode(raw)
    assert d.where("valid").count() == 1 and d.where("NOT valid").count() == 1


@pytest.mark.parametrize("n,sizes", [(51, (41, 5, 5)), (9, (8, 0, 1)), (4, (4, 0, 0))])
def test_split_sizes(spark, n, sizes):
    subs = spark.range(n).select(F.col("id").cast("string").alias("subject_id"))
    sp = O.subject_split(subs)
    got = {r["split"]: r["c"] for r in sp.groupBy("split").agg(F.count("*").alias("c")).collect()}
    assert (got.get("train", 0), got.get("val", 0), got.get("test", 0)) == sizes
    assert O.split_sizes(n) == sizes
    assert sp.select("subject_id").distinct().count() == n
