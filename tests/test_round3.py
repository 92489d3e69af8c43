"""Long gaps, the clipped resampling, models of many classes, sequence
numbers, sinks, streams."""

from __future__ import annotations

import glob
import json
import math
import os
import time
from dataclasses import replace
from datetime import datetime

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera.operators import order as O
from tessera.operators import score as SC
from tessera.operators import series as T
from tessera.operators.windows import zscore_features
from tessera.plans import catalog as C
from tessera.plans.pipeline import build_windows, rejections
from tessera.sources import store
from tessera.streaming import consumer as CS
from tessera.streaming import messages as MS

SPEC = T.SeriesSpec(key=("sid",), sensors=("a", "b"), ts="ts", axes=("x", "y"), period=10, min_overlap=10, bucket=5000)
SCHEMA = "sid string, sensor string, ts long, x double, y double"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def readings(sid, stamps, sensors="ab"):
    return [(sid, s, t, math.sin(t), float(t % 1000)) for t in stamps for s in sensors]


# ---- gaps --------------------------------------------------------------

def test_a_reading_long_before_the_range_harms_no_series(spark):
    """One accel reading at 0 beside a series at 1.7e18 ns, with time
    buckets of 0.1 s."""
    spec = replace(SPEC, period=20_000_000, min_overlap=10 ** 9, bucket=10 ** 8)
    late = [1_700_000_000_000_000_000 + i * 19_000_000 for i in range(300)]
    rows = readings("early", late) + [("early", "a", 0, 1.0, 1.0)] + readings("good", late)
    res = build_windows(spark.createDataFrame(rows, SCHEMA), spec, size=24, step=12)
    got = {}
    for r in res.windows.collect():
        got.setdefault(r["sid"], {})[r["k"]] = tuple(r["features"])
    assert got["early"] == got["good"] and len(got["good"]) > 10
    assert rejections(res.bounds, spec).count() == 0


def test_a_long_gap_is_filled_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(T, "EXPAND", 100)
    stamps = [*range(0, 300, 7), *range(400_000, 400_300, 7)]
    rows = readings("gap", stamps) + readings("good", range(0, 3000, 7))
    grid = T.resample(T.clustered_readings(spark.createDataFrame(rows, SCHEMA), SPEC), SPEC)
    at = grid.withColumn("p", F.spark_partition_id()).where("sid = 'gap' and sensor = 'a'").collect()
    n = at[0]["n"]
    assert sorted(r["i"] for r in at) == list(range(n)) and n == 40_029
    tasks = {}
    for r in at:
        if 40 <= r["i"] < 39_990:
            tasks[r["p"]] = tasks.get(r["p"], 0) + 1
    assert len(tasks) >= 6 and max(tasks.values()) < n / 3
    step = stamps[-1] / (n - 1)
    want = np.interp([r["i"] * step for r in at], stamps, [math.sin(t) for t in stamps])
    assert np.allclose([r["x"] for r in at], want)
    assert grid.where("sid = 'good'").count() == 2 * 299


def test_ranges_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(T, "EXPAND", 4)
    df = spark.createDataFrame([(0, 63), (-9, -9), (13, 70), (5, 8)], "lo long, hi long")
    want = sorted((lo, hi, i) for lo, hi in [(0, 63), (-9, -9), (13, 70), (5, 8)] for i in range(lo, hi + 1))
    for deal in (None, ["lo"]):
        assert sorted(tuple(r) for r in T.explode_range(df, F.col("lo"), F.col("hi"), "i", deal).collect()) == want


# ---- clip first --------------------------------------------------------

def on_lines(times, grid):
    """Plain twin for one axis: times -> (first, last) value at each."""
    ts = sorted(times)
    out = []
    for g in grid:
        if g == ts[0]:
            out.append(times[ts[0]][0])
            continue
        j = min(max(int(np.searchsorted(ts, g)), 1), len(ts) - 1)
        (lo, hi), left, right = ts[j - 1:j + 1], times[ts[j - 1]][1], times[ts[j]][0]
        out.append(left + (right - left) * (g - lo) / (hi - lo))
    return out


@pytest.mark.parametrize("bucket", [70, 5000, 10 ** 9])
def test_clipped_resampling_equals_a_plain_one(spark, bucket):
    spec = replace(SPEC, axes=("x",), bucket=bucket)
    rng = np.random.default_rng(8)
    rows = []
    for k in range(6):
        for s in "ab":
            ts = rng.integers(0, 900, 60) + 37 * k * (s == "a")
            rows += [(f"s{k}", s, int(t), float(np.round(rng.normal(), 3))) for t in ts]
    # ends that lie apart, one sensor with a single time in the range, a hot series
    rows += [("edge", "a", t, float(t)) for t in (0, 500, 500, 700, 2000)] + [("edge", "b", t, 1.0 * t * t) for t in (90, 91, 900)]
    rows += [("bare", "a", t, 1.0) for t in (0, 500, 2000)] + [("bare", "b", t, 2.0) for t in (90, 91, 900)]
    rows += [("hot", s, int(t), float(np.sin(t))) for s in "ab" for t in range(0, 40_000, 3)]
    df = spark.createDataFrame(rows, "sid string, sensor string, ts long, x double")
    got = {}
    for r in T.resample_clipped(df, spec).collect():
        got.setdefault((r["sid"], r["sensor"]), {})[r["i"]] = r["x"]
    want = {}
    for k in {r[0] for r in rows} - {"bare"}:
        of = {s: [(t, x) for sid, q, t, x in rows if (sid, q) == (k, s)] for s in "ab"}
        a, b = max(min(of[s])[0] for s in "ab"), min(max(of[s])[0] for s in "ab")
        n = (b - a) // 10
        for s in "ab":
            times = {}
            for t, x in sorted(of[s]):
                if a <= t <= b:
                    times[t] = (times[t][0] if t in times else x, x)
            want[k, s] = dict(enumerate(on_lines(times, [a + i * (b - a) / (n - 1) for i in range(n)])))
    assert got.keys() == want.keys()
    for k in want:
        assert got[k].keys() == want[k].keys()
        assert np.allclose([got[k][i] for i in sorted(got[k])], [want[k][i] for i in sorted(want[k])], atol=1e-6), k


def test_clipped_resampling_spreads_a_hot_series(spark):
    spec = replace(SPEC, axes=("x",), bucket=500)
    df = spark.range(20_000).select(F.when(F.col("id") < 20, "cold").otherwise("hot").alias("sid"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("sensor"),
                                    F.col("id").alias("ts"), F.sin(F.col("id").cast("double")).alias("x"))
    times = T.reading_times(T.cluster(df, spec, 16), spec)
    sizes = [r["count"] for r in times.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 0.25 * sum(sizes)


# ---- models of many classes --------------------------------------------

def many(spark, k, dims=2):
    rng = np.random.default_rng(k)
    c = rng.normal(size=(k, dims)) * 3
    names = [f"c{i:06d}" for i in range(k)]
    table = spark.createDataFrame([(i, n, v.tolist()) for i, (n, v) in enumerate(zip(names, c))], SC.MODEL)
    x = rng.normal(size=(40, dims)) * 3
    y = rng.integers(0, k, 40)
    df = spark.createDataFrame([(i, v.tolist(), int(t)) for i, (v, t) in enumerate(zip(x, y))],
                               "id int, features array<double>, y_true int")
    logits = -((x[:, None] - c[None]) ** 2).sum(axis=2)
    top = logits.max(axis=1)
    lse = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
    want = [(i, int(logits[i].argmax()), math.exp(top[i] - lse[i]), lse[i] - logits[i, y[i]]) for i in range(40)]
    return SC.CentroidModel.of(table), df, want


def check(scored, want):
    got = sorted(tuple(r) for r in scored.select("id", "y_pred", "confidence", "xentropy").collect())
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2:] for r in got], [r[2:] for r in want])


def test_twenty_thousand_classes_stay_a_table(spark):
    model, df, want = many(spark, 20_000)
    assert not model.small
    scored = model.score(df, "features", "y_true")
    check(scored, want)
    p = plan(scored)
    assert len(p) < 40_000 and "Broadcast" not in p.split("== Initial Plan ==")[-1]
    with pytest.raises(ValueError):
        model.with_logits(df)


def test_blocks_of_classes_equal_one_projection(spark, monkeypatch):
    model, df, want = many(spark, 50, 5)
    assert model.small
    check(model.score(df, "features", "y_true"), want)
    monkeypatch.setattr(SC, "SMALL_CLASSES", 10)
    monkeypatch.setattr(SC, "CLASS_BLOCK", 7)
    check(model.score(df, "features", "y_true"), want)
    without = model.score(df, "features")
    assert "xentropy" not in without.columns and without.count() == 40


# ---- order and sinks ---------------------------------------------------

def test_sequence_numbers_equal_a_sort(spark):
    rng = np.random.default_rng(9)
    rows = [(["phone", "watch", None][int(d)], f"s{s}", int(k), [float(k)] * 4)
            for d in range(3) for s in range(5) for k in rng.choice(3000, [0, 40, 1500, 7, 2600][s], replace=False)]
    df = spark.createDataFrame(rows, "device string, subject string, k long, features array<double>")
    out = O.sequence_numbers(df, ["device", "subject"], "k", within={"pos": ["device"]}, block=64)
    got = sorted((r["seq"], r["device"], r["subject"], r["k"], r["pos"]) for r in out.collect())
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2]))
    assert [g[1:4] for g in got] == [r[:3] for r in want] and [g[0] for g in got] == list(range(len(rows)))
    for d in {r[0] for r in rows}:
        assert [g[4] for g in got if g[1] == d] == list(range(sum(r[0] == d for r in rows)))


def test_features_are_in_no_range_sort(spark):
    df = spark.range(5000).select((F.col("id") % 2).cast("int").alias("device"), F.lit("s").alias("subject_id"),
                                  F.lit("A").alias("label"), F.col("id").alias("k"),
                                  F.array(F.col("id").cast("double"), F.lit(1.0)).alias("features"))
    p = plan(MS.window_messages(df, 1))
    for line in p.splitlines():
        assert not ("features" in line and ("rangepartitioning" in line or line.lstrip(" +-:*(0123456789)").startswith("Sort [")))
    sent = [json.loads(r["value"]) for r in MS.window_messages(df, 1).collect()]
    sent.sort(key=lambda m: m["seq"])
    assert [(m["seq"], m["pos"], m["device"]) for m in sent] == [
        (i, i % 2500, "phone" if i < 2500 else "watch") for i in range(5000)]


def files(path):
    """Rows of every file by its folder."""
    import pyarrow.parquet as pq

    out = {}
    for f in glob.glob(f"{path}/**/*.parquet", recursive=True):
        out.setdefault(os.path.basename(os.path.dirname(f)), []).append(pq.read_metadata(f).num_rows)
    return out


def test_slices_hold_about_as_many_rows_as_asked_for(spark, tmp_path):
    df = spark.range(40_000).repartition(64).select(
        "id", F.when(F.col("id") % 100 < 95, "train").when(F.col("id") % 100 < 99, "val").alias("split"),
        F.array(F.lit(1.0)).alias("features"))
    store.write_windows(df, str(tmp_path / "w"), ["split"], rows_per_file=1000)
    got = files(tmp_path / "w")
    assert {k: (len(v), sum(v)) for k, v in got.items()} == {
        "split=train": (38, 38_000), "split=val": (2, 1600), "split=__HIVE_DEFAULT_PARTITION__": (1, 400)}
    assert all(800 <= n <= 1200 for n in got["split=train"])
    assert spark.read.parquet(str(tmp_path / "w")).count() == 40_000
    store.write_windows(df.drop("split"), str(tmp_path / "v"), rows_per_file=4000)
    (sizes,) = files(tmp_path / "v").values()
    assert len(sizes) == 10 and min(sizes) > 3500
    store.write_windows(df.limit(0), str(tmp_path / "none"), ["split"])


def test_sliced_windows_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def mark(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    store.write_windows(spark.range(1000).mapInArrow(mark, "id long"), str(tmp_path / "w"), rows_per_file=100)
    assert spark.read.parquet(str(tmp_path / "w")).count() == 1000 and made.value == 1000


def test_automatic_histograms_make_their_values_once(spark, sf_small):
    assert not [f for f in C.q_histogram_auto(spark, sf_small).inputFiles() if "events" in f]


def test_kept_readings_are_shuffled_once_and_never_again(spark):
    df = spark.range(9000).select(F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("sid"),
                                  F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("sensor"), F.col("id").alias("ts"),
                                  F.sin(F.col("id").cast("double")).alias("x"), F.lit(0.0).alias("y"))
    enabled = spark.conf.get("spark.sql.adaptive.enabled")
    kept = T.kept_readings(df, SPEC, 4, "kept_test")
    try:
        assert spark.conf.get("spark.sql.adaptive.enabled") == enabled
        assert sorted(kept.collect()) == sorted(T.clustered_readings(df, SPEC).select(*kept.columns).collect())
        for second in (T.segments(kept, SPEC), T.bucket_summary(kept, SPEC)):
            assert second.count() and "Exchange" not in plan(second)
        from_table = T.resample(kept, SPEC)
        # what is shuffled has a row per bucket, key or gap; no branch from the readings' own rows
        assert "Window" in plan(from_table) and from_table.count() == T.resample(T.clustered_readings(df, SPEC), SPEC).count()
    finally:
        T.drop_kept(spark, "kept_test")


# ---- streams -----------------------------------------------------------

def lines(rows):
    """Message lines of (device, pos, activity, features or None for a damaged one)."""
    out = []
    for seq, (device, pos, activity, f) in enumerate(rows):
        m = {"device": device, "subject_id": f"s{seq}", "activity": activity, "features": f, "seq": seq, "pos": pos}
        out.append(json.dumps(m, separators=(",", ":"))[: None if f else -1])
    return out


def put(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").text(str(path))


def two_classes(spark):
    return SC.CentroidModel.of(spark.createDataFrame([(0, "A", [0.0, 0.0]), (1, "B", [9.0, 9.0])], SC.MODEL))


def running(spark, src, base, patience=None, trigger=None, n_files=1):
    decoded = MS.place_of(MS.decode(MS.read_files(spark, str(src), n_files), channels=1))
    scored = CS.score_messages(decoded, two_classes(spark), 1, normalize=False, keep_invalid=True)
    return CS.run_append(spark, CS.running_accuracy_state(scored, ["device"], patience=patience), "t-running", trigger,
                         checkpoint=f"{base}/ckpt", path=f"{base}/out")


def reported(spark, base):
    try:
        df = spark.read.parquet(f"{base}/out")
    except AnalysisException:  # nothing yet
        return []
    return sorted(tuple(r) for r in df.select("device", "n_seen", "seq", "correct", "n_correct", "running_accuracy").collect())


def expected(rows, order=None):
    out = []
    for device in ("phone", "watch"):
        mine = sorted((pos, seq, activity, f) for seq, (d, pos, activity, f) in enumerate(rows) if d == device and f)
        right = 0
        for n, (_, seq, activity, f) in enumerate(mine, 1):
            hit = (activity == "A") == (f[0][0] < 4.5)
            right += hit
            out.append((device, n, seq, hit, right, right / n))
    return sorted(out)


def messages(n=24):
    near, far = [[0.0], [1.0]], [[9.0], [8.0]]
    rows = [("phone" if i % 3 else "watch", None, "AB"[i % 2], near if i % 5 else far) for i in range(n)]
    count, out = {}, []
    for d, _, a, f in rows:
        out.append((d, count.get(d, 0), a, f))
        count[d] = count.get(d, 0) + 1
    return out


def test_running_accuracy_in_the_stream_restores_the_order_and_survives_a_restart(spark, tmp_path):
    rows = messages()
    rows[4], rows[13] = (*rows[4][:3], None), (*rows[13][:3], None)  # damaged, their place is told
    sent = lines(rows)
    src = tmp_path / "src"
    # far out of order, some messages twice, over two runs of the query
    for part in ([20, 3, 9, 1], [0, 2, 4, 4, 6], [22, 23, 21, 8]):
        put(spark, src, [sent[i] for i in part])
    q, _ = running(spark, src, tmp_path)
    q.awaitTermination()
    first = reported(spark, tmp_path)
    assert first == [r for r in expected(rows) if r in first] and 0 < len(first) < 22
    for part in ([5, 7, 3], list(range(10, 20))):
        put(spark, src, [sent[i] for i in part])
    q, _ = running(spark, src, tmp_path)
    q.awaitTermination()
    assert reported(spark, tmp_path) == expected(rows)


def test_a_missing_message_is_passed_over_after_a_while(spark, tmp_path):
    rows = messages(9)
    sent = lines(rows)
    put(spark, tmp_path / "src", [s for i, s in enumerate(sent) if i != 1])
    q, _ = running(spark, tmp_path / "src", tmp_path, "1 second", {"processingTime": "500 milliseconds"})
    try:
        until = time.monotonic() + 60
        while time.monotonic() < until and len(reported(spark, tmp_path)) < 8:
            time.sleep(0.5)
    finally:
        q.stop()
    assert reported(spark, tmp_path) == expected([r if i != 1 else (*r[:3], None) for i, r in enumerate(rows)])


def test_the_trigger_sets_the_cadence(spark, tmp_path):
    for part in range(3):
        put(spark, tmp_path / "src", lines(messages(6))[part * 2:part * 2 + 2])
    q, _ = CS.run_append(spark, MS.decode(MS.read_files(spark, str(tmp_path / "src"), 1)), "t-cadence",
                         {"processingTime": "1500 milliseconds"})
    try:
        until = time.monotonic() + 60
        while sum(CS.progress_rows(q)) < 6 and time.monotonic() < until:
            time.sleep(0.2)
        done = [(datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).timestamp(), p["durationMs"]["triggerExecution"])
                for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()
    assert len(done) == 3
    # a trigger waits for the next multiple of the interval, unless its predecessor took longer
    for (before, took), (at, _) in zip(done, done[1:]):
        assert took > 1500 or at >= math.floor(before / 1.5 + 1) * 1.5 - 0.05


def test_the_change_log_is_bounded_by_its_keys(spark, tmp_path):
    log = str(tmp_path / "log")
    newest = {}
    for batch in range(23):
        rows = [(f"k{i}", batch * 100 + i) for i in range(batch % 4, 12, 2)]
        df = spark.createDataFrame(rows, "key string, seq long")
        for _ in range(1 + (batch in (5, 7, 8))):  # some batches run again
            CS.append_changes(df, batch, log, ["key"], compact_every=4)
        newest.update(rows)
        assert dict(tuple(r) for r in CS.read_changelog(spark, log, ["key"]).collect()) == newest
        assert len(CS.generations(spark, f"{log}/snapshot")) <= 2 and len(CS.generations(spark, f"{log}/delta")) <= 8
    # a snapshot that was not finished is not read
    half = f"{log}/snapshot/{10 ** 6}"
    spark.createDataFrame([("k0", 0, 10 ** 6)], "key string, seq long, _batch int").write.parquet(half)
    os.remove(f"{half}/_SUCCESS")
    assert dict(tuple(r) for r in CS.read_changelog(spark, log, ["key"]).collect()) == newest


def test_latest_state_survives_a_restart_and_compaction(spark, tmp_path):
    rows = messages(20)
    sent = lines(rows)

    def run():
        stream = MS.decode(MS.read_files(spark, str(tmp_path / "src"), 1), channels=1).where("valid")
        q, _ = CS.run_update(spark, CS.latest_state(stream, ["device"], "seq", ["activity"]), "t-latest", ["device"],
                             checkpoint=str(tmp_path / "ckpt"), changelog=str(tmp_path / "log"), compact_every=2)
        q.awaitTermination()
        return sorted(tuple(r) for r in CS.read_changelog(spark, str(tmp_path / "log"), ["device"]).collect())

    for i in range(3):
        put(spark, tmp_path / "src", sent[i * 4:i * 4 + 4])
    assert run() == [("phone", 11, "B"), ("watch", 9, "B")]
    for i in range(3, 5):
        put(spark, tmp_path / "src", sent[i * 4:i * 4 + 4])
    assert run() == [("phone", 19, "B"), ("watch", 18, "A")]


def test_a_new_threshold_takes_effect_with_the_next_batch(spark, tmp_path):
    scored = spark.createDataFrame([(float(i),) for i in range(10)], "xentropy double")
    src, thr = str(tmp_path / "src"), str(tmp_path / "thr")

    def threshold(x):
        spark.createDataFrame([(x,)], "threshold_95 double").write.mode("overwrite").parquet(thr)

    def run():
        stream = spark.readStream.schema(scored.schema).parquet(src)
        q, out = CS.run_alerts(spark, stream, thr, "t-alerts", checkpoint=str(tmp_path / "ckpt"), path=str(tmp_path / "out"))
        q.awaitTermination()
        return CS.read_batches(spark, out)

    threshold(6.5)
    scored.write.parquet(src)
    assert run().where("alert").count() == 3
    threshold(2.5)
    scored.write.mode("append").parquet(src)
    assert run().where("alert").count() == 3 + 7


# ---- expressions that are computed once --------------------------------

def test_the_fit_computes_its_vectors_once(spark):
    df = spark.createDataFrame([("a", [1.0, 2.0, None, 4.0]), ("b", [3.0, 1.0]), ("b", []), ("a", None), (None, [1.0, 2.0])],
                               "label string, features array<double>")
    values = SC.class_values(zscore_features(df, 2), "features", "label")
    assert not any("zip_with" in line for line in plan(values).splitlines() if "Filter" in line)
    got = sorted(SC.class_values(df, "features", "label").collect(), key=lambda r: r[:2])
    assert got == [("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, None), ("a", 3, 4.0), ("b", 0, 3.0), ("b", 1, 1.0)]


def test_a_filter_on_valid_messages_reads_the_json_once_more(spark):
    df = spark.createDataFrame([('{"device":"phone","subject_id":"1","activity":"A","features":[[1.0,2.0]],"seq":0,"pos":0}',),
                                ('{"device":"phone","activity":"A","features":[[null,2.0]]}',), ("no JSON",), (None,)], "value string")
    valid = MS.decode(df, 1, 2).where("valid")
    assert plan(valid).count("from_json") <= 2
    assert [(r["subject_id"], r["features"]) for r in valid.collect()] == [("1", [[1.0, 2.0]])]
    assert [r["valid"] for r in MS.decode(df, 1, 2).collect()] == [True, False, False, False]


def test_zscore_keeps_nulls_and_uneven_lengths(spark):
    df = spark.createDataFrame([(0, [1.0, 5.0, 3.0, None]), (1, [1.0, 5.0, 3.0]), (2, None)], "k int, features array<double>")
    got = {r["k"]: r["features"] for r in zscore_features(df, 2).collect()}
    assert got[0][1] is None and got[0][3] is None and got[0][::2] == pytest.approx([-1.0, 1.0], rel=1e-5)
    assert got[1] == [None, 0.0, None] and got[2] is None
