"""Physical-plan checks: the data path stays in the JVM, readings are
exchanged once, scans prune columns."""

from __future__ import annotations

import re

from tessera.plans import catalog as C


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_plan_has_no_python(spark, sf_small):
    p = _plan(C.windows_pipeline(spark, sf_small))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF"):
        assert node not in p


def test_readings_are_clustered_once(spark, sf_small):
    df = C.windows_pipeline(spark, sf_small)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0]
    # one clustering exchange of the readings (by time bucket; the others deal
    # pieces of long gaps); the other branch reuses it
    clustering = r"hashpartitioning\([^)]*_bucket#\d+L?, \d+\), REPARTITION_BY_(?:COL|NUM), \[plan_id=(\d+)\]"
    assert len(set(re.findall(clustering, final))) == 1
    assert "ReusedExchange" in final
    assert "CartesianProduct" not in final and "BroadcastNestedLoopJoin" not in final


def test_scan_prunes_columns(spark, sf_small):
    from tessera.operators import series as T

    r = C._readings(spark, sf_small).drop("event_id")
    p = _plan(T.clustered_readings(r, C.SPEC))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "event_id" not in scan.split("ReadSchema")[1]


def test_filter_pushdown(spark, sf_small):
    from pyspark.sql import functions as F
    from tessera.plans.tables import table

    df = table(spark, sf_small, "events").where(F.col("event_type") == "view").select("event_id")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in p


def test_per_channel_stats_are_broadcast(spark):
    """Joining values back to one row of statistics per channel must not
    hash-shuffle the values on the channel alone (one task per channel)."""
    from tessera.operators import stats as ST

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(f"c{i % 3}", float(i)) for i in range(200)]
        long = spark.createDataFrame(rows, "channel string, value double")
        for df in (ST.box_stats(long), ST.histogram(long, bins=5), ST.standardize(long)):
            p = _plan(df)
            assert "BroadcastHashJoin" in p
            # (the aggregates' own exchanges on channel follow a map-side
            # partial aggregate and carry a row per channel and task)
            assert not re.search(r"SortMergeJoin \[channel#\d+\], \[channel#\d+\]", p)
            assert not re.search(r"ShuffledHashJoin \[channel#\d+\], \[channel#\d+\]", p)
        # the order statistics are fetched by broadcast: the counted values
        # are not shuffled a second time
        assert "SortMergeJoin" not in _plan(ST.box_stats(long))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_series_is_spread_over_tasks(spark):
    """One key holds ~95 % of the readings: clustering on (series, time
    bucket) spreads it over many partitions, and the windows equal those
    built with one bucket per series (the cross-bucket stitching is exact)."""
    from pyspark.sql import functions as F

    from tessera.operators import series as T
    from tessera.plans.pipeline import build_windows

    def spec(bucket):
        return T.SeriesSpec(key=("sid",), sensor="sensor", sensors=("a", "b"), ts="ts", axes=("x",),
                            period=10, min_overlap=10, min_count=2, bucket=bucket)

    def readings(n, key):
        r = spark.range(n)
        return r.select(key.alias("sid"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("sensor"),
                        ((F.col("id") / 2).cast("long") * 7 + F.col("id") % 2 * 3).alias("ts"),
                        F.sin(F.col("id").cast("double")).alias("x"))

    hot = readings(40_000, F.lit("hot"))
    small = readings(2_000, F.concat(F.lit("s"), (F.col("id") % 5).cast("string")))
    data = hot.unionByName(small)

    dd = T.clustered_readings(data, spec(10 * 500), partitions=16)
    parts = dd.where("sid = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    total = sum(r["count"] for r in parts)
    assert len(parts) >= 8
    assert max(r["count"] for r in parts) <= 0.25 * total

    def windows(bucket):
        w = build_windows(data, spec(bucket), size=24, step=12).windows
        return {(r["sid"], r["k"]): tuple(round(v, 9) for v in r["features"]) for r in w.collect()}

    split, whole = windows(10 * 500), windows(10 ** 12)
    assert len(split) > 100 and split.keys() == whole.keys()
    assert all(split[k] == whole[k] for k in split)

    # the key-only path (window ids from the grid length) gives the same keys
    from tessera.operators.windows import window_keys
    ok = T.eligible(T.classify(T.overlap_bounds(T.clustered_readings(data, spec(10 * 500)), spec(10 * 500)),
                               spec(10 * 500)), spec(10 * 500))
    assert {tuple(r) for r in window_keys(ok, ["sid"], 24, 12).collect()} == set(split.keys())


def test_readings_scan_pushes_event_types(spark, sf_small):
    """The readings path itself (not a hand-written filter) hands the four
    mapped event types and the NULL tests to the Parquet reader."""
    p = _plan(C._readings(spark, sf_small))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "In(event_type, [click,purchase,signup,view])" in scan
    assert "IsNotNull(user_id)" in scan and "IsNotNull(ts)" in scan


def test_window_keys_from_bounds_match_built_windows(spark, sf_small):
    """Key-only queries take window keys from the grid length; they must be
    exactly the keys of the windows actually gathered from the grid."""
    from_bounds = {tuple(r) for r in C._windows_keys(spark, sf_small).collect()}
    built = {tuple(r) for r in C._windows_raw(spark, sf_small)
             .select("subject_id", "device", "activity", "k").collect()}
    assert from_bounds and from_bounds == built


def test_the_grid_reads_the_events_once(spark, sf_small):
    """Resampling takes its readings several times from what was kept of them."""
    plan = _plan(C._grid(spark, sf_small))
    assert "FileScan parquet" not in plan and "Scan ExistingRDD" in plan
