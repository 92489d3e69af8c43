"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole driver tables.  Floating results are rounded to 6 places
for comparison with the SQL oracle; ids and counts are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import clean_numeric, reshape, round6
from tessera.operators import series as T
from tessera.operators import lookup as L
from tessera.operators import metrics as M
from tessera.operators import order as O
from tessera.operators import score as SC
from tessera.operators import stats as ST
from tessera.operators import running as RN
from tessera.operators.windows import (count_windows, finite_windows, melt, window_cells, window_ids, window_keys, windows_from_grid,
                                       zscore_features)
from tessera import schemas as SCH
from tessera.session import checkpoint_dir, scratch_path
from tessera.streaming import consumer as CS
from tessera.streaming import messages as MS
from tessera.plans import tables as TB
from tessera.plans.pipeline import build_windows, rejections
from tessera.plans import training as TR
from tessera.sources import sensor_files, store
from tessera.sources.sensor_files import device_name

SPEC = TB.EVENTS_SPEC
KEY = list(SPEC.key)
CH = SPEC.channels
SIZE, STEP = TB.EVENTS_WINDOW, TB.EVENTS_STEP


def _readings(spark, sf):
    return TB.event_readings(spark, sf)


def _deduped(spark, sf):
    return T.clustered_readings(_readings(spark, sf).drop("event_id"), SPEC)


def _bounds(spark, sf):
    return T.classify(T.overlap_bounds(_deduped(spark, sf), SPEC), SPEC)


def _kept(spark, sf):
    """The readings of ``_deduped``, checkpointed as dealt: resampling reads
    them several times, and would else sort and merge them each time."""
    checkpoint_dir(spark)
    return _deduped(spark, sf).checkpoint()


def _grid(spark, sf):
    return T.resample(_kept(spark, sf), SPEC)


def _long(w: DataFrame, key: list[str], channels: list[str]) -> DataFrame:
    """Window rows -> one row per (window, position) with a column per
    channel, through the reshape operator (flat -> rows)."""
    nc = len(channels)
    r = w.select(*key, "k", F.posexplode(reshape("features", nc)).alias("j", "_row"))
    return r.select(*key, "k", F.col("j").cast("long").alias("j"),
                    *[round6(F.col("_row")[c]).alias(ch) for c, ch in enumerate(channels)])


# -- cleaning ----------------------------------------------------------------

def q_clean_numeric(spark, sf):
    ev = TB.table(spark, sf, "events")
    return ev.select("event_id", "props", clean_numeric("props").alias("k_value"),
                     clean_numeric("props", keep_exponent=True).alias("k_value_exp"))


def q_device_code(spark, sf):
    r = _readings(spark, sf)
    return r.select("event_id", "device", "sensor", device_name("device").alias("device_name"))


def q_sensor_readings(spark, sf):
    r = _readings(spark, sf)
    return r.select("event_id", *KEY, "sensor", "timestamp", round6("x").alias("x"), round6("y").alias("y"))


# -- series core -------------------------------------------------------------

def q_dedupe_series(spark, sf):
    """Duplicates made by an hourly timestamp: one whole reading kept per
    (series, hour), the smallest (x, y)."""
    dd = T.clustered_readings(_coarse(spark, sf, 1), SPEC)
    return dd.select(*KEY, "sensor", "timestamp", round6("x").alias("x"), round6("y").alias("y"))


def q_overlap_bounds(spark, sf):
    b = _bounds(spark, sf)
    return b.select(*KEY, "n_accel", "min_accel", "max_accel", "n_gyro", "min_gyro", "max_gyro", "a", "b")


def q_eligible_pairs(spark, sf):
    return T.eligible(_bounds(spark, sf), SPEC)


def q_rejected_series(spark, sf):
    return rejections(_bounds(spark, sf), SPEC)


def q_time_grid(spark, sf):
    return T.time_grid(T.eligible(_bounds(spark, sf), SPEC), SPEC).select(*KEY, "n", "i", "t_off")


def q_resample_linear(spark, sf):
    g = _grid(spark, sf)
    return g.select(*KEY, "sensor", "i", round6("x").alias("x"), round6("y").alias("y"))


def _coarse(spark, sf, hours: int):
    """Readings at a coarser time, so that several share one."""
    r = _readings(spark, sf).drop("event_id")
    return r.withColumn("timestamp", F.col("timestamp") - F.col("timestamp") % (hours * TB.US_PER_HOUR))


def q_resample_clipped(spark, sf):
    """Clip to the common range first, keep duplicate times (made by
    six-hourly timestamps), extrapolate at the edges."""
    g = T.resample_clipped(_coarse(spark, sf, 6), SPEC)
    return g.select(*KEY, "sensor", "i", "n", round6("x").alias("x"), round6("y").alias("y"))


def q_resample_kept(spark, sf):
    """The grid from readings kept as a bucketed table."""
    g = T.resample(T.kept_readings(_readings(spark, sf).drop("event_id"), SPEC), SPEC)
    return g.select(*KEY, "sensor", "i", round6("x").alias("x"), round6("y").alias("y"))


# windows of a slice
SLICE = 200


def q_window_slices(spark, sf):
    """Windows written by split in slices of about 200 rows: files and rows
    of each split, read back."""
    w = _windows_raw(spark, sf).withColumnRenamed("activity", "label")
    w = w.join(O.subject_split(_subjects(spark, sf)), "subject_id")
    path = scratch_path(spark, "slices")
    store.write_windows(w, path, ["split"], SLICE, key=["subject_id", "device", "label", "k"])
    return spark.read.parquet(path).groupBy("split").agg(
        F.count_distinct("_metadata.file_name").alias("n_files"), F.count("*").alias("n_windows"))


# a far-off reading: this much after the reading it copies (11.4 years, 100,000 grid points)
FAR = 100_000 * TB.US_PER_HOUR


def q_resample_far(spark, sf):
    """A reading far off all others: the readings of every 50th user, and
    copies of those of the month's last days 100,000 hours later.  The gap is
    filled like any other, and the other series are as without it."""
    r = _readings(spark, sf).drop("event_id").where(F.col("subject_id").cast("long") % 50 == 0)
    r = r.withColumn("activity", F.lit("all"))
    last = r.groupBy(*KEY, "sensor").agg(F.max("timestamp").alias("timestamp"))
    far = r.join(last, [*KEY, "sensor", "timestamp"], "left_semi").withColumn("timestamp", F.col("timestamp") + F.lit(FAR))
    dd = T.clustered_readings(r.unionByName(far), SPEC)
    return T.resample(dd, SPEC).select(*KEY, "sensor", "i", "n", round6("x").alias("x"), round6("y").alias("y"))


def q_paired_series(spark, sf):
    """Series keys read by both sensors, with the reading count of each
    (the pair test and inner join of the two sensors, as one aggregate:
    a single shuffle of the readings, partial counts map-side)."""
    r = _readings(spark, sf)
    counts = [F.count(F.when(F.col("sensor") == s, F.lit(1))).alias(f"n_{s}") for s in SPEC.sensors]
    both = None
    for s in SPEC.sensors:
        both = F.col(f"n_{s}") > 0 if both is None else both & (F.col(f"n_{s}") > 0)
    return r.groupBy(*KEY).agg(*counts).where(both)


def q_interp_error(spark, sf):
    dd = _kept(spark, sf)
    summary = T.bucket_summary(dd, SPEC)
    bounds = T.bounds_from_buckets(summary, SPEC)
    grid = T.resample(dd, SPEC, bounds, summary)
    e = T.interpolation_error(grid, dd, T.eligible(T.classify(bounds, SPEC), SPEC), SPEC)
    return e.select(*KEY, "sensor", "n_points", *[round6(f"max_err_{x}").alias(f"max_err_{x}") for x in SPEC.axes])


def q_align_channels(spark, sf):
    a = T.align(_grid(spark, sf), SPEC)
    return a.select(*KEY, "i", *[round6(c).alias(c) for c in CH])


def _windows_raw(spark, sf):
    return windows_from_grid(_grid(spark, sf), SPEC, SIZE, STEP)


def _cells(spark, sf):
    """Every (window, grid index) as a wide row, without gathering windows."""
    return window_cells(T.align(_grid(spark, sf), SPEC), KEY, CH, SIZE, STEP)


def q_sliding_windows(spark, sf):
    return _long(_windows_raw(spark, sf), KEY, CH).withColumnRenamed("activity", "label")


def q_zscore_windows(spark, sf):
    w = zscore_features(_windows_raw(spark, sf), len(CH))
    return _long(w, KEY, CH).withColumnRenamed("activity", "label")


def q_zscore_sample(spark, sf):
    """z-score with the sample deviation (ddof = 1), as training uses it."""
    w = zscore_features(_windows_raw(spark, sf), len(CH), ddof=1)
    return _long(w, KEY, CH).withColumnRenamed("activity", "label")


def windows_pipeline(spark, sf):
    """Flagship: events -> cleaned readings -> dedupe -> common range ->
    hourly grid -> align + 24/12 windows with per-window z-score ->
    finite filter.  One row per window (features array)."""
    res = build_windows(_readings(spark, sf).drop("event_id"), SPEC, SIZE, STEP, zscore=True)
    return res.windows.withColumnRenamed("activity", "label")


def q_windows_pipeline(spark, sf):
    return _long(windows_pipeline(spark, sf), ["subject_id", "device", "label"], CH)



# -- splits, ordering, sets --------------------------------------------------

def _subjects(spark, sf):
    return TB.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("subject_id"))


def q_subject_split(spark, sf):
    return O.subject_split(_subjects(spark, sf))


def q_split_sizes(spark, sf):
    return O.subject_split(_subjects(spark, sf)).groupBy("split").agg(F.count("*").alias("n_subjects"))


def _windows_keys(spark, sf):
    """Window keys from the usable bounds (no resampling; see window_keys)."""
    return _keys_of(T.eligible(_bounds(spark, sf), SPEC))


def _keys_of(usable):
    w = window_keys(usable, KEY, SIZE, STEP)
    return w.select("subject_id", "device", F.col("activity").alias("label"), "k")


def q_split_leakage(spark, sf):
    """Subjects whose windows fall in more than one split: none if subjects
    are split, many if windows are (the leak that splitting by subject is
    there to prevent)."""
    w = _windows_keys(spark, sf)
    by_subject = w.join(O.subject_split(_subjects(spark, sf)), "subject_id")
    h = F.substring(O.hash_key(42, "subject_id", "device", "label", "k"), 1, 13)
    by_window = w.withColumn("split", F.when(h < O.hash_threshold(0.8), "train")
                             .when(h < O.hash_threshold(0.9), "val").otherwise("test"))
    parts = []
    for name, df in (("subject", by_subject), ("window", by_window)):
        per = O.splits_of(df).agg(F.count("*").alias("n_subjects"), F.sum("n_windows").alias("n_windows"),
                                  F.count(F.when(F.col("n_splits") > 1, 1)).alias("n_leaking"))
        parts.append(per.select(F.lit(name).alias("split_by"), "n_subjects", "n_windows", "n_leaking"))
    return parts[0].unionByName(parts[1])


def q_semi_split(spark, sf):
    """Windows of the training subjects: the split meets one row per key,
    before windows are enumerated."""
    train = O.subject_split(_subjects(spark, sf)).where(F.col("split") == "train")
    return _keys_of(T.eligible(_bounds(spark, sf), SPEC).join(train, "subject_id", "left_semi"))


def q_anti_split(spark, sf):
    train = O.subject_split(_subjects(spark, sf)).where(F.col("split") == "train")
    return _keys_of(T.eligible(_bounds(spark, sf), SPEC).join(train, "subject_id", "left_anti"))


def q_common_activities(spark, sf):
    """Activities that both sensors recorded, per subject and device: the
    intersection of two distinct lists, as one aggregate."""
    has = [F.bool_or(F.col("sensor") == s).alias(f"_{s}") for s in SPEC.sensors]
    both = _readings(spark, sf).groupBy(*KEY).agg(*has)
    for s in SPEC.sensors:
        both = both.where(F.col(f"_{s}"))
    return both.select(*KEY)


def q_paired_subjects(spark, sf):
    """Subjects and devices with readings of every sensor."""
    return sensor_files.paired_subjects(_readings(spark, sf))


def q_union_devices(spark, sf):
    usable = T.eligible(_bounds(spark, sf), SPEC)
    parts = [_keys_of(usable.where(F.col("device") == dev)) for dev in (0, 1)]
    return parts[0].unionByName(parts[1])


def q_hash_sample(spark, sf):
    ev = TB.table(spark, sf, "events")
    return O.hash_sample(ev, 0.10, 99, "event_id").select("event_id")


def q_epoch_shuffle(spark, sf):
    e = TB.table(spark, sf, "embeddings").select("vec_id")
    return O.shuffle_order(e, 42, 1, "vec_id")


def q_batch_ids(spark, sf):
    e = TB.table(spark, sf, "embeddings").select("vec_id")
    return O.batch_ids(O.shuffle_order(e, 42, 2, "vec_id"), 64)


def q_limit_n(spark, sf):
    r = _readings(spark, sf)
    return r.orderBy("timestamp", "event_id").limit(10).select("event_id", "timestamp")


def q_sorted_series(spark, sf):
    r = _readings(spark, sf).select("event_id", *KEY, "sensor", "timestamp")
    return O.global_rank(r, [*KEY, "sensor", "timestamp", "event_id"], "pos").select("event_id", "pos")


def q_publish_order(spark, sf):
    w = _windows_keys(spark, sf)
    return O.global_rank(w, ["device", "subject_id", "label", "k"], "seq")


def q_filter_eq(spark, sf):
    r = _readings(spark, sf)
    return r.where((F.col("device") == 0) & (F.col("sensor") == "accel")).select("event_id", "subject_id")


def q_clip_to_overlap(spark, sf):
    # joined per time bucket: a hot key's readings spread over its buckets
    r = T.with_bucket(_readings(spark, sf), SPEC)
    width = F.lit(SPEC.bucket_width)
    ok = T.explode_range(T.eligible(_bounds(spark, sf), SPEC), F.floor(F.col("a") / width),
                         F.floor(F.col("b") / width), "_bucket")
    return (r.join(ok, [*KEY, "_bucket"]).where(F.col("timestamp").between(F.col("a"), F.col("b")))
            .select("event_id", *KEY, "sensor", "timestamp"))


# -- aggregates and profiles -------------------------------------------------

def q_window_counts(spark, sf):
    w = _windows_keys(spark, sf)
    return w.rollup("device", "subject_id", "label").agg(F.count("*").alias("n_windows"))


def q_distinct_labels(spark, sf):
    return _windows_keys(spark, sf).select("label").distinct()


def q_row_counts(spark, sf):
    r = _readings(spark, sf).agg(F.count("*").alias("n_readings"))
    usable = F.col("reason").isNull()
    b = _bounds(spark, sf).agg(F.count("*").alias("n_keys"), F.count(F.when(usable, 1)).alias("n_usable"),
                               F.sum(F.when(usable, count_windows(F.col("n"), SIZE, STEP))).alias("n_windows"))
    return r.select(
        "n_readings", *[b.select(c).scalar().alias(c) for c in ("n_keys", "n_usable", "n_windows")])


def _long_values(spark, sf):
    return melt(_cells(spark, sf), CH, ["subject_id", "device", "activity", "k", "j"])


def _weighted_values(spark, sf):
    """Long rows of the aligned grid, each with the number ``w`` of windows
    that hold it: counts over windows without copying rows to them."""
    a = T.align(_grid(spark, sf), SPEC)
    a = a.withColumn("w", F.size(window_ids(F.col("i"), F.col("n"), SIZE, STEP)).cast("long"))
    return melt(a.where(F.col("w") > 0), CH, ["w"])


def _r6(df):
    return df.select(*[round6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def q_array_summary(spark, sf):
    return _r6(ST.array_summary(_long_values(spark, sf), len(CH), SIZE))


def q_channel_stats(spark, sf):
    return _r6(ST.channel_stats(_long_values(spark, sf)))


def q_finite_check(spark, sf):
    return ST.finite_check(_long_values(spark, sf))


def q_corr_matrix(spark, sf):
    return _r6(ST.corr_matrix(_cells(spark, sf), CH))


def q_box_stats(spark, sf):
    return _r6(ST.box_stats(_weighted_values(spark, sf), weight="w"))


def q_histogram(spark, sf):
    return _r6(ST.histogram(_weighted_values(spark, sf), bins=30, weight="w"))


def q_histogram_auto(spark, sf):
    """Histograms whose number of bins follows from the values."""
    path = scratch_path(spark, "values")
    _weighted_values(spark, sf).write.parquet(path)
    long = spark.read.parquet(path)
    return _r6(ST.histogram(long, ST.automatic_bins(long, weight="w"), weight="w"))


def q_standardize(spark, sf):
    s = ST.standardize(_long_values(spark, sf))
    return _r6(s.withColumnRenamed("activity", "label"))


def q_melt_channels(spark, sf):
    return _r6(_long_values(spark, sf).withColumnsRenamed({"activity": "label", "j": "i", "channel": "axis"}))


# -- lookups -----------------------------------------------------------------

def q_code_lookup(spark, sf):
    li = TB.table(spark, sf, "lineitem")
    code = L.trim_code("l_returnflag")
    return li.select("l_orderkey", "l_linenumber", code.alias("code"), L.code_to_name(code).alias("name"))


def q_trim_code(spark, sf):
    c = TB.table(spark, sf, "conversations")
    return c.select("conv_id", "turn", L.trim_code("role").alias("role"))


def _class_names(spark, sf):
    p = TB.table(spark, sf, "part").select(F.col("p_name").alias("label"))
    l_ = TB.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("label"))
    c = TB.table(spark, sf, "conversations").select(F.col("role").alias("label"))
    return p.unionByName(l_).unionByName(c)


def q_label_index(spark, sf):
    return L.label_index(TB.table(spark, sf, "part").select(F.col("p_type").alias("label")))


def q_resolve_labels(spark, sf):
    return L.class_table(L.label_index(_class_names(spark, sf)))


# -- scoring and evaluation --------------------------------------------------

def _emb(spark, sf):
    e = TB.table(spark, sf, "embeddings")
    prefix = F.substring(O.hash_key(42, "vec_id"), 1, 13)
    return e.withColumn("split", F.when(prefix < F.lit(O.hash_threshold(0.8)), "train").otherwise("held_out"))


def _model(spark, sf, fraction=0.8):
    """The model learned from the rows whose md5 order is below ``fraction``
    (0.8: the training rows), and all rows with their class's index."""
    e = _emb(spark, sf)
    prefix = F.substring(O.hash_key(42, "vec_id"), 1, 13)
    model = SC.CentroidModel.fit(e.where(prefix < F.lit(O.hash_threshold(fraction))), "embedding", "label")
    return model, model.index(e, "label", "y_true")


def _predictions(spark, sf, split="held_out", fraction=0.8):
    """Scored rows of a split (None: all rows) and the model's classes."""
    model, e = _model(spark, sf, fraction)
    d = e.where(F.col("split") == split) if split else e
    return model.score(d.select("vec_id", "split", "embedding", "y_true"), "embedding", "y_true").drop("embedding"), model.classes()


def q_centroid_scores(spark, sf):
    p, _ = _predictions(spark, sf, None)
    return _r6(p.select("vec_id", "y_true", "y_pred", "confidence", "xentropy"))


def q_softmax_scores(spark, sf):
    model, e = _model(spark, sf)
    d = model.with_logits(e, "embedding")
    pr = d.select("vec_id", F.posexplode(SC.probabilities("logits")).alias("class_idx", "prob"))
    return _r6(pr)


def q_confusion_matrix(spark, sf):
    p, classes = _predictions(spark, sf)
    return M.confusion_long(p, classes)


def q_classification_report(spark, sf):
    p, classes = _predictions(spark, sf)
    return _r6(M.classification_report(p, classes))


def q_per_class_accuracy(spark, sf):
    p, classes = _predictions(spark, sf)
    return _r6(M.per_class_accuracy(p, classes))


def q_p95_threshold(spark, sf):
    p, _ = _predictions(spark, sf, None)
    return _r6(M.loss_threshold(p, 0.95))


def q_score_histograms(spark, sf):
    """Distribution of the confidence (30 bins) and of the loss (50 bins)."""
    p, _ = _predictions(spark, sf)
    parts = [ST.histogram(melt(p, [c], []), bins=n) for c, n in (("confidence", 30), ("xentropy", 50))]
    return _r6(parts[0].unionByName(parts[1]))


def q_train_windows(spark, sf):
    """A classifier trained on the windows of the training subjects: does it
    tell calm from busy windows (first channel's mean under or over that of
    all) of the others better than their more frequent label does?"""
    cells = _cells(spark, sf)
    mean = cells.agg(F.avg(CH[0])).scalar()
    features = TR.window_features(cells, KEY, CH)
    features = features.withColumn("label", F.when(F.col(f"{CH[0]}_mean") > mean, "busy").otherwise("calm"))
    split = O.subject_split(_subjects(spark, sf)).withColumn("part", F.when(F.col("split") == "train", "train").otherwise("held_out"))
    path = scratch_path(spark, "features")
    features.join(split.select("subject_id", "part"), "subject_id").write.parquet(path)
    rows = spark.read.parquet(path)
    model = TR.fit(rows.where(F.col("part") == "train"), CH)
    right = F.avg((F.col("y_pred") == F.col("y_true")).cast("double"))
    busy = F.avg((F.col("label") == "busy").cast("double"))
    return model.transform(rows).groupBy("part").agg(
        F.count("*").alias("n_windows"), F.count_distinct("label").alias("n_labels"),
        (right > F.greatest(busy, 1 - busy)).alias("beats_majority"))


def q_alert_flags(spark, sf):
    p, _ = _predictions(spark, sf, None)
    return _r6(M.alert_flags(p, M.loss_threshold(p, 0.95)).select("vec_id", "xentropy", "alert"))


def _history(spark, sf):
    """History of a training that sees more of the training rows in every
    epoch: epoch e of 3 has learned from the first e thirds of them (in md5
    order).  The training rows are shuffled per epoch, cut into batches of
    64, and each batch's mean loss and correct count are recorded; val_acc
    is the accuracy on the held-out rows."""
    parts = []
    for epoch in (1, 2, 3):
        p, _ = _predictions(spark, sf, None, fraction=0.8 * epoch / 3)
        right = F.col("y_true") == F.col("y_pred")
        tr = O.batch_ids(O.shuffle_order(p.where(F.col("split") == "train"), 42, epoch, "vec_id"), 64)
        b = tr.groupBy("batch").agg(F.count("*").alias("n"), F.avg("xentropy").alias("loss"),
                                    F.sum(right.cast("long")).alias("correct")).withColumn("epoch", F.lit(epoch))
        val = p.where(F.col("split") == "held_out").agg(F.avg(right.cast("double")).alias("val_acc"))
        parts.append(M.epoch_metrics(b).withColumn("val_acc", val.scalar()))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_epoch_metrics(spark, sf):
    return _r6(_history(spark, sf))


def q_best_epoch(spark, sf):
    return _r6(M.best_epoch(_history(spark, sf)))


# -- arrays, JSON, messages and streaming ------------------------------------

def q_json_roundtrip(spark, sf):
    """JSON decoded and encoded again; every seventh text is damaged and
    gives NULL."""
    ev = TB.table(spark, sf, "events")
    ev = ev.withColumn("props", F.when(F.col("event_id") % 7 == 0, F.replace("props", F.lit(":"), F.lit(";"))).otherwise(F.col("props")))
    parsed = F.from_json("props", "k int")
    return ev.select("event_id", parsed["k"].alias("k"), F.when(parsed["k"].isNotNull(), F.to_json(parsed)).alias("json"))


def q_finite_windows(spark, sf):
    """Windows kept by the finite filter (no NULL, NaN or +-Inf value), of a
    grid with some of each."""
    x, i = F.col("x"), F.col("i")
    dirty = (F.when(i % 97 == 5, F.lit(float("nan"))).when(i % 89 == 7, F.lit(float("-inf")))
             .when(i % 83 == 11, F.lit(None).cast("double")).otherwise(x))
    w = finite_windows(windows_from_grid(_grid(spark, sf).withColumn("x", dirty), SPEC, SIZE, STEP))
    return w.select("subject_id", "device", F.col("activity").alias("label"), "k")


def q_flatten_reshape(spark, sf):
    w = _windows_raw(spark, sf)
    rows = reshape("features", len(CH))
    return w.select("subject_id", "device", F.col("activity").alias("label"), "k",
                    F.size(rows).alias("n_rows"), F.size(rows[0]).alias("n_cols"),
                    (F.flatten(rows) == F.col("features")).alias("same"))


def q_window_messages(spark, sf):
    w = _windows_raw(spark, sf).withColumnRenamed("activity", "label")
    msgs = MS.window_messages(w, len(CH))
    d = MS.decode(msgs.select("value"))
    return d.select("device", "subject_id", "activity", "seq", F.size("features").alias("n_rows"),
                    F.size(F.col("features")[0]).alias("n_cols"), "valid")


def q_stream_events(spark, sf):
    """Events replayed as a file stream (a few files per trigger), decoded
    into readings by the same plan as the batch path."""
    q, path = CS.run_append(spark, TB.decode_events(spark, TB.stream(spark, sf, "events")), "stream-events")
    q.awaitTermination()
    out = spark.read.parquet(path)
    return out.select("event_id", *KEY, "sensor", "timestamp", round6("x").alias("x"), round6("y").alias("y"))


def _letter_embeddings(spark, sf):
    """Embeddings as labelled windows: label i -> the i-th activity code."""
    codes = F.array(*[F.lit(c) for c, _ in SCH.ACTIVITY_NAMES])
    e = _emb(spark, sf)
    letter = F.coalesce(F.get(codes, F.col("label")), F.concat(F.lit("Class-"), F.col("label").cast("string")))
    return e.select(F.col("vec_id").cast("string").alias("subject_id"), (F.col("vec_id") % 2).cast("int").alias("device"),
                    letter.alias("label"), F.lit(0).cast("long").alias("k"),
                    F.col("embedding").cast("array<double>").alias("features"), "split")


# replay sizing: messages per published file and files per micro-batch
# (a trigger takes about 4,000 messages, more where that would be over
# MS.TRIGGERS micro-batches; the number of files grows with the data, never
# with a per-message delay)
MESSAGES_PER_FILE = 1000
FILES_PER_TRIGGER = 4


def _message_files(spark, sf):
    """Producer: held-out embedding windows published as JSON lines; the
    model is fitted on the training windows."""
    lw = _letter_embeddings(spark, sf)
    model = SC.CentroidModel.fit(lw.where(F.col("split") == "train"), "features", "label")
    msgs = MS.window_messages(lw.where(F.col("split") == "held_out").drop("split"), 1)
    path = scratch_path(spark, "messages")
    MS.publish_files(msgs, path, rows_per_file=MESSAGES_PER_FILE)
    return path, model


def _scored_stream(spark, sf):
    path, model = _message_files(spark, sf)
    raw = MS.read_files(spark, path, MS.files_per_trigger(spark, path, FILES_PER_TRIGGER))
    return CS.score_messages(MS.decode(raw, channels=1), model, 1, normalize=False), path, model


def q_dead_letter(spark, sf):
    """Damaged copies among the messages (no features, cut JSON, an empty
    matrix, a NULL cell): the stream sends them, and only them, to the
    dead-letter sink."""
    path, model = _message_files(spark, sf)
    value, seq = F.col("value"), F.regexp_extract("value", r'"seq":(\d+)', 1).cast("long")
    sent = spark.read.text(path).withColumn("damage", seq % 7)
    bad = sent.where(F.col("damage").between(1, 4)).select(
        F.when(F.col("damage") == 1, F.regexp_replace(value, r'"features":\[.*\]\]', '"features":null'))
        .when(F.col("damage") == 2, F.regexp_replace(value, r"\}$", ""))
        .when(F.col("damage") == 3, F.regexp_replace(value, r'"features":\[.*\]\]', '"features":[]'))
        .otherwise(F.regexp_replace(value, r'"features":\[\[[^\]]*\]', '"features":[[null]')).alias("value"))
    both = scratch_path(spark, "damaged")
    MS.publish_files(sent.select("value").unionByName(bad), both, MESSAGES_PER_FILE)
    decoded = MS.decode(MS.read_files(spark, both, MS.files_per_trigger(spark, both, FILES_PER_TRIGGER)), model.dims, 1)
    q, out = CS.run_append(spark, CS.dead_letters(decoded), "dead-letters")
    q.awaitTermination()
    return spark.read.parquet(out).select(seq.alias("seq"), (seq % 7).alias("damage"))


def q_rejected_readings(spark, sf):
    return TB.rejected_events(TB.table(spark, sf, "events"))


_SCORE_COLS = ["seq", "device", "subject_id", "activity", "pred_letter", "pred_name", "truth_name", "confidence", "correct"]


def q_stream_scores(spark, sf):
    scored, _, _ = _scored_stream(spark, sf)
    q, out = CS.run_append(spark, scored.select(*_SCORE_COLS), "stream-scores")
    q.awaitTermination()
    return _r6(spark.read.parquet(out))


def q_stream_accuracy(spark, sf):
    scored, _, _ = _scored_stream(spark, sf)
    q, log = CS.run_update(spark, CS.accuracy_state(scored, ["device"]), "stream-accuracy", ["device"])
    q.awaitTermination()
    return _r6(CS.read_changelog(spark, log, ["device"]))


def q_latest_per_key(spark, sf):
    scored, _, _ = _scored_stream(spark, sf)
    agg = CS.latest_state(scored, ["device"], "seq", ["subject_id", "pred_letter", "confidence"])
    q, log = CS.run_update(spark, agg, "latest", ["device"])
    q.awaitTermination()
    return _r6(CS.read_changelog(spark, log, ["device"]))


def q_stream_scores_windows(spark, sf):
    """Real windows (24 x 4) in the stream, normalised per window and channel
    by the consumer: activities are letters by week, the model knows the
    normalised windows of the training subjects, the others' are sent."""
    codes = F.array(*[F.lit(c) for c, _ in SCH.ACTIVITY_NAMES])
    week = F.substring("activity", 2, 9).cast("int")
    w = _windows_raw(spark, sf).withColumn("label", F.get(codes, week % len(SCH.ACTIVITY_NAMES))).drop("activity")
    train = O.subject_split(_subjects(spark, sf)).where(F.col("split") == "train").select("subject_id", F.lit(True).alias("train"))
    path = scratch_path(spark, "windows")
    w.join(train, "subject_id", "left").write.parquet(path)
    w = spark.read.parquet(path)
    model = SC.CentroidModel.fit(zscore_features(w.where("train"), len(CH)), "features", "label")
    sent = scratch_path(spark, "messages")
    MS.publish_files(MS.window_messages(w.where("train is null").drop("train"), len(CH)), sent, MESSAGES_PER_FILE)
    decoded = MS.decode(MS.read_files(spark, sent, MS.files_per_trigger(spark, sent, FILES_PER_TRIGGER)), SIZE, len(CH))
    scored = CS.score_messages(decoded, model, len(CH), normalize=True)
    q, out = CS.run_append(spark, scored.select(*_SCORE_COLS), "stream-windows")
    q.awaitTermination()
    return _r6(spark.read.parquet(out))


def q_running_accuracy(spark, sf):
    """Batch twin of the stream: accuracy after each message, per device,
    in publish order."""
    path, model = _message_files(spark, sf)
    scored = CS.score_messages(MS.decode(spark.read.text(path), channels=1), model, 1, normalize=False)
    r = RN.running_accuracy(scored, ["device"], ["seq"])
    return _r6(r.select("device", "seq", "n_seen", "n_correct", "running_accuracy"))


def q_latest_per_subject(spark, sf):
    """The last window sent of every subject and device, from the stream of
    real windows; small triggers and a log that is compacted on the way."""
    w = _windows_raw(spark, sf).withColumnRenamed("activity", "label")
    path = scratch_path(spark, "messages")
    MS.publish_files(MS.window_messages(w, len(CH)), path, rows_per_file=MESSAGES_PER_FILE)
    key = ["device", "subject_id"]
    msgs = MS.decode(MS.read_files(spark, path, MS.files_per_trigger(spark, path, 2))).where("valid")
    agg = CS.latest_state(msgs.withColumn("last_x", F.element_at("features", -1)[0]), key, "seq", ["activity", "last_x"])
    q, log = CS.run_update(spark, agg, "latest-subject", key, compact_every=2)
    q.awaitTermination()
    return _r6(CS.read_changelog(spark, log, key))


def q_message_progress(spark, sf):
    """Messages sent, damaged copies sent, and what the consumer read of
    them: all, valid, dead letters."""
    progress = CS.Progress()
    lw = _letter_embeddings(spark, sf)
    msgs = MS.window_messages(lw.where(F.col("split") == "held_out").drop("split"), 1)
    path = scratch_path(spark, "messages")
    MS.publish_files(progress.counted(msgs, "sent"), path, rows_per_file=MESSAGES_PER_FILE)
    damaged = spark.read.text(path).where(F.regexp_extract("value", r'"seq":(\d+)', 1).cast("long") % 7 == 2)
    cut = damaged.select(F.regexp_replace("value", r"\}$", "").alias("value"))
    MS.publish_files(progress.counted(cut, "damaged"), f"{path}-damaged", rows_per_file=MESSAGES_PER_FILE)
    spark.streams.addListener(progress)
    try:
        msgs = MS.decode(MS.read_files(spark, f"{path}*", MS.files_per_trigger(spark, f"{path}*", FILES_PER_TRIGGER)), channels=1)
        msgs = progress.counted(msgs, "read", valid=F.col("valid"), dead=~F.col("valid"))
        q, _ = CS.run_append(spark, msgs.select("seq", "valid"), "progress")
        progress.await_end(q)
    finally:
        spark.streams.removeListener(progress)
    read = progress.totals("read")
    rows = [("sent", progress.totals("sent")["rows"]), ("damaged", progress.totals("damaged")["rows"]),
            ("read", read["rows"]), ("valid", read["valid"]), ("dead", read["dead"])]
    return spark.createDataFrame(rows, "counter string, n long")


def q_stream_alert_flags(spark, sf):
    """The alerts of ``alert_flags``, in a stream of the embeddings with the
    stored threshold read for every micro-batch."""
    p, _ = _predictions(spark, sf, None)
    path = scratch_path(spark, "threshold")
    M.loss_threshold(p, 0.95).write.parquet(path)
    model, _ = _model(spark, sf)
    rows = model.with_logits(model.index(TB.stream(spark, sf, "embeddings"), "label", "y_true"), "embedding")
    scored = SC.with_scores(rows, "logits", "y_true").select("vec_id", "xentropy")
    q, out = CS.run_alerts(spark, scored, path, "stream-alerts")
    q.awaitTermination()
    return _r6(CS.read_batches(spark, out).select("vec_id", "xentropy", "alert"))


def q_stream_running_accuracy(spark, sf):
    """The report line of every message in the stream, with the accuracy
    after it, per device, in the order in which messages were sent."""
    path, model = _message_files(spark, sf)
    raw = MS.read_files(spark, path, max_files_per_trigger=FILES_PER_TRIGGER)
    scored = CS.score_messages(MS.place_of(MS.decode(raw, channels=1)), model, 1, normalize=False, keep_invalid=True)
    q, out = CS.run_append(spark, CS.running_accuracy_state(scored, ["device"]), "stream-running")
    q.awaitTermination()
    return _r6(spark.read.parquet(out))


QUERIES = {
    "clean_numeric": q_clean_numeric,
    "device_code": q_device_code,
    "sensor_readings": q_sensor_readings,
    "dedupe_series": q_dedupe_series,
    "overlap_bounds": q_overlap_bounds,
    "eligible_pairs": q_eligible_pairs,
    "rejected_series": q_rejected_series,
    "time_grid": q_time_grid,
    "resample_linear": q_resample_linear,
    "resample_clipped": q_resample_clipped,
    "resample_far": q_resample_far,
    "resample_kept": q_resample_kept,
    "window_slices": q_window_slices,
    "paired_series": q_paired_series,
    "interp_error": q_interp_error,
    "align_channels": q_align_channels,
    "sliding_windows": q_sliding_windows,
    "zscore_windows": q_zscore_windows,
    "zscore_sample": q_zscore_sample,
    "rejected_readings": q_rejected_readings,
    "windows_pipeline": q_windows_pipeline,
    "subject_split": q_subject_split,
    "split_sizes": q_split_sizes,
    "split_leakage": q_split_leakage,
    "semi_split": q_semi_split,
    "anti_split": q_anti_split,
    "common_activities": q_common_activities,
    "union_devices": q_union_devices,
    "hash_sample": q_hash_sample,
    "epoch_shuffle": q_epoch_shuffle,
    "batch_ids": q_batch_ids,
    "limit_n": q_limit_n,
    "sorted_series": q_sorted_series,
    "publish_order": q_publish_order,
    "filter_eq": q_filter_eq,
    "clip_to_overlap": q_clip_to_overlap,
    "window_counts": q_window_counts,
    "distinct_labels": q_distinct_labels,
    "row_counts": q_row_counts,
    "array_summary": q_array_summary,
    "channel_stats": q_channel_stats,
    "finite_check": q_finite_check,
    "corr_matrix": q_corr_matrix,
    "box_stats": q_box_stats,
    "histogram": q_histogram,
    "histogram_auto": q_histogram_auto,
    "score_histograms": q_score_histograms,
    "train_windows": q_train_windows,
    "paired_subjects": q_paired_subjects,
    "standardize": q_standardize,
    "melt_channels": q_melt_channels,
    "code_lookup": q_code_lookup,
    "trim_code": q_trim_code,
    "label_index": q_label_index,
    "resolve_labels": q_resolve_labels,
    "centroid_scores": q_centroid_scores,
    "softmax_scores": q_softmax_scores,
    "confusion_matrix": q_confusion_matrix,
    "classification_report": q_classification_report,
    "per_class_accuracy": q_per_class_accuracy,
    "p95_threshold": q_p95_threshold,
    "alert_flags": q_alert_flags,
    "epoch_metrics": q_epoch_metrics,
    "best_epoch": q_best_epoch,
    "json_roundtrip": q_json_roundtrip,
    "finite_windows": q_finite_windows,
    "flatten_reshape": q_flatten_reshape,
    "window_messages": q_window_messages,
    "stream_events": q_stream_events,
    "stream_scores": q_stream_scores,
    "stream_scores_windows": q_stream_scores_windows,
    "dead_letter": q_dead_letter,
    "stream_accuracy": q_stream_accuracy,
    "latest_per_key": q_latest_per_key,
    "running_accuracy": q_running_accuracy,
    "stream_running_accuracy": q_stream_running_accuracy,
    "latest_per_subject": q_latest_per_subject,
    "message_progress": q_message_progress,
    "stream_alert_flags": q_stream_alert_flags,
}


def all_queries() -> dict:
    return dict(QUERIES)
