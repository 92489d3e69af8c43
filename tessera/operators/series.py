"""Irregular series -> regular grid.

A *series* is the readings of one sensor for one aligned key (for the
sensor data: subject, device, activity).  The operators here

* keep one reading per timestamp (``dedupe``),
* find the common time range of the paired sensors (``overlap_bounds``),
* classify each key as usable or rejected with a reason (``classify``),
* put a uniform grid over the range, both ends included (``time_grid``),
* interpolate every sensor linearly onto that grid (``resample``),
* and stack the sensors into one multi-channel row per grid index
  (``align``).

Scale notes.  A single series may hold a large share of all rows, so no
operator puts a whole series into one task: readings are clustered by
``(key, sensor, bucket)`` where ``bucket`` is a fixed slice of time.
The next-reading lookup (``lead``) runs inside a bucket; the segments
that cross a bucket edge come from a table of each bucket's first and last
reading (one row per bucket with readings), and what they cover is dealt
over tasks, so that a gap of any length is filled by many.  The per-key
bounds are joined per bucket as well, so the reading side is never
re-shuffled and no broadcast is needed whatever the number of keys.

Grid index ranges are computed in exact integer arithmetic on offsets
from the range start (``decimal(38,0)``), never on absolute float
timestamps: ``ns * n`` passes 2**63 after a few hours at 50 Hz, and a
float ``ceil`` misplaces points that fall exactly on a reading.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera import schemas as S
from tessera.functions.columns import idiv
from tessera.session import scratch_path


@dataclass(frozen=True)
class SeriesSpec:
    """How to read a table of readings as paired series.

    key        aligned key columns (one grid per key), without the sensor
    sensor     column naming the sensor of a reading
    sensors    sensor values in channel order (all must be present)
    ts         integer timestamp column
    axes       reading columns of one sensor, in channel order
    period     grid step in timestamp units (1e9 / 50 for 50 Hz on ns);
               the grid has n = (b - a) div period points
    min_overlap  shortest accepted common range, timestamp units
    min_count  fewest distinct timestamps per sensor
    max_fill   most grid points per reading, where given: sparser keys (a
               reading far off all others fills the range between with
               points made of nothing) are then rejected; by default none
               is, and long gaps are filled by many tasks
    bucket     width of the time slices that spread one series over tasks;
               default 65,536 grid steps
    """

    key: tuple[str, ...] = ("subject_id", "device", "activity")
    sensor: str = "sensor"
    sensors: tuple[str, ...] = tuple(S.SENSORS)
    ts: str = "timestamp"
    axes: tuple[str, ...] = tuple(S.AXES)
    period: int | Fraction = S.NS_PER_SECOND // S.FREQ_HZ
    min_overlap: int = S.MIN_OVERLAP_NS
    min_count: int = 2
    max_fill: int | None = None
    bucket: int | None = None
    channel_names: tuple[str, ...] = field(default=())

    @property
    def bucket_width(self) -> int:
        return self.bucket if self.bucket else int(self.period * 65_536)

    @property
    def bucket_points(self) -> int:
        """Most grid points that a bucket holds (their distance is at least
        a period)."""
        return int(self.bucket_width / self.period) + 2

    @property
    def channels(self) -> list[str]:
        if self.channel_names:
            return list(self.channel_names)
        return [f"{s[0]}{a}" for s in self.sensors for a in self.axes]

    @property
    def series_key(self) -> list[str]:
        return [*self.key, self.sensor]

    @staticmethod
    def for_rate(hz: float, ts_units_per_second: int, **kw) -> "SeriesSpec":
        """Spec for a sampling rate; the step is kept as an exact fraction
        where it is no whole number of timestamp units (30 Hz on ns)."""
        return SeriesSpec(period=Fraction(ts_units_per_second) / Fraction(str(hz)), **kw)


def _cdiv(num: Column, n: Column, span: Column) -> Column:
    """ceil(num * (n - 1) / span) for num >= 0, span > 0, exactly."""
    d = "decimal(38,0)"
    return idiv(num.cast(d) * (n - 1).cast(d) + span.cast(d) - 1, span.cast(d)).cast("long")


#: Entries of an array that a row is expanded by at a time.
EXPAND = 65_536


def explode_range(df: DataFrame, lo: Column, hi: Column, name: str, deal: list[str] | None = None,
                  most: int | None = None) -> DataFrame:
    """One row for every integer from ``lo`` to ``hi`` (``lo <= hi``), in
    three steps (pieces of pieces), so that no array holds more than
    ``EXPAND`` of them up to ``EXPAND ** 3`` integers a row (in one step if
    a row has at most ``most``, no more than that).  With ``deal`` the pieces are dealt over tasks by the hash of those columns and the
    piece's number: a long range is then expanded by many tasks, and what is
    shuffled is a row for every ``EXPAND`` integers."""
    if deal is None and most is not None and most <= EXPAND:
        return df.withColumn(name, F.explode(F.sequence(lo.cast("long"), hi.cast("long"))))
    start, stop, block = F.col("_from"), F.col("_to"), EXPAND * EXPAND

    def pieces(rows: DataFrame, col: str, size: int, low: Column, high: Column) -> DataFrame:
        return rows.withColumn(col, F.explode(F.sequence(idiv(low, F.lit(size)), idiv(high, F.lit(size)))))

    # ranges start at zero for the division below (it truncates)
    rows = df.withColumns({"_base": lo.cast("long"), "_from": F.lit(0).cast("long"), "_to": (hi - lo).cast("long")})
    rows = pieces(rows, "_block", block, start, stop)
    at = F.col("_block") * block
    rows = pieces(rows, "_part", EXPAND, at, F.least(stop, at + (block - 1)))
    if deal is not None:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(n, *deal, "_block", "_part")
    at, base = F.col("_part") * EXPAND, F.col("_base")
    return (rows.withColumn(name, F.explode(F.sequence(base + at, base + F.least(stop, at + (EXPAND - 1)))))
            .drop("_base", "_from", "_to", "_block", "_part"))


# ---------------------------------------------------------------------------
# T1  one reading per timestamp
# ---------------------------------------------------------------------------

def with_bucket(readings: DataFrame, spec: SeriesSpec) -> DataFrame:
    return readings.withColumn("_bucket", F.floor(F.col(spec.ts) / F.lit(spec.bucket_width)).cast("long"))


def cluster(readings: DataFrame, spec: SeriesSpec, partitions: int | None = None) -> DataFrame:
    """Hash-cluster readings by (key, sensor, bucket): the one exchange the
    dedupe, the segment window and the per-bucket joins all reuse."""
    cols = [*spec.series_key, "_bucket"]
    # a reading without key, sensor or timestamp belongs to no series; the
    # explicit filter also keeps every branch below the exchange identical
    # (joins would otherwise push inferred NOT NULL filters into some
    # branches only and defeat exchange reuse)
    keyed = None
    for c in [*spec.series_key, spec.ts]:
        keyed = F.col(c).isNotNull() if keyed is None else (keyed & F.col(c).isNotNull())
    df = readings.where(keyed)
    df = df if "_bucket" in df.columns else with_bucket(df, spec)
    df = df.where(F.col("_bucket").isNotNull())
    # an explicit count keeps a fixed hash partitioning (AQE does not merge
    # it), which a checkpoint of this frame then reports to later operators
    n = partitions or int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols)


def clustered_readings(readings: DataFrame, spec: SeriesSpec, partitions: int | None = None) -> DataFrame:
    """Cluster and de-duplicate the readings.

    Its consumers in ``resample`` (the segment window and the bucket
    summary, from which the bounds are derived) read the same columns, so
    Spark reuses one exchange of the readings for both.  Plans that read the
    readings many more times take ``kept_readings``."""
    return dedupe(cluster(readings, spec, partitions), spec)


def kept_readings(readings: DataFrame, spec: SeriesSpec, partitions: int | None = None,
                  table: str | None = None) -> DataFrame:
    """Clustered, de-duplicated readings kept as a table that is bucketed by
    (key, sensor, time bucket) and sorted by time, one file a bucket, in the
    shared folder.  Whatever groups or joins it by those columns, now or in a
    later plan, shuffles no reading.  ``drop_kept`` forgets it."""
    spark = readings.sparkSession
    cols = [*spec.series_key, "_bucket"]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = table or f"tessera_readings_{uuid.uuid4().hex[:12]}"
    (dedupe(cluster(readings, spec, n), spec).write.format("parquet").bucketBy(n, *cols).sortBy(*cols, spec.ts)
     .option("path", scratch_path(spark, name)).saveAsTable(name))
    return spark.table(name)


def drop_kept(spark: SparkSession, table: str) -> None:
    """Forget a kept table; its files go with the shared folder."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def dedupe(readings: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Keep one reading per (series, timestamp), taken whole (never
    per-column minima): a complete one before one with a NULL, then the
    smallest axes tuple, NULL after any value."""
    # (key, sensor, bucket, ts): the sort this aggregate needs is also the
    # order the next-reading window needs, so that window sorts nothing
    group = [*spec.series_key, *(["_bucket"] if "_bucket" in readings.columns else []), spec.ts]
    partial = F.array_contains(F.array(*[F.col(a).isNull() for a in spec.axes]), True).alias("_partial")
    ranked = [c for a in spec.axes for c in (F.col(a).isNull().alias(f"_no_{a}"), F.col(a))]
    best = F.min(F.struct(partial, *ranked)).alias("_r")
    return (readings.groupBy(*group).agg(best)
            .select(*group, *[F.col(f"_r.{a}").alias(a) for a in spec.axes]))


# ---------------------------------------------------------------------------
# T2-T4  common range and eligibility
# ---------------------------------------------------------------------------

def overlap_bounds(deduped: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per aligned key: per-sensor count/min/max and the common
    range a = max of the minima, b = min of the maxima.  A single
    aggregate with map-side partial aggregation, so a hot key costs one
    partial row per task."""
    aggs = []
    for s in spec.sensors:
        hit = F.col(spec.sensor) == F.lit(s)
        aggs += [
            F.count(F.when(hit, F.lit(1))).alias(f"n_{s}"),
            F.min(F.when(hit, F.col(spec.ts))).alias(f"min_{s}"),
            F.max(F.when(hit, F.col(spec.ts))).alias(f"max_{s}"),
        ]
    b = deduped.groupBy(*spec.key).agg(*aggs)
    a_col = F.greatest(*[F.col(f"min_{s}") for s in spec.sensors]) if len(spec.sensors) > 1 \
        else F.col(f"min_{spec.sensors[0]}")
    b_col = F.least(*[F.col(f"max_{s}") for s in spec.sensors]) if len(spec.sensors) > 1 \
        else F.col(f"max_{spec.sensors[0]}")
    return b.withColumn("a", a_col).withColumn("b", b_col)


def bucket_summary(deduped: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per (series, bucket): first and last reading (as structs),
    last timestamp and reading count.  It reads every column of ``deduped``,
    like the segment window, so both share one exchange of the readings."""
    sk = spec.series_key
    df = deduped if "_bucket" in deduped.columns else with_bucket(deduped, spec)
    reading = F.struct(F.col(spec.ts).alias("t"), *[F.col(a) for a in spec.axes])
    return df.groupBy(*sk, "_bucket").agg(F.min(reading).alias("f"), F.max(reading).alias("l"),
                                          F.max(spec.ts).alias("last"), F.count("*").alias("cnt"))


def bounds_from_buckets(summary: DataFrame, spec: SeriesSpec) -> DataFrame:
    """``overlap_bounds`` computed from the bucket summary (a table with
    one row per bucket), so the readings are not read a third time."""
    aggs = []
    for s in spec.sensors:
        hit = F.col(spec.sensor) == F.lit(s)
        aggs += [
            F.coalesce(F.sum(F.when(hit, F.col("cnt"))), F.lit(0)).alias(f"n_{s}"),
            F.min(F.when(hit, F.col("f.t"))).alias(f"min_{s}"),
            F.max(F.when(hit, F.col("last"))).alias(f"max_{s}"),
        ]
    b = summary.groupBy(*spec.key).agg(*aggs)
    a_col = F.greatest(*[F.col(f"min_{s}") for s in spec.sensors]) if len(spec.sensors) > 1 \
        else F.col(f"min_{spec.sensors[0]}")
    b_col = F.least(*[F.col(f"max_{s}") for s in spec.sensors]) if len(spec.sensors) > 1 \
        else F.col(f"max_{spec.sensors[0]}")
    return b.withColumn("a", a_col).withColumn("b", b_col)


def classify(bounds: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add ``n`` (grid points) and ``reason`` (NULL when usable).

    Reasons, first match wins: ``missing_sensor`` (a sensor has no
    reading), ``too_few_samples`` (< min_count distinct timestamps),
    ``short_overlap`` (b - a < min_overlap), ``short_grid`` (n < 2),
    ``sparse`` (more than ``max_fill`` grid points per reading, if given).
    """
    missing = None
    few = None
    for s in spec.sensors:
        m = F.col(f"n_{s}") == 0
        f_ = F.col(f"n_{s}") < spec.min_count
        missing = m if missing is None else (missing | m)
        few = f_ if few is None else (few | f_)
    span = F.col("b") - F.col("a")
    step = Fraction(spec.period)
    points = idiv(span, F.lit(step.numerator)) if step.denominator == 1 else idiv(
        span.cast("decimal(38,0)") * F.lit(step.denominator), F.lit(step.numerator).cast("decimal(38,0)"))
    n = F.when(span >= 0, points).cast("long")
    readings = F.lit(0).cast("long")
    for s in spec.sensors:
        readings = readings + F.col(f"n_{s}")
    reason = (F.when(missing, F.lit("missing_sensor"))
              .when(few, F.lit("too_few_samples"))
              .when(span < F.lit(spec.min_overlap), F.lit("short_overlap"))
              .when(n < 2, F.lit("short_grid")))
    if spec.max_fill is not None:
        reason = reason.when(n > readings * F.lit(spec.max_fill), F.lit("sparse"))
    return bounds.withColumn("n", n).withColumn("reason", reason)


def eligible(bounds: DataFrame, spec: SeriesSpec) -> DataFrame:
    c = bounds if "reason" in bounds.columns else classify(bounds, spec)
    return c.where(F.col("reason").isNull()).select(*spec.key, "a", "b", "n")


def rejected_series(bounds: DataFrame, spec: SeriesSpec) -> DataFrame:
    c = bounds if "reason" in bounds.columns else classify(bounds, spec)
    return c.where(F.col("reason").isNotNull())


# ---------------------------------------------------------------------------
# T5  grid
# ---------------------------------------------------------------------------

def time_grid(ok_bounds: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows (key, i, t_off): n points from a to b, both ends included;
    ``t_off`` = floor(i (b - a) / (n - 1)) is the exact integer offset
    from ``a``.  One row per grid point; use ``resample`` for values."""
    span = F.col("b") - F.col("a")
    return (explode_range(ok_bounds, F.lit(0), F.col("n") - 1, "i", list(spec.key))
            .withColumn("t_off", idiv(F.col("i").cast("decimal(38,0)") * span.cast("decimal(38,0)"),
                                      (F.col("n") - 1).cast("decimal(38,0)")).cast("long")))


# ---------------------------------------------------------------------------
# T6  linear interpolation onto the grid
# ---------------------------------------------------------------------------

def segments(deduped: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Consecutive readings [t, t2) of each series in one time bucket, with
    the values at both ends (``lead`` per (series, bucket))."""
    sk = spec.series_key
    df = deduped if "_bucket" in deduped.columns else with_bucket(deduped, spec)
    w = Window.partitionBy(*sk, "_bucket").orderBy(spec.ts)
    seg = df.select(*sk, "_bucket", F.col(spec.ts).alias("t"), *spec.axes, F.lead(spec.ts).over(w).alias("t2"),
                    *[F.lead(a).over(w).alias(f"{a}_2") for a in spec.axes])
    return seg.where(F.col("t2").isNotNull())


def crossings(summary: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The other segments: from the last reading of a bucket to the first of
    the next bucket with readings.  They come from the bucket summary alone,
    a row per bucket, so the readings take no part; gaps longer than a bucket
    are always among them."""
    sk = spec.series_key
    w = Window.partitionBy(*sk).orderBy("_bucket")
    seg = summary.select(*sk, "_bucket", "l", F.lead("f").over(w).alias("nf")).where(F.col("nf").isNotNull())
    return seg.select(*sk, "_bucket", "l.t", *[F.col(f"l.{a}").alias(a) for a in spec.axes], F.col("nf.t").alias("t2"),
                      *[F.col(f"nf.{a}").alias(f"{a}_2") for a in spec.axes])


def bounds_by_bucket(ok_bounds: DataFrame, summary: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Usable bounds for every (series, bucket) that has readings: a row per
    bucket, joined with the readings co-partitioned.  Buckets without
    readings (a gap, however long) cost nothing."""
    # the test of ``f`` (never NULL) has this branch read the same columns as
    # the others, so that all share one exchange of the readings
    return summary.where(F.col("f").isNotNull()).select(*spec.series_key, "_bucket").join(ok_bounds, on=list(spec.key))


def _covered(j: DataFrame) -> DataFrame:
    """Segments with bounds -> those that cover grid indices, and which:
    [t, t2), and n - 1 for the one that reaches ``b``."""
    a, b, n, t, t2 = (F.col(c) for c in ("a", "b", "n", "t", "t2"))
    span = b - a
    j = j.where((t < b) & (t2 > a))
    lo = _cdiv(F.greatest(t - a, F.lit(0)), n, span)
    hi = F.when(t2 >= b, n - 1).otherwise(_cdiv(t2 - a, n, span) - 1)
    return j.select("*", lo.alias("_lo"), hi.alias("_hi")).where(F.col("_lo") <= F.col("_hi"))


def interpolate(seg: DataFrame, spec: SeriesSpec, deal: bool = False) -> DataFrame:
    """Grid values from segments with bounds: each emits the grid indices it
    covers and the linear value at each.  With ``deal`` a long segment's
    pieces are dealt over tasks; without, segments lie within a bucket."""
    a, b, n, t, t2 = (F.col(c) for c in ("a", "b", "n", "t", "t2"))
    j = explode_range(_covered(seg), F.col("_lo"), F.col("_hi"), "i", spec.series_key if deal else None, spec.bucket_points)
    step = (b - a).cast("double") / (n - 1).cast("double")
    frac = (F.col("i").cast("double") * step - (t - a).cast("double")) / (t2 - t).cast("double")
    vals = [(F.col(x) + (F.col(f"{x}_2") - F.col(x)) * frac).alias(x) for x in spec.axes]
    return j.select(*spec.key, spec.sensor, "i", "n", *vals)


#: Grid times that a task looks up in the readings.
ERROR_POINTS = 400_000


def interpolation_error(grid: DataFrame, deduped: DataFrame, ok_bounds: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Check a stored grid against a fresh interpolation of the readings.

    The readings around every grid time are looked up anew, by order: grid
    times and readings of a (series, time bucket) are sorted together, and
    the last reading before and the first one after a grid time are its
    bracket (from the nearest bucket with readings where its own has none
    on that side).  Nothing of the resampling's index arithmetic is used.
    The number of tasks follows from the number of grid times, so that none
    sorts more of a larger table than of a small one.  Output: key, sensor,
    n_points and, per axis, the largest absolute difference."""
    sk, at = spec.series_key, [*spec.series_key, "_bucket"]
    bw = F.lit(spec.bucket_width)
    reading = F.struct(F.col(spec.ts).cast("double").alias("t"), *[F.col(x) for x in spec.axes])
    r = (deduped if "_bucket" in deduped.columns else with_bucket(deduped, spec)).select(*at, reading.alias("r"))
    a, n = F.col("a").cast("double"), F.col("n")
    ti = a + F.col("i").cast("double") * (F.col("b") - F.col("a")).cast("double") / (n - 1).cast("double")
    points = (ok_bounds.agg(F.sum("n").alias("s")).first()["s"] or 0) * len(spec.sensors)
    tasks = max(ok_bounds.sparkSession.sparkContext.defaultParallelism, -(-points // ERROR_POINTS))
    # bounds meet the grid by blocks of its indices: a long grid spreads over its blocks
    # (a task holds its bounds; the grid streams past them unsorted)
    blocks = explode_range(ok_bounds.select(*spec.key, "a", "b", "n"), F.lit(0), idiv(n - 1, F.lit(EXPAND)), "_chunk")
    g = (grid.select(*sk, "i", *[F.col(x).alias(f"_g_{x}") for x in spec.axes], idiv(F.col("i"), F.lit(EXPAND)).alias("_chunk"))
         .join(blocks.hint("shuffle_hash"), on=[*spec.key, "_chunk"]).withColumn("t", ti)
         .withColumn("_bucket", F.floor(F.col("t") / bw).cast("long")))
    none = F.lit(None)
    rows = r.select(*at, F.col("r.t").alias("t"), "r", none.cast("long").alias("i"),
                    *[none.cast("double").alias(f"_g_{x}") for x in spec.axes])
    kind = rows.schema["r"].dataType
    rows = rows.unionByName(g.select(*at, "t", none.cast(kind).alias("r"), "i", *[f"_g_{x}" for x in spec.axes]))
    # first and last reading of every bucket that has a row, and of the nearest ones on both sides
    # (of the grid the buckets alone: its rows are not sorted for this)
    ends = r.select(*at, "r").unionByName(g.select(*at).distinct().withColumn("r", none.cast(kind))).groupBy(*at).agg(F.min("r").alias("f"), F.max("r").alias("l"))
    series = Window.partitionBy(*sk).orderBy("_bucket")
    ends = ends.select(*at, F.last("l", True).over(series.rowsBetween(Window.unboundedPreceding, -1)).alias("_p"),
                       F.first("f", True).over(series.rowsBetween(1, Window.unboundedFollowing)).alias("_q"))
    # a reading comes before a grid time that falls on it
    w = Window.partitionBy(*at).orderBy("t", F.col("r").isNull())
    rows = rows.repartition(tasks, *at).select("*", F.last("r", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_before"),
                       F.first("r", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("_after"))
    rows = (rows.where(F.col("i").isNotNull()).join(ends, at)
            .withColumns({"p": F.coalesce("_before", "_p"), "q": F.coalesce("_after", "_q")}))
    span = F.col("q.t") - F.col("p.t")
    errs = []
    for x in spec.axes:
        on_line = F.col(f"p.{x}") + (F.col(f"q.{x}") - F.col(f"p.{x}")) * ((F.col("t") - F.col("p.t")) / span)
        again = F.when(F.col("q").isNull() | (span == 0), F.col(f"p.{x}")).when(
            F.col("p").isNull(), F.col(f"q.{x}")).otherwise(on_line)
        errs.append(F.max(F.abs(F.col(f"_g_{x}") - again)).alias(f"max_err_{x}"))
    return rows.groupBy(*spec.key, spec.sensor).agg(F.count("*").alias("n_points"), *errs)


def resample(deduped: DataFrame, spec: SeriesSpec, bounds: DataFrame | None = None,
             summary: DataFrame | None = None) -> DataFrame:
    """Linear interpolation of every sensor of every usable key onto its
    grid.  Output: key, sensor, i, n, axes (one row per sensor and grid
    point).  ``deduped`` should come from ``clustered_readings``."""
    if summary is None:
        summary = bucket_summary(deduped, spec)
    if bounds is None:
        bounds = bounds_from_buckets(summary, spec)
    ok = eligible(classify(bounds, spec), spec)
    inside = segments(deduped, spec).join(bounds_by_bucket(ok, summary, spec), [*spec.series_key, "_bucket"])
    across = crossings(summary, spec).join(ok, list(spec.key))
    return interpolate(inside, spec).unionByName(interpolate(across, spec, deal=True))


# ---------------------------------------------------------------------------
# T6b  clip first, keep duplicate times, extrapolate at the edges
# ---------------------------------------------------------------------------

def reading_times(clustered: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per (series, bucket, timestamp) with the first (``f``) and
    the last (``l``) of the readings at that time, in the order by which
    ``dedupe`` prefers them, and their number ``c``.  Readings between the
    two bear on no grid value."""
    partial = F.array_contains(F.array(*[F.col(a).isNull() for a in spec.axes]), True).alias("_partial")
    ranked = F.struct(partial, *[c for a in spec.axes for c in (F.col(a).isNull().alias(f"_no_{a}"), F.col(a))])
    return clustered.groupBy(*spec.series_key, "_bucket", F.col(spec.ts).alias("t")).agg(
        F.min(ranked).alias("f"), F.max(ranked).alias("l"), F.count("*").alias("c"))


def times_bounds(times: DataFrame, spec: SeriesSpec) -> DataFrame:
    """``overlap_bounds`` of all readings, duplicates counted."""
    per = times.groupBy(*spec.series_key, "_bucket").agg(F.struct(F.min("t").alias("t")).alias("f"), F.max("t").alias("last"),
                                                         F.sum("c").alias("cnt"))
    return bounds_from_buckets(per, spec)


def resample_clipped(readings: DataFrame, spec: SeriesSpec, partitions: int | None = None) -> DataFrame:
    """The exploratory variant of ``resample``: readings outside the common
    range are cut off first, several readings of one time stay, and grid
    points beyond a sensor's first or last reading in the range lie on the
    line of its first or last two times.

    Of several readings at one time the first (in the order of ``dedupe``)
    ends the segment before it and gives the value at that time, the last
    starts the segment after it.  Counts for eligibility are of all readings
    before the cut; keys of which a sensor keeps fewer than two different
    times in the range give no rows.  Output as ``resample``.

    Each series' first and last segments are known from a row per time
    bucket, so a hot series is never in one task."""
    sk, at = spec.series_key, [*spec.series_key, "_bucket"]
    times = reading_times(cluster(readings, spec, partitions), spec)
    ok = eligible(classify(times_bounds(times, spec), spec), spec)
    where_ = times.select(*at).distinct().join(ok, list(spec.key))
    cut = times.join(where_, at).where(F.col("t").between(F.col("a"), F.col("b")))
    reading = F.struct("t", "f", "l")
    per = cut.groupBy(*at, "a", "b", "n").agg(F.min(reading).alias("first"), F.max(reading).alias("final"),
                                              F.count("*").alias("c"))
    series = Window.partitionBy(*sk)
    ends = per.select("*", F.min("first.t").over(series).alias("_x0"), F.max("final.t").over(series).alias("_xm"),
                      F.sum("c").over(series).alias("_times"), F.lead("first").over(series.orderBy("_bucket")).alias("_next"))
    both = (ends.where(F.col("_times") > 1).select(*sk).distinct().groupBy(*spec.key).agg(F.count("*").alias("_s"))
            .where(F.col("_s") == len(spec.sensors)).select(*spec.key))
    ends = ends.join(both, list(spec.key))
    near = Window.partitionBy(*at).orderBy("t")
    inside = (cut.select(*at, "t", "f", "l", F.lead("t").over(near).alias("t2"), F.lead("f").over(near).alias("f2"))
              .where(F.col("t2").isNotNull()).join(ends.select(*at, "a", "b", "n", "_x0", "_xm"), at))
    across = ends.where(F.col("_next").isNotNull()).select(
        *at, "final.t", "final.f", "final.l", F.col("_next.t").alias("t2"), F.col("_next.f").alias("f2"), "a", "b", "n", "_x0", "_xm")
    return _on_lines(inside, spec, False).unionByName(_on_lines(across, spec, True))


def _on_lines(seg: DataFrame, spec: SeriesSpec, deal: bool) -> DataFrame:
    """Grid values of segments (t, t2]; a series' first segment reaches back
    to the grid's start, its last one on to the grid's end."""
    a, b, n, t, t2 = (F.col(c) for c in ("a", "b", "n", "t", "t2"))
    span, d = b - a, "decimal(38,0)"

    def below(x: Column) -> Column:
        return idiv((x - a).cast(d) * (n - 1).cast(d), span.cast(d)).cast("long")

    lo = F.when(t == F.col("_x0"), F.lit(0).cast("long")).otherwise(below(t) + 1)
    hi = F.when(t2 == F.col("_xm"), n - 1).otherwise(below(t2))
    j = seg.select("*", lo.alias("_lo"), hi.alias("_hi")).where(F.col("_lo") <= F.col("_hi"))
    # (the first and last segments reach beyond their bucket)
    j = explode_range(j, F.col("_lo"), F.col("_hi"), "i", spec.series_key if deal else None)
    on_first = (t == F.col("_x0")) & (F.col("i").cast(d) * span.cast(d) == (t - a).cast(d) * (n - 1).cast(d))
    step = span.cast("double") / (n - 1).cast("double")
    frac = (F.col("i").cast("double") * step - (t - a).cast("double")) / (t2 - t).cast("double")
    vals = [F.when(on_first, F.col(f"f.{x}")).otherwise(
        F.col(f"l.{x}") + (F.col(f"f2.{x}") - F.col(f"l.{x}")) * frac).alias(x) for x in spec.axes]
    return j.select(*spec.key, spec.sensor, "i", "n", *vals)


# ---------------------------------------------------------------------------
# T7  align sensors into channels
# ---------------------------------------------------------------------------

def align(grid: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per (key, i) with a column per channel, sensors in order."""
    chans = spec.channels
    aggs = []
    c = 0
    for s in spec.sensors:
        for a in spec.axes:
            aggs.append(F.max(F.when(F.col(spec.sensor) == F.lit(s), F.col(a))).alias(chans[c]))
            c += 1
    return grid.groupBy(*spec.key, "i", "n").agg(*aggs)
