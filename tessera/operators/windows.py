"""Count-based sliding windows over aligned grid rows, normalisation and
the finite-value filter.

Window ``k`` of a key covers grid indices ``[k*step, k*step + size - 1]``
for ``k = 0 .. (n - size) div step``; an incomplete tail is dropped.  A
grid row belongs to at most ``ceil(size / step)`` windows, so it is
copied that many times and the windows are formed by one ``groupBy(key,
k)``: every group holds exactly ``size`` rows, whatever the length of the
series, and a long series spreads over many groups.

Features are stored flat and row-major (``size x channels``), as arrays
of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera import schemas as S
from tessera.functions.columns import bound, finite_array, idiv
from tessera.operators.series import SeriesSpec, explode_range


def window_ids(i: Column, n: Column, size: int, step: int) -> Column:
    """Array of the window ids containing grid index ``i`` (may be empty)."""
    lo = F.greatest(F.lit(0).cast("long"), idiv(i - size + step, F.lit(step)))
    hi = F.least(idiv(i, F.lit(step)), idiv(n - size, F.lit(step)))
    # sequence(lo, hi) would count down when lo > hi: guard it
    return F.when((n >= size) & (lo <= hi), F.sequence(lo, hi)).otherwise(F.array().cast("array<long>"))


def count_windows(n: Column, size: int, step: int) -> Column:
    return F.when(n >= size, idiv(n - size, F.lit(step)) + 1).otherwise(F.lit(0)).cast("long")


def window_keys(ok_bounds: DataFrame, key: list[str], size: int = S.WINDOW_SIZE,
                step: int = S.STEP_SIZE) -> DataFrame:
    """(key..., k) of every window, from the grid length ``n`` alone.

    A usable key's grid lies inside the reading range of every sensor,
    and consecutive readings cover that range without gaps, so every grid
    index has a row and windows k = 0 .. (n - size) div step are all
    complete.  Key-only consumers (counts, splits, publish order) take
    this instead of resampling and gathering the windows: one row per
    window from one row per key, no shuffle of grid rows (of a long key's
    windows, a row for every 65,536)."""
    n = F.col("n")
    last = count_windows(n, size, step) - 1
    return explode_range(ok_bounds.where(n >= size), F.lit(0), last, "k", key).select(*key, "k")


def window_cells(aligned: DataFrame, key: list[str], channels: list[str], size: int = S.WINDOW_SIZE,
                 step: int = S.STEP_SIZE) -> DataFrame:
    """Aligned rows (key, i, n, channels...) -> one row per window and grid
    index in it: key, k, j (place in the window), channels.

    Every grid index of a usable key has a row, so the windows need not be
    gathered to be known complete: a row is copied to the windows that
    hold it, without a shuffle."""
    rows = aligned.select(*key, "i", F.explode(window_ids(F.col("i"), F.col("n"), size, step)).alias("k"), *channels)
    return rows.select(*key, "k", (F.col("i") - F.col("k") * step).alias("j"), *channels)


def melt(cells: DataFrame, channels: list[str], keep: list[str]) -> DataFrame:
    """A column per channel -> a row per channel (keep..., channel, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("channel"), F.col(c).alias("value")) for c in channels])
    return cells.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.channel", "_p.value")


def sliding_windows(aligned: DataFrame, key: list[str], channels: list[str],
                    size: int = S.WINDOW_SIZE, step: int = S.STEP_SIZE) -> DataFrame:
    """Aligned rows (key, i, n, channels...) -> one row per window:
    key, k, features (flat row-major array of size*len(channels))."""
    rows = aligned.select(*key, "i", F.explode(window_ids(F.col("i"), F.col("n"), size, step)).alias("k"),
                          *channels)
    grouped = rows.groupBy(*key, "k").agg(
        F.array_sort(F.collect_list(F.struct("i", *channels))).alias("_rows"))
    feats = F.flatten(F.transform("_rows", lambda r: F.array(*[r[c] for c in channels])))
    return (grouped.where(F.size("_rows") == size)
            .select(*key, "k", feats.alias("features")))


def windows_from_grid(grid: DataFrame, spec: SeriesSpec, size: int = S.WINDOW_SIZE,
                      step: int = S.STEP_SIZE, zscore: bool = False, ddof: int = 0,
                      eps: float = S.ZSCORE_EPS, finite_only: bool = False,
                      check_inf: bool = True) -> DataFrame:
    """Align and window in one shuffle.

    ``grid`` has one row per (key, sensor, i) (the output of
    ``resample``).  Each row is sent to its windows; a window gathers its
    ``size x len(sensors)`` sensor rows, orders them by (i, sensor) and
    flattens them into ``[s1 axes..., s2 axes...]`` per grid index
    (row-major ``size x channels``).  Per-channel mean and deviation, and
    whether every value is finite, are aggregates of the same groupBy, so
    normalising and the finite filter cost no extra pass over the array.
    """
    key = list(spec.key)
    sidx = F.lit(None).cast("int")
    for pos, s in enumerate(spec.sensors):
        sidx = F.when(F.col(spec.sensor) == F.lit(s), F.lit(pos)).otherwise(sidx)
    rows = grid.select(*key, "i", sidx.alias("_s"),
                       F.explode(window_ids(F.col("i"), F.col("n"), size, step)).alias("k"),
                       *spec.axes)
    aggs = [F.collect_list(F.struct("i", "_s", *spec.axes)).alias("_rows")]
    if finite_only:
        ok = None
        for a in spec.axes:
            c = F.col(a).isNotNull() & ~F.isnan(a)
            if check_inf:
                c = c & (F.abs(a) != F.lit(float("inf")))
            ok = c if ok is None else (ok & c)
        aggs.append(F.bool_and(ok).alias("_ok"))
    if zscore:
        std = F.stddev_pop if ddof == 0 else F.stddev_samp
        for pos, _ in enumerate(spec.sensors):
            for a in spec.axes:
                v = F.when(F.col("_s") == pos, F.col(a))
                aggs += [F.avg(v).alias(f"_m{pos}_{a}"), std(v).alias(f"_d{pos}_{a}")]
    g = rows.groupBy(*key, "k").agg(*aggs)
    cond = F.size("_rows") == size * len(spec.sensors)
    if finite_only:
        cond = cond & F.col("_ok")
    g = g.where(cond)

    def cell(r, a):
        if not zscore:
            return r[a]
        m = d = None
        for pos in reversed(range(len(spec.sensors))):
            m = F.col(f"_m{pos}_{a}") if m is None else F.when(r["_s"] == pos, F.col(f"_m{pos}_{a}")).otherwise(m)
            d = F.col(f"_d{pos}_{a}") if d is None else F.when(r["_s"] == pos, F.col(f"_d{pos}_{a}")).otherwise(d)
        return (r[a] - m) / (d + F.lit(eps))

    feats = F.flatten(F.transform(F.array_sort("_rows"), lambda r: F.array(*[cell(r, a) for a in spec.axes])))
    return g.select(*key, "k", feats.alias("features"))


def zscore_features(df: DataFrame, channels: int, features: str = "features", ddof: int = 0,
                    eps: float = S.ZSCORE_EPS, out: str | None = None) -> DataFrame:
    """Per-window, per-channel z-score of a flat row-major array column:
    (v - mean_c) / (std_c + eps); population std for ddof=0, sample std
    for ddof=1.

    Linear in the array length: a channel's sum visits that channel's places
    alone, and the per-channel mean and deviation are repeated to the array
    length and combined with ``zip_with``.  The array and its differences
    from the means are bound (``bound``), so that Catalyst can inline neither
    into the lambda bodies, to be evaluated again for every element."""
    def rows(arr) -> Column:
        return (F.size(arr) / channels).cast("int")

    def chan(arr, c: int) -> Column:
        places = F.sequence(F.lit(c), F.greatest(F.size(arr) - 1, F.lit(c)), F.lit(channels))
        return F.transform(places, lambda j: F.get(arr, j))

    def chan_sum(arr, c: int) -> Column:
        return F.aggregate(chan(arr, c), F.lit(0.0), lambda acc, v: acc + v)

    def chan_squares(arr, c: int) -> Column:
        return F.aggregate(chan(arr, c), F.lit(0.0), lambda acc, v: acc + v * v)

    def repeated(arr, of) -> Column:
        return F.flatten(F.array_repeat(F.array(*[of(c) for c in range(channels)]), rows(arr)))

    dev = bound(F.col(features), lambda f: F.zip_with(
        f, repeated(f, lambda c: chan_sum(f, c) / rows(f)), lambda v, m: v - m))
    norm = bound(dev, lambda d: F.zip_with(
        d, repeated(d, lambda c: F.sqrt(chan_squares(d, c) / (rows(d) - ddof))), lambda v, s: v / (s + F.lit(eps))))
    return df.withColumn(out or features, norm)


def finite_windows(windows: DataFrame, features: str = "features", check_inf: bool = True) -> DataFrame:
    """Drop windows holding NULL, NaN or (with ``check_inf``) +-Inf."""
    return windows.where(finite_array(features, check_inf))
