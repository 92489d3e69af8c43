"""Composite plans: readings -> windows, as one lazy Spark plan.

``build_windows`` chains clean readings -> cluster -> dedupe -> bounds ->
eligibility -> resample -> align + window (-> z-score) -> finite filter
for every subject, device and activity at once.  Bad data becomes
rejected rows (``rejections``), never an exception.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import schemas as S
from tessera.operators import series as T
from tessera.operators.windows import windows_from_grid


@dataclass
class WindowsResult:
    windows: DataFrame
    grid: DataFrame
    bounds: DataFrame
    deduped: DataFrame


def build_windows(readings: DataFrame, spec: T.SeriesSpec, size: int = S.WINDOW_SIZE,
                  step: int = S.STEP_SIZE, zscore: bool = False, ddof: int = 0,
                  check_inf: bool = True, partitions: int | None = None,
                  drop_nonfinite: bool = True, materialize: bool = False) -> WindowsResult:
    """All windows of all keys.  ``readings`` needs the key columns, the
    sensor, an integer timestamp and the axes.

    Physical shape: one hash exchange of the readings on (key, sensor,
    time bucket) feeding the dedupe aggregate; the next-reading window and
    the bucket summary (first row, last timestamp, count per bucket; the
    bounds come from it) read the same columns and reuse that exchange;
    small exchanges for the bucket table and the bounds; one exchange of
    grid rows on (key, window).  With ``materialize`` the readings are
    kept as a bucketed table instead, which later plans read without an
    exchange.
    """
    dd = (T.kept_readings if materialize else T.clustered_readings)(readings, spec, partitions)
    summary = T.bucket_summary(dd, spec)
    bounds = T.classify(T.bounds_from_buckets(summary, spec), spec)
    grid = T.resample(dd, spec, bounds, summary)
    w = windows_from_grid(grid, spec, size, step, zscore=zscore, ddof=ddof,
                          finite_only=drop_nonfinite, check_inf=check_inf)
    return WindowsResult(windows=w, grid=grid, bounds=bounds, deduped=dd)


def rejections(bounds: DataFrame, spec: T.SeriesSpec) -> DataFrame:
    """Rejected keys with their reason (too few samples, short overlap,
    missing sensor, short grid)."""
    return T.rejected_series(bounds, spec).select(*spec.key, "reason")


def rejection_counts(bounds: DataFrame, spec: T.SeriesSpec) -> DataFrame:
    return rejections(bounds, spec).groupBy("reason").agg(F.count("*").alias("n_series"))
