"""Profiles of channel data: summary, per-channel moments, finite checks,
correlation matrix, box statistics, histograms and standardisation.

Inputs are long rows ``(group..., value)`` or wide rows with a column per
channel.  All aggregates are partial (map-side) aggregates.  Exact
quantiles count equal values first, then run over the different ones in
order and pick the two order statistics around each position (linear
interpolation, as NumPy's default and SQL ``quantile_cont``), so neither a
group's values nor the copies of one value are ever held in one buffer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import checkpoint_dir


def array_summary(long: DataFrame, channels: int, size: int) -> DataFrame:
    """Whole-array min, max, mean, sample std, number of windows and the
    window shape, from the long rows of windows of ``size`` x ``channels``."""
    return long.agg(F.min("value").alias("min"), F.max("value").alias("max"), F.avg("value").alias("mean"),
                    F.stddev_samp("value").alias("std"),
                    F.count("*").alias("n_values"),
                    (F.count("*") / (size * channels)).cast("long").alias("n_windows"),
                    F.lit(size).cast("long").alias("rows"),
                    F.lit(channels).alias("channels"))


def channel_stats(long: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Per channel: mean, population std, min, max, count."""
    g = [*(group or []), "channel"]
    return long.groupBy(*g).agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"),
                                F.min("value").alias("min"), F.max("value").alias("max"),
                                F.count("value").alias("n"))


def finite_check(long: DataFrame) -> DataFrame:
    """Per channel: any NaN, any +-Inf, any NULL."""
    v = F.col("value")
    return long.groupBy("channel").agg(
        F.bool_or(F.isnan(v)).alias("has_nan"),
        F.bool_or(F.abs(v) == F.lit(float("inf"))).alias("has_inf"),
        F.bool_or(v.isNull()).alias("has_null"))


def corr_matrix(wide: DataFrame, channels: list[str]) -> DataFrame:
    """Pearson correlation of every channel pair in ONE aggregation,
    returned long: (c1, c2, corr); the diagonal is 1 unless constant."""
    aggs = []
    for i, a in enumerate(channels):
        for b in channels[i:]:
            aggs.append(F.corr(a, b).alias(f"{a}__{b}"))
    one = wide.agg(*aggs)
    at = {c: i for i, c in enumerate(channels)}
    pairs = F.array(*[F.struct(F.lit(a).alias("c1"), F.lit(b).alias("c2"),
                               F.col("__".join(sorted((a, b), key=at.get))).alias("corr"))
                      for a in channels for b in channels])
    return one.select(F.explode(pairs).alias("p")).select("p.c1", "p.c2", "p.corr")


#: Name of a constant group.
ONE_GROUP = "_g"


def _per_group(stats: DataFrame, group: list[str]) -> DataFrame:
    """The per-group statistics side of a join back to the values.

    Grouped by channel alone it has one row per channel of a fixed list
    (a proven bound), so it is broadcast: a shuffle join on a handful of
    channel keys would put a whole channel into one task.  With wider
    groups its size grows with the data, so the join is left to the
    planner (AQE broadcasts it at run time if small, else sort-merge)."""
    return F.broadcast(stats) if list(group) in (["channel"], [ONE_GROUP]) else stats


def _number(weight: str | None) -> Column:
    """How many rows a group has: one each, or ``weight`` each."""
    return F.sum(weight) if weight else F.count(F.lit(1))


def counted_values(long: DataFrame, group: list[str], value: str = "value", weight: str | None = None) -> DataFrame:
    """Different values of each group with their number ``c`` (NULL and NaN
    left out), sorted by (group, value) over range partitions ``_pid`` and
    checkpointed.  A row counts ``weight`` times where that is given.

    Equal values become one row before anything is sorted, so a value that
    most rows share costs one row."""
    v = F.col(value)
    counts = (long.where(v.isNotNull() & ~F.isnan(v)).groupBy(*group, value)
              .agg(_number(weight).alias("c")))
    checkpoint_dir(long.sparkSession)
    return counts.orderBy(*group, value).withColumn("_pid", F.spark_partition_id()).checkpoint()


def quantiles_from_counts(counted: DataFrame, group: list[str], probs: list[float],
                          value: str = "value") -> DataFrame:
    """(group..., p, q) from ``counted_values``: the order statistics around
    ``p * (n - 1)``, interpolated linearly.

    The totals of the partitions (one row a partition and group) tell which
    partition holds a position; only those are counted through."""
    at = ["_pid", *group]
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    parts = counted.groupBy(*at).agg(F.sum("c").alias("_t"))
    parts = parts.select(*at, "_t", (F.sum("_t").over(before) - F.col("_t")).alias("_o"),
                         F.sum("_t").over(Window.partitionBy(*group)).alias("_n"))
    h = F.col("p") * (F.col("_n") - 1).cast("double")
    want = (parts.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
            .withColumns({"_lo": F.floor(h), "_f": h - F.floor(h), "_hi": F.ceil(h)})
            .withColumn("_pos", F.explode(F.array_distinct(F.array("_lo", "_hi"))))
            .where((F.col("_pos") >= F.col("_o")) & (F.col("_pos") < F.col("_o") + F.col("_t")))
            .select(*at, "p", "_lo", "_hi", "_f", "_pos", "_o"))
    rows = counted.join(_per_group(want.select(*at).distinct(), group), at, "left_semi")
    run = Window.partitionBy(*at).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select(*at, value, "c", F.sum("c").over(run).alias("_cum"))
    end = F.col("_o") + F.col("_cum")
    got = rows.join(_per_group(want, group), at).where((F.col("_pos") >= end - F.col("c")) & (F.col("_pos") < end))
    q = got.groupBy(*group, "p").agg(F.max(F.when(F.col("_pos") == F.col("_lo"), F.col(value))).alias("_vlo"),
                                     F.max(F.when(F.col("_pos") == F.col("_hi"), F.col(value))).alias("_vhi"),
                                     F.max("_f").alias("_f"))
    return q.select(*group, "p", (F.col("_vlo") + F.col("_f") * (F.col("_vhi") - F.col("_vlo"))).alias("q"))


def exact_quantiles(long: DataFrame, group: list[str], probs: list[float], value: str = "value") -> DataFrame:
    """(group..., p, q): linear-interpolated quantiles per group, exact
    (NULL and NaN values excluded)."""
    return quantiles_from_counts(counted_values(long, group, value), group, probs, value)


def box_stats(long: DataFrame, group: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """Per channel: quartiles, IQR, whiskers (extreme values within 1.5 IQR
    of the box) and the number of outliers, all from the counted different
    values."""
    g = [*(group or []), "channel"]
    r = counted_values(long, g, weight=weight)
    q = quantiles_from_counts(r, g, [0.25, 0.5, 0.75])
    wide = q.groupBy(*g).agg(F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
                             F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("median"),
                             F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
    wide = wide.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    j = r.join(_per_group(wide, g), g)
    v = F.col("value")
    return j.groupBy(*g, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(v >= lo_f, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi_f, v)).alias("whisker_hi"),
        F.coalesce(F.sum(F.when((v < lo_f) | (v > hi_f), F.col("c"))), F.lit(0)).alias("n_outliers"))


def automatic_bins(long: DataFrame, group: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """Number of bins per channel by the larger of two rules: Sturges
    (log2 n + 1) and Freedman-Diaconis (width 2 IQR / cube root of n), as
    plotting libraries choose it; at least 1."""
    g = [*(group or []), "channel"]
    q = quantiles_from_counts(counted_values(long, g, weight=weight), g, [0.25, 0.75])
    iqr = q.groupBy(*g).agg((F.max("q") - F.min("q")).alias("_iqr"))
    v = F.col("value")
    n = long.where(v.isNotNull() & ~F.isnan(v)).groupBy(*g).agg(
        _number(weight).alias("_n"), (F.max("value") - F.min("value")).alias("_range"))
    width = 2 * F.col("_iqr") / F.pow(F.col("_n").cast("double"), F.lit(1.0 / 3))
    sturges = F.ceil(F.log2(F.col("_n").cast("double")) + 1)
    wide = F.when(width > 0, F.ceil(F.col("_range") / width)).otherwise(F.lit(1))
    bins = F.when(F.col("_range") == 0, F.lit(1)).otherwise(F.greatest(sturges, wide))
    return n.join(_per_group(iqr, g), g).select(*g, bins.cast("int").alias("bins"))


def histogram(long: DataFrame, bins: int | DataFrame = 30, group: list[str] | None = None,
              weight: str | None = None) -> DataFrame:
    """Equal-width bins over [min, max] per channel, the last bin closed;
    every bin is reported, empty ones with count 0.  ``bins`` is a number, or
    a table with a number for each group (as ``automatic_bins`` gives)."""
    g = [*(group or []), "channel"]
    v = F.col("value")
    rng = long.where(v.isNotNull() & ~F.isnan(v)).groupBy(*g).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    if isinstance(bins, DataFrame):
        rng = rng.join(_per_group(bins.select(*g, F.col("bins").alias("_bins")), g), g)
    else:
        rng = rng.withColumn("_bins", F.lit(bins))
    n, width = F.col("_bins"), F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((v - F.col("lo")) / width * n), n - 1)).cast("int")
    counts = long.join(_per_group(rng, g), g).where(v.isNotNull() & ~F.isnan(v)).groupBy(*g, b.alias("bin")).agg(
        _number(weight).alias("count"))
    all_bins = rng.select(*g, "lo", "hi", "_bins", F.explode(F.sequence(F.lit(0), n - 1)).alias("bin"))
    return (all_bins.join(counts, [*g, "bin"], "left")
            .select(*g, "bin",
                    (F.col("lo") + F.col("bin") * width / n).alias("edge_lo"),
                    (F.col("lo") + (F.col("bin") + 1) * width / n).alias("edge_hi"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def standardize(long: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Dataset-wide per-channel standardisation with the population std;
    a constant channel is divided by 1."""
    g = [*(group or []), "channel"]
    st = long.groupBy(*g).agg(F.avg("value").alias("_m"), F.stddev_pop("value").alias("_s"))
    s = F.when((F.col("_s") == 0) | F.col("_s").isNull(), F.lit(1.0)).otherwise(F.col("_s"))
    return long.join(_per_group(st, g), g).withColumn(
        "value", (F.col("value") - F.col("_m")) / s).drop("_m", "_s")
