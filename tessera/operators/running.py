"""Running (cumulative) aggregates without one task per key.

``running_sum`` sorts by (key, order) with range partitioning, cuts the
lineage with a checkpoint, sums within each sorted partition, and adds
the totals of the earlier partitions of the same key.  The table of
per-(partition, key) totals has at most (partitions + keys) rows, so a hot
key is spread over as many tasks as its rows fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.session import checkpoint_dir


def running_sums(df: DataFrame, key: list[str], order: list[str], values: dict[str, Column]) -> DataFrame:
    """Add, for each name -> expression in ``values``, its cumulative sum
    over rows of the same key in ``order`` (current row included); without a
    key over all rows."""
    checkpoint_dir(df.sparkSession)
    base = df.select("*", *[e.alias(f"_v_{n}") for n, e in values.items()])
    s = (base.orderBy(*key, *order)
         .withColumn("_pid", F.spark_partition_id())
         .withColumn("_mid", F.monotonically_increasing_id())
         .checkpoint(eager=True))
    w = Window.partitionBy("_pid", *key).orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    local = s.select("*", *[F.sum(f"_v_{n}").over(w).alias(f"_l_{n}") for n in values])
    tot = s.groupBy("_pid", *key).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    before = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_pid", *key, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}")
                                     for n in values])
    out = local.join(off, ["_pid", *key])
    for n in values:
        out = out.withColumn(n, F.col(f"_o_{n}") + F.col(f"_l_{n}"))
    drop = ["_pid", "_mid"] + [f"_{p}_{n}" for n in values for p in ("v", "l", "o")]
    return out.drop(*drop)


def running_accuracy(scored: DataFrame, key: list[str], order: list[str], correct: str = "correct") -> DataFrame:
    """Accuracy after each message, per key, in ``order``."""
    r = running_sums(scored, key, order, {"_n": F.lit(1).cast("long"), "_c": F.col(correct).cast("long")})
    return r.withColumn("running_accuracy", F.col("_c") / F.col("_n")) \
        .withColumnRenamed("_n", "n_seen").withColumnRenamed("_c", "n_correct")
