"""Ordering, splitting and sampling without a single-task step.

``global_rank`` gives every row its exact 0-based position in a total
order: a range-partitioned sort, a checkpoint (so both uses below see
the same partitions even if an executor is lost), per-partition row
counts, and their running offsets.  The offsets table has one row per
partition, so its broadcast is bounded by the partition count, not the
data.  Splits, shuffles, batches and publish order are built on it.

Reproducible randomness is a hash: ``md5(seed:id)`` orders subjects and
rows the same way on any cluster size, unlike ``rand()`` or ``sample``
whose result depends on the partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera import schemas as S
from tessera.session import checkpoint_dir


def hash_key(seed, *cols: Column | str) -> Column:
    """md5 hex of ``seed:c1:c2...`` (a reproducible random order key)."""
    parts = [F.lit(str(seed))]
    for c in cols:
        parts.append(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))
    return F.md5(F.concat_ws(":", *parts))


def hash_threshold(fraction: float) -> str:
    """13-hex-digit threshold t with: md5 prefix < t  <=>  unit value < fraction
    (``fraction * 16**13`` is exact in a double, 16**13 being 2**52); a
    fraction of 1 or more gives a text above every prefix."""
    at = math.ceil(fraction * 16 ** 13)
    return format(max(at, 0), "013x") if at < 16 ** 13 else "g" * 13


def global_rank(df: DataFrame, order: list[Column | str], name: str = "rank",
                total: str | None = None) -> DataFrame:
    """Exact 0-based rank of every row in ``order`` (ties broken by the
    sort, so give a unique order for a deterministic result).  With
    ``total`` the row count of the whole frame is added as that column."""
    checkpoint_dir(df.sparkSession)
    s = (df.orderBy(*order)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_mid", F.monotonically_increasing_id())
           .checkpoint(eager=True))
    # row i of partition p has _mid = (p << 33) + i
    counts = s.groupBy("_pid").agg(F.count("*").alias("_c"))
    offsets = counts.select("_pid", F.coalesce(
        F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("_off"), F.sum("_c").over(Window.partitionBy()).alias("_tot"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = (s.join(F.broadcast(offsets), "_pid")  # one row per partition
             .withColumn(name, (F.col("_off") + local).cast("long")))
    if total:
        out = out.withColumnRenamed("_tot", total)
    return out.drop("_pid", "_mid", "_off", "_tot")


#: Consecutive ``k`` whose rows are numbered together.
SEQUENCE_BLOCK = 1024


def sequence_numbers(df: DataFrame, key: list[str], k: str, name: str = "seq", within: dict[str, list[str]] | None = None,
                     block: int = SEQUENCE_BLOCK) -> DataFrame:
    """Add each row's 0-based place in the order (key..., k), as
    ``global_rank`` does, without sorting the rows: the ``k`` of a key are
    counted in blocks, the blocks' counts are summed up in order by a
    distributed prefix sum, and a row finds its place in its block.  What is
    sorted is a row per block; a long key spreads over its blocks.

    ``within`` adds places among the rows that share a prefix of the key:
    name -> columns.  (key, k) must be unique; NULLs count as keys.  ``df`` is
    read twice: write it first where it is dear to compute."""
    from tessera.functions.columns import idiv
    from tessera.operators.running import running_sums

    at = idiv(F.col(k), F.lit(block)).alias("_block")
    cols = [*key, "_block"]
    counted = df.groupBy(*key, at).agg(F.sort_array(F.collect_list(k)).alias("_ks"))
    sums = running_sums(counted, [], cols, {"_end": F.size("_ks").cast("long")})
    sums = sums.select(*cols, "_ks", (F.col("_end") - F.size("_ks")).alias("_base"))
    names = {}
    for i, (other, prefix) in enumerate((within or {}).items()):
        starts = sums.groupBy(*prefix).agg(F.min("_base").alias(f"_start_{i}"))
        sums = null_safe_join(sums, starts, prefix)
        names[other] = f"_start_{i}"
    out = null_safe_join(df.withColumn("_block", at), sums, cols)
    place = F.col("_base") + F.array_position("_ks", F.col(k)) - 1
    return (out.withColumns({name: place.cast("long"), **{o: (place - F.col(c)).cast("long") for o, c in names.items()}})
            .drop("_block", "_ks", "_base", *names.values()))


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on equal or both NULL columns."""
    renamed = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return left.join(renamed, cond).drop(*[f"_on_{c}" for c in on])


def split_sizes(n: int, train: float = S.SPLIT_TRAIN, val: float = S.SPLIT_VAL) -> tuple[int, int, int]:
    n_train = math.ceil(train * n)
    n_val = math.floor(val * n)
    return n_train, n_val, n - n_train - n_val


def subject_split(df: DataFrame, subject: str = "subject_id", seed: int = S.SPLIT_SEED,
                  train: float = S.SPLIT_TRAIN, val: float = S.SPLIT_VAL) -> DataFrame:
    """Group-wise split: distinct subjects in md5(seed:id) order; the first
    ceil(train*n) are train, the next floor(val*n) val, the rest test.
    Returns (subject, split)."""
    subs = df.select(F.col(subject).cast("string").alias(subject)).where(F.col(subject).isNotNull()).distinct()
    ranked = global_rank(subs.withColumn("_h", hash_key(seed, subject)), [F.col("_h"), F.col(subject)],
                         "_r", total="_n")
    n = F.col("_n").cast("double")
    n_train = F.ceil(F.lit(train) * n)
    n_val = F.floor(F.lit(val) * n)
    return ranked.select(subject, F.when(F.col("_r") < n_train, F.lit("train"))
                         .when(F.col("_r") < n_train + n_val, F.lit("val"))
                         .otherwise(F.lit("test")).alias("split"))


def hash_sample(df: DataFrame, fraction: float, seed, *id_cols: str) -> DataFrame:
    """Bernoulli sample without replacement that does not depend on the
    partitioning: keep rows whose md5(seed:id), read as a number in [0, 1),
    is below ``fraction`` (compared as equal-length hex strings)."""
    prefix = F.substring(hash_key(seed, *id_cols), 1, 13)
    return df.where(prefix < F.lit(hash_threshold(fraction)))


def shuffle_order(df: DataFrame, seed, epoch: int, *id_cols: str, name: str = "pos") -> DataFrame:
    """Reproducible per-epoch shuffle: exact position in md5(seed:epoch:id) order."""
    keyed = df.withColumn("_h", hash_key(seed, F.lit(epoch), *id_cols))
    return global_rank(keyed, [F.col("_h"), *[F.col(c) for c in id_cols]], name).drop("_h")


def batch_ids(ranked: DataFrame, size: int, pos: str = "pos", name: str = "batch") -> DataFrame:
    """Fixed-size mini-batches over an exact position; the last is partial."""
    from tessera.functions.columns import idiv
    return ranked.withColumn(name, idiv(F.col(pos), F.lit(size)))


def splits_of(windows: DataFrame, subject: str = "subject_id") -> DataFrame:
    """Per subject of windows with a ``split``: windows and different splits."""
    per = windows.groupBy(subject, "split").agg(F.count("*").alias("_n"))
    return per.groupBy(subject).agg(F.sum("_n").alias("n_windows"), F.count("*").alias("n_splits"))


def leakage(windows: DataFrame, subject: str = "subject_id") -> DataFrame:
    """Subjects whose windows fall in more than one split (must be empty)."""
    return splits_of(windows, subject).where(F.col("n_splits") > 1)
