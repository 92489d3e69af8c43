"""Parquet sources and sinks for windows, predictions and thresholds."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schemas as S
from tessera.operators.order import null_safe_join
from tessera.operators.running import running_sums
from tessera.session import scratch_path


def read_parquet_excluding(spark: SparkSession, include: str, exclude_name: str | None = None) -> DataFrame:
    """Multi-file Parquet read with an include glob and an exclude-by-name
    rule on the file's own name (never its folder).  The exclusion is a
    filter on ``_metadata.file_name``, pruned at planning time; a selection
    without a file raises ``FileNotFoundError``."""
    try:
        df = spark.read.parquet(include)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise FileNotFoundError(f"no parquet files match {include}") from e
    if exclude_name:
        if all(exclude_name in os.path.basename(f) for f in df.inputFiles()):
            raise FileNotFoundError(f"no parquet files left under {include} after excluding {exclude_name}")
        df = df.where(~F.col("_metadata.file_name").contains(exclude_name))
    return df


#: Partition values up to which their sizes are broadcast.
FEW_VALUES = 10_000


def write_windows(windows: DataFrame, path: str, partition_by: list[str] | None = None,
                  rows_per_file: int = S.ROWS_PER_FILE, mode: str = "overwrite", key: list[str] | None = None) -> None:
    """Windows sink: slices of about ``rows_per_file`` rows, one file each,
    optionally partitioned (e.g. by split) so readers prune folders.

    The rows of each partition value are counted, and a row's slice is its
    value's share of the slices by the hash of ``key`` (default: all columns
    that are no arrays): the number of files follows from the rows, not from
    the tasks that made them, and a value with most of the rows is written by
    as many tasks as it has slices.  Counting and writing both read the
    windows, which are therefore made once, in the shared folder."""
    by = partition_by or []
    made = scratch_path(windows.sparkSession, "windows")
    windows.write.parquet(made)
    windows = windows.sparkSession.read.schema(windows.schema).parquet(made)
    key = key or [f.name for f in windows.schema.fields if not isinstance(f.dataType, T.ArrayType)]
    sizes = windows.groupBy(*by).agg(F.count("*").alias("_n"))
    sizes = sizes.select(*by, F.ceil(F.col("_n") / rows_per_file).cast("long").alias("_slices"))
    sizes = running_sums(sizes, [], by or ["_slices"], {"_end": F.col("_slices")})
    values, slices = sizes.agg(F.count("*"), F.coalesce(F.sum("_slices"), F.lit(0))).first()
    if by:
        w = null_safe_join(windows, F.broadcast(sizes) if values <= FEW_VALUES else sizes, by)
    else:
        w = windows.withColumns({c: F.lit(slices).cast("long") for c in ("_end", "_slices")})
    at = F.col("_end") - F.col("_slices") + F.pmod(F.xxhash64(*key), F.greatest(F.col("_slices"), F.lit(1).cast("long")))
    w = w.withColumn("_slice", at.cast("int")).repartitionById(max(1, slices), "_slice").drop("_slice", "_end", "_slices")
    out = w.write.mode(mode)
    (out.partitionBy(*by) if by else out).parquet(path)


def save_validation(predictions: DataFrame, threshold: DataFrame, path: str) -> None:
    """Persist predictions and the one-row loss threshold side by side."""
    predictions.write.mode("overwrite").parquet(f"{path}/predictions")
    threshold.write.mode("overwrite").parquet(f"{path}/threshold")


def load_validation(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/predictions"), spark.read.parquet(f"{path}/threshold")
