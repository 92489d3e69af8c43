"""Raw sensor files: headerless CSV, one file per (subject, sensor, device)
laid out as ``<base>/<device>/<sensor>/data_<subject>_<sensor>_<device>.txt``.

All files are read by ONE scan with a declared schema; subject, sensor
and device come from the file path (``_metadata.file_path``), so there is
no per-subject loop and no file listing on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import schemas as S
from tessera.functions.columns import clean_numeric, nan_to_null

_PATH_RE = r"/([^/]+)/([^/]+)/data_([^_/]+)_([^_/]+)_([^_/.]+)\.txt$"


def device_code(name):
    """Device name -> id (phone 0, watch 1; anything else NULL)."""
    col = F.col(name) if isinstance(name, str) else name
    expr = F.lit(None).cast("int")
    for dev, code in reversed(S.DEVICES):
        expr = F.when(col == F.lit(dev), F.lit(code)).otherwise(expr)
    return expr


def device_name(code):
    col = F.col(code) if isinstance(code, str) else code
    expr = F.lit(None).cast("string")
    for dev, c in reversed(S.DEVICES):
        expr = F.when(col == F.lit(c), F.lit(dev)).otherwise(expr)
    return expr


def read_raw(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Headerless CSV with the declared raw schema plus the source path.
    Short lines give NULL fields, extra fields are ignored."""
    reader = spark.read.schema(S.RAW_READING).option("header", "false").option("mode", "PERMISSIVE")
    df = reader.csv(paths)
    return df.select("*", F.col("_metadata.file_path").alias("_path"))


def clean(raw: DataFrame, keep_exponent: bool = False) -> DataFrame:
    """Drop rows with any NULL raw field (malformed or short lines), then
    parse the dirty ``z_raw`` text: NULL (not an error) when nothing
    numeric is left.  NaN readings become NULL."""
    cols = [f.name for f in S.RAW_READING.fields]
    return (raw.na.drop("any", subset=cols)
            .withColumn("z", clean_numeric("z_raw", keep_exponent))
            .drop("z_raw")
            .withColumn("timestamp", F.col("timestamp").cast("long"))
            .withColumn("x", nan_to_null("x"))
            .withColumn("y", nan_to_null("y"))
            .withColumn("z", nan_to_null("z")))


def with_path_keys(df: DataFrame) -> DataFrame:
    """device, sensor and file subject from the path.  Rows whose path does
    not follow the layout get NULL keys (and are dropped by ``readings``)."""
    p = F.col("_path")
    return (df.withColumn("device_name", F.regexp_extract(p, _PATH_RE, 1))
              .withColumn("sensor", F.regexp_extract(p, _PATH_RE, 2))
              .withColumn("file_subject", F.regexp_extract(p, _PATH_RE, 3))
              .withColumn("device", device_code("device_name")))


def readings(spark: SparkSession, base: str, keep_exponent: bool = False) -> DataFrame:
    """All readings under ``base``: subject_id, device, activity, sensor,
    timestamp, x, y, z.  The subject id is the file's (second ``_`` token
    of the name)."""
    glob = f"{base.rstrip('/')}/*/*/data_*_*_*.txt"
    df = with_path_keys(clean(read_raw(spark, glob), keep_exponent))
    return (df.where(F.col("device").isNotNull() & F.col("sensor").isin(*S.SENSORS))
              .select(F.col("file_subject").alias("subject_id"), "device", "activity", "sensor",
                      "timestamp", "x", "y", "z"))


def inventory(spark: SparkSession, base: str) -> DataFrame:
    """Files per (device, sensor), with every expected combination present
    (count 0 and ``missing`` true when a folder is absent).  Only path and
    length are read; file contents are pruned from the scan."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.txt").load(base).select("path", "length"))
    keyed = files.select(F.regexp_extract("path", _PATH_RE, 1).alias("device_name"),
                         F.regexp_extract("path", _PATH_RE, 2).alias("sensor"), "length")
    counts = keyed.groupBy("device_name", "sensor").agg(F.count("*").alias("files"),
                                                         F.sum("length").alias("bytes"))
    expected = spark.createDataFrame([(d, s) for d, _ in S.DEVICES for s in S.SENSORS],
                                     "device_name string, sensor string")
    return (expected.join(counts, ["device_name", "sensor"], "left")
            .select("device_name", "sensor", F.coalesce("files", F.lit(0)).alias("files"),
                    F.coalesce("bytes", F.lit(0)).alias("bytes"),
                    F.col("files").isNull().alias("missing")))


def paired_subjects(rd: DataFrame) -> DataFrame:
    """(subject_id, device) pairs that have readings of every sensor."""
    return (rd.groupBy("subject_id", "device")
              .agg(F.countDistinct("sensor").alias("_ns"))
              .where(F.col("_ns") == len(S.SENSORS)).drop("_ns"))
