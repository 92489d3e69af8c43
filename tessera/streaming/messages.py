"""Window messages: the JSON payload of one window, and its sinks/sources.

A message is ``{"device": "phone"|"watch", "subject_id": str,
"activity": str, "features": [[...], ...] (size x channels), "seq": n,
"pos": m}``.  ``seq`` is the publish position (device, subject, label,
window order), ``pos`` the position among the messages of the device: both
count from 0 without gaps, so that a consumer can restore the order in which
messages were sent, whatever order they arrive in, and sees what is missing.

Producing is a batch DataFrame write (executors write in parallel), not
a per-message loop; windows with NULL/NaN/Inf are skipped before encoding
(NaN is not valid JSON).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schemas as S
from tessera.functions.columns import bound, finite_array, reshape
from tessera.operators.order import sequence_numbers
from tessera.session import scratch_path
from tessera.sources.sensor_files import device_name

MESSAGE_SCHEMA = T.StructType([*S.MESSAGE.fields, T.StructField("seq", T.LongType(), True),
                               T.StructField("pos", T.LongType(), True)])


def window_messages(windows: DataFrame, channels: int, features: str = "features",
                    label: str = "label", with_seq: bool = True) -> DataFrame:
    """Windows (subject_id, device, label, k, features) -> (key, value)
    rows ready for a Kafka or file sink; ``key`` = subject_id sends one
    subject's messages to one Kafka partition.  Windows are written to the
    shared folder once and numbered from counts per key: the features are
    never sorted."""
    w = windows.where(finite_array(features, check_inf=True))
    if with_seq:
        path = scratch_path(w.sparkSession, "windows")
        w.write.parquet(path)
        w = sequence_numbers(w.sparkSession.read.parquet(path), ["device", "subject_id", label], "k",
                             within={"pos": ["device"]})
    payload = F.struct(
        device_name("device").alias("device"),
        F.col("subject_id").cast("string").alias("subject_id"),
        F.col(label).cast("string").alias("activity"),
        reshape(features, channels).alias("features"),
        *([F.col("seq"), F.col("pos")] if with_seq else []))
    return w.select(F.col("subject_id").cast("string").alias("key"), F.to_json(payload).alias("value"))


def publish_files(messages: DataFrame, path: str, rows_per_file: int = 1000) -> None:
    """File sink: one JSON message per line (text files), about
    ``rows_per_file`` in each.  The number of files follows from the messages,
    not from the tasks that made them: a consumer that takes a few files per
    trigger would else run a micro-batch for every few tasks."""
    files = max(1, -(-messages.count() // rows_per_file))
    messages.select("value").coalesce(files).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).text(path)


#: Micro-batches up to which a replay grows in number; beyond, its triggers grow.
TRIGGERS = 8


def files_per_trigger(spark: SparkSession, path: str, least: int) -> int:
    """Files a trigger takes of the message files at ``path``: ``least``, or
    more where that would be over ``TRIGGERS`` micro-batches."""
    return max(least, -(-len(spark.read.text(path).inputFiles()) // TRIGGERS))


def publish_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Kafka sink (needs the spark-sql-kafka package on the cluster)."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())


def read_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source of message lines from files; ``max_files_per_trigger``
    throttles the replay (the per-send delay of a hand-written producer)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path).select(F.col("value"))


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
               max_offsets_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("value").cast("string").alias("value"), "partition", "offset")


def decode(raw: DataFrame, rows: int | None = None, channels: int | None = None) -> DataFrame:
    """value -> message columns plus ``valid``.  A message is valid if it is
    JSON with an activity and a features matrix of equal rows (``rows`` x
    ``channels`` where given: the shape that the model expects) without
    NULL, NaN or +-Inf.  Others are kept with valid = false, so that they go
    to a dead-letter sink and neither stop the stream nor count."""
    def read(m: Column) -> Column:
        f = m["features"]
        width = F.lit(channels) if channels else F.size(F.get(f, F.lit(0)))
        shaped = ~F.exists(f, lambda r: r.isNull() | (F.size(r) != width)) & finite_array(F.flatten(f))
        valid = F.coalesce(m["activity"].isNotNull() & (F.size(f) > 0) & (width > 0)
                           & (F.size(f) == rows if rows else F.lit(True)) & shaped, F.lit(False))
        return F.struct(*[m[c.name].alias(c.name) for c in MESSAGE_SCHEMA.fields], valid.alias("valid"))

    # bound: a filter on ``valid`` that is pushed down would else read the JSON for each use of it
    d = raw.select("*", bound(F.from_json("value", MESSAGE_SCHEMA, {"mode": "PERMISSIVE"}), read).alias("_m"))
    return d.select(*raw.columns, *[F.col(f"_m.{c}").alias(c) for c in [*MESSAGE_SCHEMA.names, "valid"]])


def place_of(decoded: DataFrame) -> DataFrame:
    """Decoded messages with the device and position of those, too, that did
    not decode, as far as their text still tells them."""
    device = F.nullif(F.regexp_extract("value", r'"device":"([^"]*)"', 1), F.lit(""))
    pos = F.regexp_extract("value", r'"pos":(\d{1,18})(?!\d)', 1).try_cast("long")
    return decoded.withColumns({"device": F.coalesce("device", device), "pos": F.coalesce("pos", pos)})
