"""Driver tables as sensor data.

The test tables are not sensor recordings, so they are *read as* sensor
data by a fixed mapping.  ``events`` becomes paired sensor readings:

* subject      ``user_id`` (as a string, like the file subject ids)
* device, sensor   from ``event_type`` through a fixed table: view and
  click are the phone's accel and gyro, signup and purchase the watch's
  accel and gyro; ``error`` events are not sensor readings
* activity     the UTC calendar week (Monday start) of the reading,
  ``w<weeks since the epoch>``; one series per subject, device, week
* timestamp    microseconds since the epoch (``ts`` read as UTC)
* axes         x = ``value``; y = the dirty text ``props`` (``{"k": 69}``)
  parsed by the numeric cleaner

The grid is hourly (period 3.6e9 us), windows are 24 points with step 12
(a day, every half day), and the minimum common range is one second as
in the source rule, in microseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.columns import clean_numeric, epoch_micros, idiv, nan_to_null
from tessera.operators.series import SeriesSpec

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed mapping of event types to (device id, sensor).
EVENT_SENSORS = [
    ("view", 0, "accel"),
    ("click", 0, "gyro"),
    ("signup", 1, "accel"),
    ("purchase", 1, "gyro"),
]

US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600 * US_PER_SECOND
US_PER_WEEK = 7 * 24 * US_PER_HOUR
# 1970-01-01 is a Thursday; shifting by three days makes weeks start on Monday.
WEEK_SHIFT_US = 3 * 24 * US_PER_HOUR

EVENTS_SPEC = SeriesSpec(
    key=("subject_id", "device", "activity"),
    sensor="sensor",
    sensors=("accel", "gyro"),
    ts="timestamp",
    axes=("x", "y"),
    period=US_PER_HOUR,
    min_overlap=US_PER_SECOND,
    min_count=2,
    # two days: a week's series spreads over four tasks
    bucket=48 * US_PER_HOUR,
)
EVENTS_WINDOW = 24
EVENTS_STEP = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Files a trigger takes at least, and micro-batches up to which a table's stream grows in number.
TABLE_FILES, TABLE_TRIGGERS = 1, 8


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of them
    (as a glob: a stream's plain path is a folder, and its files need not
    have the table's name)."""
    batch = table(spark, sf_dir, name)
    files = max(TABLE_FILES, -(-len(batch.inputFiles()) // TABLE_TRIGGERS))
    return (spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", files)
            .parquet(f"{sf_dir.rstrip('/')}/{{{name}.parquet}}"))


def event_sensor_map(spark: SparkSession) -> DataFrame:
    """The fixed event-type table (four rows; joined by broadcast)."""
    return spark.createDataFrame(EVENT_SENSORS, "event_type string, device int, sensor string")


def event_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned readings from ``events``: subject_id, device, activity,
    sensor, timestamp, x, y (plus event_id for tracing)."""
    return decode_events(spark, table(spark, sf_dir, "events"))


def rejected_events(ev: DataFrame) -> DataFrame:
    """Rows of ``events`` that are no reading, counted by event type and
    reason: ``null_field`` (the malformed-line rule) or ``no_sensor`` (an
    event type without a sensor).  With the readings they are all rows."""
    null = F.isnan("value")
    for c in ["event_type", "user_id", "ts", "value", "props"]:
        null = F.col(c).isNull() | null
    reason = F.when(null, "null_field").when(
        ~F.col("event_type").isin([t for t, _, _ in EVENT_SENSORS]), "no_sensor")
    return (ev.select("event_type", reason.alias("reason")).where(F.col("reason").isNotNull())
            .groupBy("event_type", "reason").agg(F.count("*").alias("n_rows")))


def decode_events(spark: SparkSession, ev: DataFrame) -> DataFrame:
    """Events (batch or stream) -> readings.  Rows with a NULL raw field are
    dropped first (the malformed-line rule); the dirty text becomes NULL
    when unparseable, not an error."""
    ts_type = ev.schema["ts"].dataType
    # the malformed-line rule (a NULL field, or NaN in the double, drops the
    # row: the semantics of na.drop) written as plain predicates, and the
    # four mapped event types as an IN list: both reach the Parquet reader
    # (PushedFilters), so other event types are skipped in the scan
    keep = F.col("event_type").isin([t for t, _, _ in EVENT_SENSORS])
    for c in ["user_id", "ts", "value", "props"]:
        keep = keep & F.col(c).isNotNull()
    ev = ev.where(keep & ~F.isnan("value"))
    us = epoch_micros("ts", ts_type)
    sensors = F.broadcast(event_sensor_map(spark))  # four fixed rows
    return (ev.join(sensors, "event_type")
            .select("event_id",
                    F.col("user_id").cast("string").alias("subject_id"),
                    "device",
                    F.concat(F.lit("w"), idiv(us + F.lit(WEEK_SHIFT_US), F.lit(US_PER_WEEK)).cast("string"))
                    .alias("activity"),
                    "sensor",
                    us.alias("timestamp"),
                    nan_to_null("value").alias("x"),
                    clean_numeric("props").alias("y")))
