"""Declared schemas and fixed values.

Every table that enters or leaves the library has a declared
StructType; nothing is inferred from data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's for identical results.
# ---------------------------------------------------------------------------
# Activity codes and names, in their natural order (18 codes, A..S without N).
ACTIVITY_NAMES = [
    ("A", "Walking"),
    ("B", "Jogging"),
    ("C", "Stairs"),
    ("D", "Sitting"),
    ("E", "Standing"),
    ("F", "Typing"),
    ("G", "Brushing Teeth"),
    ("H", "Eating Soup"),
    ("I", "Eating Chips"),
    ("J", "Eating Pasta"),
    ("K", "Drinking"),
    ("L", "Eating Sandwich"),
    ("M", "Kicking"),
    ("O", "Catch Tennis Ball"),
    ("P", "Dribbling"),
    ("Q", "Writing"),
    ("R", "Clapping"),
    ("S", "Folding Clothes"),
]
# Device names and ids.
DEVICES = [("phone", 0), ("watch", 1)]
# Sensor kinds, in channel order; each contributes the axes x, y, z.
SENSORS = ["accel", "gyro"]
AXES = ["x", "y", "z"]
CHANNELS = ["ax", "ay", "az", "gx", "gy", "gz"]
# Sampling and windowing.
FREQ_HZ = 50
WINDOW_SIZE = 100
STEP_SIZE = 50
NS_PER_SECOND = 1_000_000_000
MIN_OVERLAP_NS = 1_000_000_000
# Normalisation epsilon added to the standard deviation.
ZSCORE_EPS = 1e-5
# Subject split: train = ceil(0.8 n), val = floor(0.1 n), test = rest; seed 42.
SPLIT_TRAIN = 0.8
SPLIT_VAL = 0.1
SPLIT_SEED = 42
# Rows per output file of the window sink.
ROWS_PER_FILE = 10_000
# Characters kept when parsing a dirty numeric field.
NUMERIC_KEEP_PATTERN = r"[^0-9\.\-]"
NUMERIC_KEEP_PATTERN_EXP = r"[^0-9eE\.\+\-]"
# ---------------------------------------------------------------------------

RAW_READING = T.StructType([
    T.StructField("subject_id", T.StringType(), True),
    T.StructField("activity", T.StringType(), True),
    T.StructField("timestamp", T.LongType(), True),
    T.StructField("x", T.DoubleType(), True),
    T.StructField("y", T.DoubleType(), True),
    T.StructField("z_raw", T.StringType(), True),
])

MESSAGE = T.StructType([
    T.StructField("device", T.StringType(), True),
    T.StructField("subject_id", T.StringType(), True),
    T.StructField("activity", T.StringType(), True),
    T.StructField("features", T.ArrayType(T.ArrayType(T.DoubleType())), True),
])
