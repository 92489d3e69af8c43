"""Session helpers: building a session for local runs and resolving the
shared checkpoint folder.

On a cluster the session is created by the caller; library code only
*reads* its settings.  ``checkpoint_dir`` returns the folder named in
``spark.checkpoint.dir`` (the shared, fault-tolerant location the
cluster provides); a folder is set only when the session has none,
which happens in tests and local runs.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small inputs: keep CPU-heavy post-shuffle stages parallel (AQE would
    # otherwise merge them into one task by bytes)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "tessera", **conf: str) -> SparkSession:
    """Session for tests and local runs (``local[*]`` by default)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    elif not os.environ.get("SPARK_REMOTE"):
        builder = builder.master(os.environ.get("TESSERA_MASTER", "local[*]"))
    settings = dict(_LOCAL_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir``.  Where it is unset a folder is made for
    a local master alone (tests, a laptop; it is removed at exit): the
    executors of a cluster do not share one, so there it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the checkpoint folder for a
    materialised intermediate (streaming sinks, cut lineage)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}-{uuid.uuid4().hex[:12]}"
