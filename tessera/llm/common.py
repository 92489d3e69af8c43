"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from tessera.session import checkpoint_dir

#: Raw bytes of text that one output batch of a task is made from; a longer
#: document makes a batch of its own.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder: its lineage ends
    there and a lost executor costs no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def crc_mod(doc_id: str, m: int) -> Column:
    """``crc32(doc_id as text) mod m``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(m)


#: Columns that tell rows of documents apart, NULL ids too.
ROW_KEY = ["__id", "__null", "__text"]


def row_key(text_hash: Column) -> list[Column]:
    """``ROW_KEY`` of a row by its ``doc_id`` and its text's hash; never
    NULL, so that it joins and groups like any key."""
    return [F.coalesce(F.col("doc_id"), F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__null"),
            text_hash.alias("__text")]


def packed(df: DataFrame, text: str) -> tuple[DataFrame, int]:
    """All columns of ``df`` in one struct ``row``, so that names of an
    operator's outputs cannot clash with them, and the place of the text
    in it (as a string)."""
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    columns = [x.cast("string").alias(c) if c == text else x for c, x in quoted.items()]
    return df.select(F.struct(*columns).alias("row")), df.columns.index(text)


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; NULL as the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.fill_null("").cast(kind).to_pylist()


def runs(sizes: Iterable[int], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Cut rows into runs ``[start, stop)`` of at most ``limit`` bytes each
    (a single larger row is a run of its own)."""
    start = total = 0
    stop = -1
    for stop, n in enumerate(sizes):
        if stop > start and total + n > limit:
            yield start, stop
            start, total = stop, 0
        total += n
    if stop >= start:
        yield start, stop + 1


class Memo(dict):
    """A dict that makes missing values with ``make`` and holds two
    generations of at most ``limit`` entries each, so that it stays bounded
    however many different keys a worker meets."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def turn(self) -> None:
        """Start a new generation when this one is full."""
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package where they cannot import it yet
    (a session started without it on the workers' path, as in tests); on a
    cluster it comes with the job's ``--py-files`` or environment."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    context = spark.sparkContext
    known = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    known += context.getConf().get("spark.executorEnv.PYTHONPATH", "").split(os.pathsep)
    if root in known or any(f.startswith(f"{name}-") for f in context._python_includes):
        return
    # on the driver, which serves it to the executors until it ends
    folder = tempfile.mkdtemp(prefix=f"{name}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"{name}-{uuid.uuid4().hex[:8]}")
    context.addPyFile(shutil.make_archive(path, "zip", root, name))
