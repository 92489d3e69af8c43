"""Stream consumer: normalise, score, compare, keep running accuracy and
the latest prediction per key.

* ``score_messages`` is stateless (a projection plus a join with the
  model's class table, broadcast where its size was checked), so it runs the
  same on a batch or a streaming frame.
* ``accuracy_state`` and ``latest_state`` are streaming aggregations with
  state per key in the state store (checkpointed, so a restarted query
  continues the counts).  They run in ``update`` mode and each micro-batch
  appends its changed keys to a change log that is compacted as it grows;
  ``read_changelog`` returns the newest row per key.  Nothing re-emits all
  keys per batch.
* ``running_accuracy_state`` keeps counts per key itself and puts out a
  report line per message, in the order of sending.
* ``run_alerts`` flags losses over a threshold that is read anew for every
  micro-batch; ``Progress`` counts messages while queries run.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera import schemas as S
from tessera.operators import lookup as L
from tessera.operators.metrics import alert_flags
from tessera.operators.score import CentroidModel, with_scores
from tessera.operators.windows import zscore_features
from tessera.session import scratch_path


def class_letters(model: CentroidModel) -> DataFrame:
    """(idx, class_name, letter, activity_name) for the model classes."""
    return L.class_table(model.table, "class_name", "idx")


def score_messages(msgs: DataFrame, model: CentroidModel, channels: int, normalize: bool = True, ddof: int = 0,
                   eps: float = S.ZSCORE_EPS, keep_invalid: bool = False) -> DataFrame:
    """Valid messages -> predicted letter and name, confidence, truth,
    correct flag.  Features are flattened row-major and, with
    ``normalize``, z-scored per channel inside the message.  A stream takes
    a small model; a batch (or a micro-batch) any.  With ``keep_invalid``
    the other messages stay, ``correct`` NULL."""
    v = msgs if keep_invalid else msgs.where("valid")
    v = v.withColumn("_f", F.when(F.col("valid"), F.flatten("features")))
    if normalize:
        v = zscore_features(v, channels, "_f", ddof, eps)
    code = L.trim_code("activity")
    v = v.withColumn("activity_code", code).withColumn("truth_name", L.code_to_name(code))
    if msgs.isStreaming:
        s = with_scores(model.with_logits(v, "_f", "_lg"), "_lg").drop("_lg", "_f")
    else:
        s = model.score(v, "_f").drop("_f")
    classes = class_letters(model)
    s = L.predicted_labels(s, F.broadcast(classes) if model.small else classes, "y_pred")
    return s.withColumn("correct", F.when(F.col("valid"), F.col("pred_letter") == F.col("activity_code")))


#: Columns of a message's report line, besides the key and the counts.
REPORT = {"seq": "long", "subject_id": "string", "activity": "string", "pred_letter": "string", "pred_name": "string",
          "truth_name": "string", "confidence": "double", "correct": "boolean"}


def running_accuracy_state(scored: DataFrame, key: list[str], pos: str = "pos", patience: str | None = None,
                           report: dict[str, str] | None = None) -> DataFrame:
    """The report line of every message, with the accuracy after it: for
    each key, in the order of ``pos`` (0, 1, 2, ... as sent), whatever order
    the messages arrive in.

    ``scored`` is a stream of ``score_messages(..., keep_invalid=True)``: a
    message with a NULL ``correct`` takes its place in the order, but is
    neither counted nor reported.  The state of a key is its counts, the
    position awaited, and the report lines of messages that came before
    their predecessors (of no others, and no features).  A message that
    comes again is left out.  A position that does not come holds back those
    after it; with ``patience`` (of processing time, for a query that runs
    on: timeouts keep an ``availableNow`` query from ending) it is passed
    over, and left out should it come later.  Messages without a
    position are counted as they come.  Output: key, report columns,
    ``n_seen``, ``n_correct``, ``running_accuracy``."""
    columns = dict(report or REPORT)
    keys = [scored.schema[c] for c in key]
    fields = [*keys, *T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in columns.items())).fields,
              T.StructField("n_seen", T.LongType()), T.StructField("n_correct", T.LongType()),
              T.StructField("running_accuracy", T.DoubleType())]
    names = list(columns)
    hit = names.index("correct")
    wait = int(pd.Timedelta(patience).total_seconds() * 1000) if patience else None

    def run(at: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        awaited, seen, right, kept = state.get if state.exists else (0, 0, 0, "{}")
        waiting = {int(p): row for p, row in json.loads(kept).items()}
        out, loose = [], []

        def count(row: list) -> None:
            nonlocal seen, right
            if row[hit] is not None:
                seen, right = seen + 1, right + bool(row[hit])
                out.append([*at, *row, seen, right, right / seen])

        if state.hasTimedOut:
            awaited = min(waiting, default=awaited)
        for batch in batches:
            rows = batch[names].astype(object).where(batch[names].notna(), None).values.tolist()
            for p, row in zip(batch[pos].tolist(), rows):
                if p is None or p != p:
                    loose.append(row)
                elif p >= awaited:
                    waiting.setdefault(int(p), row)
        while awaited in waiting:
            count(waiting.pop(awaited))
            awaited += 1
        for row in loose:
            count(row)
        state.update((awaited, seen, right, json.dumps(waiting)))
        if waiting and wait:
            state.setTimeoutDuration(wait)
        frame = pd.DataFrame(out, columns=[f.name for f in fields])
        yield frame.astype({f.name: _PANDAS[f.dataType.typeName()] for f in fields if f.dataType.typeName() in _PANDAS})

    return scored.select(*key, pos, *names).groupBy(*key).applyInPandasWithState(
        run, T.StructType(fields), "awaited long, seen long, right long, waiting string", "append",
        GroupStateTimeout.ProcessingTimeTimeout if wait else GroupStateTimeout.NoTimeout)


#: Nullable pandas types of columns.
_PANDAS = {"long": "Int64", "integer": "Int32", "double": "Float64", "boolean": "boolean"}


def accuracy_state(scored: DataFrame, key: list[str]) -> DataFrame:
    """Running totals per key: messages, correct predictions, accuracy."""
    return scored.groupBy(*key).agg(F.count("*").alias("total"),
                                    F.sum(F.col("correct").cast("long")).alias("n_correct")) \
        .withColumn("accuracy", F.col("n_correct") / F.col("total"))


def latest_state(scored: DataFrame, key: list[str], order: str, cols: list[str]) -> DataFrame:
    """Newest message per key (largest ``order``), older ones overwritten."""
    payload = F.struct(*[F.col(c) for c in [order, *cols]])
    return scored.groupBy(*key).agg(F.max_by(payload, F.col(order)).alias("_l")) \
        .select(*key, *[F.col(f"_l.{c}").alias(c) for c in [order, *cols]])


def run_update(spark: SparkSession, agg: DataFrame, name: str, key: list[str], trigger: dict | None = None,
               checkpoint: str | None = None, changelog: str | None = None, compact_every: int = 10):
    """Run a streaming aggregation in update mode into a change log (see
    ``append_changes``).  Returns (query, changelog path).  ``trigger``
    defaults to ``availableNow`` (process what is there, then stop)."""
    changelog = changelog or scratch_path(spark, f"{name}-changelog")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-checkpoint")

    def sink(df: DataFrame, batch_id: int) -> None:
        append_changes(df, batch_id, changelog, key, compact_every)

    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    return q, changelog


def generations(spark: SparkSession, folder: str) -> list[int]:
    """The complete sub-folders of a change log's folder, oldest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(path) if fs.exists(done(f.getPath(), "_SUCCESS")))


def _forget(spark: SparkSession, folder: str, numbers: list[int]) -> None:
    for n in numbers:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def append_changes(df: DataFrame, batch_id: int, changelog: str, key: list[str], compact_every: int = 10) -> None:
    """Add a micro-batch's changed keys to a change log: ``delta/<batch>``.

    Every ``compact_every`` batches the log is merged into ``snapshot/<batch>``
    (a row per key).  Readers take the newest snapshot whose ``_SUCCESS``
    file is there, and the deltas after it: the commit of that one file
    switches them over.  The snapshot before it and its deltas stay until the
    next one, for readers that have already listed them; older ones go.  So
    the log holds at most two snapshots and ``2 * compact_every`` deltas of
    at most a row per key each.  A batch that is run again (after a failure)
    writes its folders anew."""
    spark = df.sparkSession
    snapshots = generations(spark, f"{changelog}/snapshot")
    if snapshots and batch_id <= snapshots[-1]:
        return  # part of a snapshot already
    df.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{changelog}/delta/{batch_id}")
    deltas = generations(spark, f"{changelog}/delta")
    if sum(d > (snapshots[-1] if snapshots else -1) for d in deltas) < compact_every:
        return
    _merged(spark, changelog, key).write.mode("overwrite").parquet(f"{changelog}/snapshot/{batch_id}")
    if snapshots:
        _forget(spark, f"{changelog}/snapshot", snapshots[:-1])
        _forget(spark, f"{changelog}/delta", [d for d in deltas if d <= snapshots[-1]])


def _merged(spark: SparkSession, changelog: str, key: list[str]) -> DataFrame:
    """Newest row per key, with the batch it is from."""
    snapshots = generations(spark, f"{changelog}/snapshot")
    newest = snapshots[-1] if snapshots else -1
    parts = [f"{changelog}/delta/{d}" for d in generations(spark, f"{changelog}/delta") if d > newest]
    parts += [f"{changelog}/snapshot/{newest}"] if snapshots else []
    if not parts:
        raise FileNotFoundError(f"no change log at {changelog}")
    df = spark.read.parquet(*parts)
    cols = [c for c in df.columns if c not in key]
    last = F.max_by(F.struct(*cols), F.col("_batch")).alias("_r")
    return df.groupBy(*key).agg(last).select(*key, *[F.col(f"_r.{c}").alias(c) for c in cols])


def read_changelog(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """Newest row per key from an update-mode change log."""
    return _merged(spark, path, key).drop("_batch")


def run_append(spark: SparkSession, stream: DataFrame, name: str, trigger: dict | None = None,
               checkpoint: str | None = None, path: str | None = None):
    """Run a stateless stream into a Parquet sink (exactly-once with the
    checkpoint).  Returns (query, path)."""
    path = path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-checkpoint")
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    return q, path


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Messages that did not decode (logged and skipped, never counted)."""
    return decoded.where(~F.col("valid")).select("value")


def progress_rows(query) -> list[int]:
    """Input rows per finished micro-batch, from the query progress."""
    return [p["numInputRows"] for p in query.recentProgress]


def run_alerts(spark: SparkSession, scored: DataFrame, threshold: str, name: str, trigger: dict | None = None,
               checkpoint: str | None = None, path: str | None = None, loss: str = "xentropy"):
    """Flag the messages of a stream whose ``loss`` exceeds the threshold
    that a one-row Parquet table at ``threshold`` holds.  The table is read
    anew for every micro-batch: a threshold that is written again takes
    effect with the next one.  Each batch writes its own folder, so that a
    batch run again leaves no row twice.  Returns (query, path); read it
    with ``read_batches``."""
    path = path or scratch_path(spark, f"{name}-out")
    checkpoint = checkpoint or scratch_path(spark, f"{name}-checkpoint")

    def sink(df: DataFrame, batch_id: int) -> None:
        session = df.sparkSession
        session.catalog.refreshByPath(threshold)
        alert_flags(df, session.read.parquet(threshold), loss).write.mode("overwrite").parquet(f"{path}/{batch_id}")

    q = (scored.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"availableNow": True})).start())
    return q, path


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a sink with a folder per micro-batch."""
    return spark.read.parquet(*[f"{path}/{n}" for n in generations(spark, path)])


class Progress(StreamingQueryListener):
    """Counts of messages while queries run: ``counted`` names a frame's
    counts, batch or stream, and ``totals`` has their sums.

    A stream reports its micro-batches to the listener; a batch is an
    ``Observation``, whose counts come with the end of its write.  A
    micro-batch that is run again counts once."""

    def __init__(self) -> None:
        self.seen: dict[tuple, dict[str, int]] = {}
        self.batches: dict[str, Observation] = {}
        self.ended: set = set()

    def counted(self, df: DataFrame, name: str, **counts) -> DataFrame:
        """``df`` with counts to be observed: all rows (``rows``), and those
        for which each condition holds."""
        of = [F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, 1)).alias(n) for n, c in counts.items()]]
        if df.isStreaming:
            return df.observe(name, *of)
        self.batches[name] = Observation(name)
        return df.observe(self.batches[name], *of)

    def totals(self, name: str) -> dict[str, int]:
        if name in self.batches:
            return dict(self.batches[name].get)
        out: dict[str, int] = {}
        for (_, _, observed), counts in list(self.seen.items()):
            if observed == name:
                for k, v in counts.items():
                    out[k] = out.get(k, 0) + v
        return out

    def await_end(self, query, seconds: float = 60) -> None:
        """Wait until the query and all its reports have ended (reports come
        after the batches, on a thread of their own)."""
        query.awaitTermination()
        until = time.monotonic() + seconds
        while str(query.runId) not in self.ended and time.monotonic() < until:
            time.sleep(0.05)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for name, row in p.observedMetrics.items():
            self.seen[str(p.id), p.batchId, name] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))
