"""Streaming: stream equals batch, restart continues the state, throttling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from tessera.operators import score as SC
from tessera.streaming import consumer as CS
from tessera.streaming import messages as MS


def _model_and_windows(spark):
    rows = [("s1", 0, "A", 0, [0.0, 0.0, 1.0, 1.0]), ("s1", 0, "A", 1, [0.1, 0.0, 1.0, 0.9]),
            ("s2", 0, "B", 0, [5.0, 5.0, 6.0, 6.0]), ("s2", 0, "B", 1, [5.0, 4.0, 6.0, 6.5]),
            ("s3", 1, "A", 0, [4.0, 5.0, 6.0, 6.0])]
    w = spark.createDataFrame(rows, "subject_id string, device int, label string, k long, features array<double>")
    model = SC.CentroidModel.fit(w, "features", "label")
    return model, w


def _publish(spark, w, path):
    MS.publish_files(MS.window_messages(w, 2), path, rows_per_file=1)


def test_stream_equals_batch(spark):
    model, w = _model_and_windows(spark)
    path = tempfile.mkdtemp(prefix="msgs-")
    _publish(spark, w, path)
    batch = CS.score_messages(MS.decode(spark.read.text(path)), model, 2, normalize=False)
    stream = CS.score_messages(MS.decode(MS.read_files(spark, path, 1)), model, 2, normalize=False)
    q, out = CS.run_append(spark, stream.select("seq", "pred_letter", "correct"), "t-scores")
    q.awaitTermination()
    a = sorted(tuple(r) for r in batch.select("seq", "pred_letter", "correct").collect())
    b = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert a == b and len(a) == 5
    # one file per trigger: five micro-batches of one message
    assert CS.progress_rows(q) == [1, 1, 1, 1, 1]


def test_restart_keeps_counts(spark):
    model, w = _model_and_windows(spark)
    src = tempfile.mkdtemp(prefix="msgs-")
    base = tempfile.mkdtemp(prefix="state-")
    ckpt, log = os.path.join(base, "ckpt"), os.path.join(base, "log")
    _publish(spark, w.where(F.col("subject_id") == "s1"), os.path.join(src, "part1"))

    def run():
        stream = CS.score_messages(MS.decode(MS.read_files(spark, src + "/*")), model, 2, normalize=False)
        q, _ = CS.run_update(spark, CS.accuracy_state(stream, ["device"]), "t-acc", ["device"], checkpoint=ckpt, changelog=log)
        q.awaitTermination()

    run()
    first = {r["device"]: r["total"] for r in CS.read_changelog(spark, log, ["device"]).collect()}
    assert first == {"phone": 2}
    _publish(spark, w.where(F.col("subject_id") != "s1"), os.path.join(src, "part2"))
    run()
    second = {r["device"]: r["total"] for r in CS.read_changelog(spark, log, ["device"]).collect()}
    assert second == {"phone": 4, "watch": 1}


def test_latest_per_key(spark):
    model, w = _model_and_windows(spark)
    path = tempfile.mkdtemp(prefix="msgs-")
    _publish(spark, w, path)
    stream = CS.score_messages(MS.decode(MS.read_files(spark, path, 2)), model, 2, normalize=False)
    q, log = CS.run_update(spark, CS.latest_state(stream, ["device"], "seq", ["subject_id"]), "t-latest", ["device"])
    q.awaitTermination()
    got = {r["device"]: (r["seq"], r["subject_id"]) for r in CS.read_changelog(spark, log, ["device"]).collect()}
    assert got == {"phone": (3, "s2"), "watch": (4, "s3")}


def test_files_follow_from_messages_not_from_tasks(spark, tmp_path):
    """60 tasks' messages are a few files, so that a replay is a few
    micro-batches; many files are taken in larger triggers."""
    msgs = spark.range(0, 250, 1, 60).selectExpr("cast(id as string) as value")
    path = str(tmp_path / "few")
    MS.publish_files(msgs, path, rows_per_file=100)
    assert len(spark.read.text(path).inputFiles()) <= 6
    assert sorted(int(r.value) for r in spark.read.text(path).collect()) == list(range(250))
    assert MS.files_per_trigger(spark, path, 4) == 4
    many = str(tmp_path / "many")
    msgs.repartition(60).write.text(many)
    assert MS.files_per_trigger(spark, many, 4) == -(-60 // MS.TRIGGERS)


def test_table_streams_from_a_file_and_from_a_folder(spark, tmp_path):
    from tessera.plans import tables as TB

    rows = spark.range(0, 100, 1, 20)
    rows.write.parquet(str(tmp_path / "events.parquet"))
    part = next(f for f in os.listdir(tmp_path / "events.parquet") if f.endswith(".parquet"))
    os.makedirs(tmp_path / "one")
    os.link(tmp_path / "events.parquet" / part, tmp_path / "one" / "events.parquet")
    for d, n in ((tmp_path, 100), (tmp_path / "one", spark.read.parquet(str(tmp_path / "one" / "events.parquet")).count())):
        q, out = CS.run_append(spark, TB.stream(spark, str(d), "events"), "table")
        q.awaitTermination()
        got = [r.id for r in spark.read.parquet(out).collect()]
        assert len(got) == len(set(got)) == n
        assert len(q.recentProgress) <= TB.TABLE_TRIGGERS + 1
