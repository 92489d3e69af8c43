"""Evaluation of predictions (y_true, y_pred, confidence, xentropy):
confusion matrix, classification report, per-class accuracy, loss
threshold and alerts, epoch metrics and best-epoch selection.

Class tables come from the model (bounded by the number of classes);
every metric is a grouped aggregate over the predictions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.operators.stats import exact_quantiles


def confusion_long(pred: DataFrame, classes: DataFrame) -> DataFrame:
    """(y_true, y_pred, count) for every class pair, absent cells 0.
    ``classes`` has one row per class with column ``idx``."""
    counts = pred.groupBy("y_true", "y_pred").agg(F.count("*").alias("count"))
    k = classes.agg(F.max("idx").cast("int")).scalar()  # scalar subquery
    cells = classes.select(F.col("idx").cast("int").alias("y_true"),
                           F.explode(F.sequence(F.lit(0), k)).alias("y_pred"))
    return (cells.join(counts, ["y_true", "y_pred"], "left")
            .select("y_true", "y_pred", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def confusion_wide(pred: DataFrame, n_classes: int) -> DataFrame:
    """Pivoted confusion matrix: one row per true class, a column per
    predicted class (the class list is given, so no extra pass)."""
    w = pred.groupBy("y_true").pivot("y_pred", list(range(n_classes))).count().na.fill(0)
    return w.select("y_true", *[F.col(str(i)).alias(f"p{i}") for i in range(n_classes)])


def _safe_div(a, b):
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def class_counts(pred: DataFrame, classes: DataFrame) -> DataFrame:
    """Per class: tp, predicted count, support (true count)."""
    t = pred.groupBy(F.col("y_true").alias("idx")).agg(
        F.count("*").alias("support"), F.sum((F.col("y_true") == F.col("y_pred")).cast("long")).alias("tp"))
    p = pred.groupBy(F.col("y_pred").alias("idx")).agg(F.count("*").alias("predicted"))
    return (classes.select("idx", "class_name").join(t, "idx", "left").join(p, "idx", "left")
            .select("idx", "class_name", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                          for c in ("tp", "predicted", "support")]))


def classification_report(pred: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows per class (precision, recall, f1, support), then ``accuracy``,
    ``macro avg`` and ``weighted avg``; zero division gives 0."""
    cc = class_counts(pred, classes)
    prec = _safe_div(F.col("tp"), F.col("predicted"))
    rec = _safe_div(F.col("tp"), F.col("support"))
    per = cc.select("idx", "class_name", prec.alias("precision"), rec.alias("recall"), "support", "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, F.lit(0.0)).otherwise(
        2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))))
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  _safe_div(F.sum(F.col("precision") * F.col("support")), F.sum("support")).alias("wp"),
                  _safe_div(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("wr"),
                  _safe_div(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("wf"))
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class_name"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), _safe_div(F.col("tp"), F.col("n")).alias("f1"),
                 F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class_name"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class_name"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")),
    )).alias("r")).select("r.*")
    return per.select("class_name", "precision", "recall", "f1", "support").unionByName(summary)


def per_class_accuracy(pred: DataFrame, classes: DataFrame) -> DataFrame:
    acc = pred.groupBy(F.col("y_true").alias("idx")).agg(
        F.avg((F.col("y_true") == F.col("y_pred")).cast("double")).alias("accuracy"))
    return (classes.select("idx", "class_name").join(acc, "idx", "left")
            .select("idx", "class_name", F.coalesce("accuracy", F.lit(0.0)).alias("accuracy")))


def loss_threshold(pred: DataFrame, p: float = 0.95, col: str = "xentropy") -> DataFrame:
    """One row: the exact p-quantile (linear interpolation) of the loss."""
    long = pred.select(F.lit(0).alias("_g"), F.col(col).alias("value"))
    q = exact_quantiles(long, ["_g"], [p])
    return q.select(F.col("q").alias(f"threshold_{int(round(p * 100))}"))


def alert_flags(pred: DataFrame, threshold: DataFrame, col: str = "xentropy") -> DataFrame:
    """Flag predictions whose loss exceeds the threshold (a one-row,
    one-column table used as a scalar subquery)."""
    tcol = threshold.columns[0]
    thr = threshold.select(tcol).scalar()  # scalar subquery, evaluated once
    return pred.withColumn(tcol, thr).withColumn("alert", F.col(col) > F.col(tcol))


def epoch_metrics(batches: DataFrame) -> DataFrame:
    """Size-weighted mean loss and accuracy per epoch from per-batch rows
    (epoch, n, loss, correct)."""
    return batches.groupBy("epoch").agg(
        (F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("tr_loss"),
        (F.sum("correct") / F.sum("n")).alias("tr_acc"))


def best_epoch(history: DataFrame) -> DataFrame:
    """One row: first epoch reaching the best val_acc (a strict improvement
    rule), the epoch of minimum loss and of maximum train accuracy (first
    wins ties), and the number of improvements."""
    w = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    h = history.withColumn("_prev", F.coalesce(F.max("val_acc").over(w), F.lit(0.0)))
    h = h.withColumn("improved", F.col("val_acc") > F.col("_prev"))
    return h.agg(
        F.min_by("epoch", F.struct(-F.col("val_acc"), F.col("epoch"))).alias("best_epoch"),
        F.max("val_acc").alias("best_val_acc"),
        F.min_by("epoch", F.struct(F.col("tr_loss"), F.col("epoch"))).alias("min_loss_epoch"),
        F.min_by("epoch", F.struct(-F.col("tr_acc"), F.col("epoch"))).alias("max_acc_epoch"),
        F.sum(F.col("improved").cast("int")).alias("n_improvements"))
