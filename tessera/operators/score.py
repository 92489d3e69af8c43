"""Scoring windows with a model.

Two paths share one output contract (class, confidence, cross-entropy):

* ``CentroidModel``: nearest class centroid.  Fitted by a distributed
  aggregation into a table of classes, which stays a table: nothing of it is
  collected or written into a plan.  Models of a checked, small size reach
  the rows as one scalar subquery (a projection without join or Python);
  larger ones meet the rows in blocks of classes, whose partial results
  (largest logit, sum of exponentials) are merged per row.
* ``score_with``: any Python function ``ndarray (n, d) -> (n, k)``
  applied per Arrow batch with ``mapInPandas`` (the plug-in point for a
  neural network); the model object is shipped once per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.columns import argmax, cross_entropy, idiv, max_probability, softmax
from tessera.operators.lookup import label_index
from tessera.session import checkpoint_dir, scratch_path

#: Classes, and numbers of all centroids, up to which a model counts as small.
SMALL_CLASSES, SMALL_VALUES = 256, 1 << 18
#: Classes of a block.
CLASS_BLOCK = 512
MODEL = "idx int, class_name string, centroid array<double>"


@dataclass
class CentroidModel:
    """``table`` has a row per class: ``idx`` (0-based, in ascending order of
    the names), ``class_name`` and ``centroid``."""

    table: DataFrame
    n_classes: int
    dims: int

    @staticmethod
    def of(table: DataFrame) -> "CentroidModel":
        n, d = table.agg(F.count("*"), F.coalesce(F.max(F.size("centroid")), F.lit(0))).first()
        return CentroidModel(table, n, d)

    @staticmethod
    def fit(df: DataFrame, features: str = "features", label: str = "label") -> "CentroidModel":
        """Per-class mean of the feature vectors (partial aggregation per
        dimension), classes in ascending label order; written to the shared
        folder, so that every use reads the same table."""
        spark = df.sparkSession
        ex = class_values(df, features, label)
        means = ex.groupBy("class_name", "_d").agg(F.avg("_v").alias("_m"))
        per = means.groupBy("class_name").agg(F.array_sort(F.collect_list(F.struct("_d", "_m"))).alias("_c"))
        per = per.select("class_name", F.transform("_c", lambda x: x["_m"]).alias("centroid"))
        path = scratch_path(spark, "centroids")
        per.write.parquet(path)
        per = spark.read.parquet(path)
        model = per.join(label_index(per, "class_name"), "class_name")
        path = scratch_path(spark, "model")
        model.select(F.col("idx").cast("int"), "class_name", "centroid").write.parquet(path)
        return CentroidModel.load(spark, path)

    @property
    def small(self) -> bool:
        return self.n_classes <= SMALL_CLASSES and self.n_classes * self.dims <= SMALL_VALUES

    def classes(self) -> DataFrame:
        """``idx`` and ``class_name``, marked for broadcast where small."""
        t = self.table.select("idx", "class_name")
        return F.broadcast(t) if self.small else t

    def index(self, df: DataFrame, label: str, name: str) -> DataFrame:
        """Add the 0-based class of ``label``; NULL where the model has none."""
        c = self.classes().select(F.col("class_name").alias("_name"), F.col("idx").alias(name))
        return df.join(c, F.col(label).cast("string") == F.col("_name"), "left").drop("_name")

    def with_logits(self, df: DataFrame, features: str = "features", name: str = "logits") -> DataFrame:
        """Add the negative squared distance to each centroid, in class
        order; for models of a small size (see ``score`` for any)."""
        if not self.small:
            raise ValueError(f"{self.n_classes} classes of {self.dims} values are no small model: use score")
        rows = self.table.agg(F.array_sort(F.collect_list(F.struct("idx", "centroid"))).alias("c"))
        centroids = rows.select(F.transform("c", lambda x: x["centroid"])).scalar()
        f = F.col(features).cast("array<double>")
        return (df.withColumn("_centroids", centroids)
                .withColumn(name, F.transform("_centroids", lambda c: _logit(f, c))).drop("_centroids"))

    def score(self, df: DataFrame, features: str = "features", target: str | None = None) -> DataFrame:
        """Add y_pred, confidence and, with a 0-based ``target``, xentropy,
        for any number of classes."""
        if self.small:
            return with_scores(self.with_logits(df, features, "_logits"), "_logits", target).drop("_logits")
        return self._score_in_blocks(df, features, target)

    def _score_in_blocks(self, df: DataFrame, features: str, target: str | None) -> DataFrame:
        spark = df.sparkSession
        checkpoint_dir(spark)
        groups = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # row numbers that both uses below share, after a lost executor too
        rows = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
        rows = rows.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)))
        blocks = (self.table.groupBy(idiv(F.col("idx"), F.lit(CLASS_BLOCK)).alias("_block"))
                  .agg(F.array_sort(F.collect_list(F.struct("idx", "centroid"))).alias("_c"))
                  .withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))))
        f = F.col("_f").cast("array<double>")
        wanted = F.col(target).cast("int") if target else F.lit(None).cast("int")
        met = rows.select("_row", "_group", F.col(features).alias("_f"), wanted.alias("_y")).join(blocks, "_group")
        met = met.select("_row", "_group", "_y", F.transform("_c", lambda c: c["idx"]).alias("_i"),
                         F.transform("_c", lambda c: _logit(f, c["centroid"])).alias("_l"))
        met = met.select("*", F.array_max("_l").alias("_m"))
        met = met.select("_row", "_group", "_m", F.element_at("_i", F.array_position("_l", F.col("_m")).cast("int")).alias("_a"),
                         F.aggregate(F.transform("_l", lambda v: v - F.col("_m")), F.lit(0.0),
                                     lambda acc, v: acc + F.exp(v)).alias("_s"),
                         F.when(F.array_contains("_i", F.col("_y")), F.element_at(
                             "_l", F.array_position("_i", F.col("_y")).cast("int"))).alias("_t"))
        best = met.groupBy("_group", "_row").agg(
            F.max(F.struct("_m", (-F.col("_a")).alias("_a"))).alias("_b"),
            F.collect_list(F.struct("_m", "_s")).alias("_p"), F.max("_t").alias("_t"))
        best = best.select("_group", "_row", "_t", "_p", F.col("_b._m").alias("_m"), (-F.col("_b._a")).alias("y_pred"))
        total = F.aggregate(F.transform("_p", lambda x: x["_s"] * F.exp(x["_m"] - F.col("_m"))), F.lit(0.0),
                            lambda acc, v: acc + v)
        lse = F.col("_m") + F.log(total)
        best = best.select("_group", "_row", "y_pred", F.exp(F.col("_m") - lse).alias("confidence"),
                           *([(lse - F.col("_t")).alias("xentropy")] if target else []))
        return rows.join(best, ["_group", "_row"]).drop("_group", "_row")

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "CentroidModel":
        model = CentroidModel.of(spark.read.schema(MODEL).parquet(path))
        if not model.n_classes:
            raise FileNotFoundError(f"no model at {path}")
        return model


def class_values(df: DataFrame, features: str, label: str) -> DataFrame:
    """A row per value of the labelled vectors: class_name, _d (its place), _v.

    The outer form, its rows without a place left out again: for the inner
    one Spark tests the vectors before it, and computes those that an
    expression makes (a z-score) again for each use in that test."""
    ex = df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("class_name"),
                                                   F.posexplode_outer(F.col(features).cast("array<double>")).alias("_d", "_v"))
    return ex.where(F.col("_d").isNotNull())


def _logit(f: Column, centroid: Column) -> Column:
    return -F.aggregate(F.zip_with(f, centroid, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, v: acc + v)


def with_scores(df: DataFrame, logits: Column | str = "logits", target: Column | str | None = None) -> DataFrame:
    """Add y_pred (argmax, first wins), confidence (max softmax) and, when a
    0-based target index is given, xentropy = -log softmax[target]."""
    lg = F.col(logits) if isinstance(logits, str) else logits
    out = df.withColumn("_lg", lg) \
        .withColumn("y_pred", argmax("_lg")) \
        .withColumn("confidence", max_probability("_lg"))
    if target is not None:
        out = out.withColumn("xentropy", cross_entropy("_lg", target))
    return out.drop("_lg")


def probabilities(logits: Column | str = "logits") -> Column:
    return softmax(logits)


def score_with(df: DataFrame, fn, n_classes: int, features: str = "features",
               keep: list[str] | None = None, batch_rows: int = 1024, dtype: str = "float32") -> DataFrame:
    """Apply ``fn(ndarray (n, d)) -> ndarray (n, k)`` to at most
    ``batch_rows`` rows at a time, in ``dtype`` (what a network expects);
    returns keep columns plus ``logits`` (array<double> of length k)."""
    import numpy as np

    keep = keep or [c for c in df.columns if c != features]
    fields = [df.schema[c] for c in keep] + [T.StructField("logits", T.ArrayType(T.DoubleType()))]
    schema = T.StructType(fields)

    def run(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            for i in range(0, len(pdf), batch_rows):
                part = pdf.iloc[i:i + batch_rows]
                x = np.stack([np.asarray(v, dtype=dtype) for v in part[features].to_numpy()])
                lg = np.asarray(fn(x), dtype=np.float64).reshape(len(part), n_classes)
                out = part[keep].copy()
                out["logits"] = list(lg)
                yield out

    return df.mapInPandas(run, schema)


def centroid_fn(model: CentroidModel):
    """NumPy twin of ``CentroidModel.with_logits`` for ``score_with`` (a small
    model, which the function carries)."""
    import numpy as np

    if not model.small:
        raise ValueError("no small model")
    rows = sorted(model.table.select("idx", "centroid").collect())
    cents = np.asarray([r["centroid"] for r in rows], dtype=np.float64)

    def fn(x):
        d = ((x[:, None, :] - cents[None, :, :]) ** 2).sum(axis=2)
        return -d

    return fn
