"""Training a window classifier on the cluster.

Windows become channel features (mean, deviation, extremes per channel) by
one aggregation, and a ``pyspark.ml`` pipeline (label index, assembler,
scaler, multinomial logistic regression) is fitted to those of the training
subjects.  The optimiser's passes are distributed aggregations; what the
driver holds is the model.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATS = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}


def feature_names(channels: list[str]) -> list[str]:
    return [f"{c}_{s}" for c in channels for s in STATS]


def window_features(cells: DataFrame, key: list[str], channels: list[str]) -> DataFrame:
    """Wide rows of windows (key..., k, channels...) -> one row per window
    with its channel features; windows with a missing value are left out."""
    aggs = [f(c).alias(f"{c}_{s}") for c in channels for s, f in STATS.items()]
    return cells.groupBy(*key, "k").agg(*aggs).na.drop(subset=feature_names(channels))


def fit(features: DataFrame, channels: list[str], label: str = "label", max_iter: int = 25,
        reg: float = 1e-4) -> PipelineModel:
    """Fit the pipeline to window features with a label."""
    stages = [
        StringIndexer(inputCol=label, outputCol="y_true", handleInvalid="keep"),
        VectorAssembler(inputCols=feature_names(channels), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True),
        LogisticRegression(featuresCol="_scaled", labelCol="y_true", predictionCol="y_pred", maxIter=max_iter,
                           regParam=reg),
    ]
    return Pipeline(stages=stages).fit(features)


def history(model: PipelineModel) -> list[float]:
    """The training loss before the first and after each iteration."""
    return list(model.stages[-1].summary.objectiveHistory)


def accuracy(model: PipelineModel, features: DataFrame) -> float | None:
    """Share of windows whose label is predicted."""
    right = (F.col("y_pred") == F.col("y_true")).cast("double")
    return model.transform(features).agg(F.avg(right)).first()[0]


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(spark: SparkSession, path: str) -> PipelineModel:
    return PipelineModel.load(path)
