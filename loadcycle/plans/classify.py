"""Train/test split, logistic regression and its accuracy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcycle.sources.scratch import scratch_path


def split_by_key(df: DataFrame, key: str, train_percent: int = 80, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, decided by a hash of the key: the same on every run and every retry."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), 1, 8)
    bucket = F.conv(digits, 16, 10).cast("long") % 100
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def fit_logistic(train: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """The fitted steps, written and read back.

    A model fresh from its fit carries a summary that holds the session; tasks cannot take it along once the session has
    observed a query (``Dataset.observe``), and the model could score no row. The written model has no summary.
    """
    steps = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label),
    ]
    path = scratch_path(train.sparkSession, "model")
    Pipeline(stages=steps).fit(train).write().save(path)
    return PipelineModel.load(path)


def accuracy_of(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Share of the rows whose prediction is the label, in one row; rows without either do not count."""
    both = scored.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    return both.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def accuracy(model: PipelineModel, test: DataFrame, label: str) -> float:
    return accuracy_of(model.transform(test), label).first()["accuracy"]


def gradient(model: PipelineModel, train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """feature, gradient: the mean slope of the log likelihood at the fitted coefficients, over all training rows.

    It is 0 for every feature exactly where the fit has found the maximum.
    """
    fitted = model.stages[-1]
    linear = F.lit(float(fitted.intercept))
    for name, weight in zip(features, fitted.coefficients):
        linear = linear + F.col(name) * F.lit(float(weight))
    error = F.col(label) - 1 / (1 + F.exp(-linear))
    slopes = F.array(
        F.struct(F.lit("intercept").alias("feature"), error.alias("slope")),
        *[F.struct(F.lit(f).alias("feature"), (error * F.col(f)).alias("slope")) for f in features],
    )
    rows = train.select(F.explode(slopes).alias("s"))
    return rows.groupBy("s.feature").agg(F.avg("s.slope").alias("gradient"))
