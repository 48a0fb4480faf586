"""Regression models of the ensemble, as Spark ML estimators on the log of the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueflow.functions.columns import clip
from venueflow.session import shared_folder

LOG_TARGET = "log_target"
LOG_CEILING = 6.8  # fixed value: upper clip of the factor model's log prediction


def boosted_trees(rounds: int = 200, depth: int = 10, rate: float = 0.2, rows: float = 0.8, seed: int = 3, **params) -> GBTRegressor:
    """Gradient-boosted trees with row sampling."""
    return GBTRegressor(labelCol=LOG_TARGET, maxIter=rounds, maxDepth=depth, stepSize=rate,
                        subsamplingRate=rows, seed=seed, checkpointInterval=10, **params)


def boosted_trees_until(validation: str, tolerance: float = 0.01, **params) -> GBTRegressor:
    """Boosting that stops once the rows flagged in ``validation`` gain less than ``tolerance`` (of their error, relative)."""
    return boosted_trees(validationIndicatorCol=validation, validationTol=tolerance, **params)


def boosted_trees_with_column_sampling(columns: float = 0.8, **params) -> GBTRegressor:
    """Boosting that also samples features (per node) at every split."""
    return boosted_trees(featureSubsetStrategy=str(columns), **params)


def random_forest(trees: int = 10, depth: int = 10, seed: int = 10, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=LOG_TARGET, numTrees=trees, maxDepth=depth, seed=seed, **params)


def linear() -> LinearRegression:
    return LinearRegression(labelCol=LOG_TARGET)


def lasso(alpha: float = 0.1) -> LinearRegression:
    """L1 penalty on raw columns; without standardization the objective is the usual lasso's."""
    return LinearRegression(labelCol=LOG_TARGET, regParam=alpha, elasticNetParam=1.0, standardization=False)


def log_target(df: DataFrame, target: str = "visitors") -> DataFrame:
    return df.withColumn(LOG_TARGET, F.log1p(F.col(target)))


def fit_log_target(
    estimator: Estimator, train: DataFrame, columns: Sequence[str], target: str = "visitors"
) -> PipelineModel:
    """Fit on log1p(target) over assembled numeric columns.

    Boosting cuts its growing lineage by checkpoints, so the shared folder is set before fitting.
    """
    shared_folder(train.sparkSession)
    rows = log_target(train, target)
    return Pipeline(stages=[VectorAssembler(inputCols=list(columns), outputCol="features"), estimator]).fit(rows)


def predict_log(model: PipelineModel, df: DataFrame, name: str, lower=None, upper=None) -> DataFrame:
    """Add the log prediction under ``name``, optionally clipped."""
    out = model.transform(df).withColumn(name, clip("prediction", lower, upper))
    return out.drop(*[c for c in out.columns if c not in df.columns and c != name])


def scores_by_round(model: PipelineModel, df: DataFrame, target: str = "visitors") -> DataFrame:
    """(round, rmsle) of a fitted boosting pipeline on ``df``: its error with the first 1, 2, .. trees, from one pass."""
    rows = log_target(df, target)
    for stage in model.stages[:-1]:
        rows = stage.transform(rows)
    errors = model.stages[-1].evaluateEachIteration(rows, "squared")
    return df.sparkSession.createDataFrame([(i, float(e) ** 0.5) for i, e in enumerate(errors, start=1)], "round int, rmsle double")


def invert_log(column: str):
    """Back to the target's scale, never below 0."""
    return clip(F.expm1(F.col(column)), lower=0)
