"""Error metrics, score tables and parameter search over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venueflow.functions.columns import rmse


def rmsle(df: DataFrame, truth: str, prediction: str, name: str = "rmsle") -> DataFrame:
    """One row: root mean squared error of log1p values."""
    return df.agg(rmse(F.log1p(F.col(truth)), F.log1p(F.col(prediction))).alias(name))


class LogRmse(Evaluator):
    """RMSE on already logged columns, usable wherever Spark ML takes an evaluator."""

    def __init__(self, label: str = "log_target", prediction: str = "prediction"):
        super().__init__()
        self.label = label
        self.prediction = prediction

    def _evaluate(self, dataset: DataFrame) -> float:
        return dataset.agg(rmse(self.label, self.prediction)).first()[0]

    def isLargerBetter(self) -> bool:
        return False


def accuracy(df: DataFrame, truth: str, prediction: str, name: str = "accuracy") -> DataFrame:
    return df.agg(F.avg((F.col(truth) == F.col(prediction)).cast("double")).alias(name))


def score_report(df: DataFrame, truth: str, predictions: Sequence[str], name: str = "rmse") -> DataFrame:
    """One row per prediction column: (model, n_rows, rmse), from a single aggregation."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[rmse(truth, p).alias(f"_{p}") for p in predictions]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(p).alias("model"), F.col(f"_{p}").alias(name)) for p in predictions]))
    return wide.select("n_rows", rows.alias("r")).select("r.model", "n_rows", f"r.{name}")


def mean_scores(scores: DataFrame, params: Sequence[str]) -> DataFrame:
    """Per parameter set: mean and spread of the fold accuracies, and the accuracy pooled over all rows."""
    accuracy_of_fold = F.col("n_hits") / F.col("n_rows")
    return scores.groupBy(*params).agg(
        F.avg(accuracy_of_fold).alias("mean_score"),
        F.stddev_pop(accuracy_of_fold).alias("std_score"),
        (F.sum("n_hits") / F.sum("n_rows")).alias("pooled_score"),
    )


def best_params(scored: DataFrame, score: str, params: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row with the highest score (per group); ties go to the first parameter set in order.

    ``params`` maps column to direction by a leading minus, e.g. ``["n_neighbors", "-weights"]``.
    The score table has one row per parameter set (and group).
    """
    order = [F.desc(score)] + [F.desc(p[1:]) if p.startswith("-") else F.asc(p) for p in params]
    ranked = scored.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("_r") == 1).drop("_r")


def random_search(scored: DataFrame, params: Sequence[str], n_iter: int, seeds: Sequence[int]) -> DataFrame:
    """For each seed the ``n_iter`` parameter sets it draws without replacement, with their scores.

    The draw order is the md5 of seed and parameters, so a seed always draws the same sets. The
    grid is a score table with one row per parameter set.
    """
    seeded = scored.withColumn("seed", F.explode(F.lit(list(seeds))))
    key = F.md5(F.concat_ws("|", F.col("seed").cast("string"), *[F.col(p).cast("string") for p in params]))
    drawn = seeded.withColumn("_r", F.row_number().over(Window.partitionBy("seed").orderBy(key)))
    return drawn.filter(F.col("_r") <= n_iter).drop("_r")
