"""Blending of model and baseline forecasts."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueflow.functions.columns import blend, clip

# Share of the model, share of the baseline, and the baseline's uplift.
MODEL_SHARE, BASELINE_SHARE, BASELINE_UPLIFT = 0.7, 0.3, 1.1


def blend_log_predictions(df: DataFrame, predictions: Sequence[str], weights: Sequence[float], name: str = "visitors") -> DataFrame:
    """Weighted sum in log space, inverted and floored at 0."""
    return df.withColumn(name, clip(F.expm1(blend(predictions, weights)), lower=0))


def mix_with_baseline(model: str, baseline: str) -> Column:
    return F.col(model) * MODEL_SHARE + F.col(baseline) * BASELINE_SHARE * BASELINE_UPLIFT


def half_blend(model: str, baseline: str) -> Column:
    return (F.col(model) + F.col(baseline) * BASELINE_UPLIFT) / 2


def null_aware_mix(model: str, baseline: str, sentinel: float = -1) -> Column:
    """The model alone where the baseline is missing, the mix elsewhere."""
    absent = F.col(baseline).isNull() | (F.col(baseline) == F.lit(float(sentinel)))
    return F.when(absent, F.col(model)).otherwise(mix_with_baseline(model, baseline))


def join_forecasts(first: DataFrame, second: DataFrame, key: str = "id", measure: str = "visitors",
                   names: tuple[str, str] = ("model", "baseline")) -> DataFrame:
    """Two forecasts side by side for ids both have."""
    a = first.select(key, F.col(measure).alias(names[0]))
    b = second.select(key, F.col(measure).alias(names[1]))
    return a.join(b, key, "inner")


def compare_forecasts(pair: DataFrame, first: str = "model", second: str = "baseline") -> DataFrame:
    """One row: ids compared, how often the first is higher, and the mean difference."""
    gap = F.col(first) - F.col(second)
    return pair.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(gap > 0).alias("n_first_higher"),
        F.avg(gap).alias("mean_difference"),
    )


def missing_forecasts(forecast: DataFrame, measure: str = "visitors", sentinel: float = -1) -> DataFrame:
    """Rows without a forecast: null or the sentinel."""
    return forecast.filter(F.col(measure).isNull() | (F.col(measure) == F.lit(float(sentinel))))


def error_gram(df: DataFrame, truth: str, predictions: Sequence[str]) -> tuple[np.ndarray, int]:
    """(mean products of the members' errors, rows): with it any blend's mean squared error is w' G w, if the weights sum to 1.

    One aggregation whatever the number of blends; rows missing the truth or a member take no part.
    """
    errors = [F.col(p) - F.col(truth) for p in predictions]
    pairs = [(i, j) for i in range(len(errors)) for j in range(i, len(errors))]
    known = df.dropna(subset=[truth, *predictions])
    sums = known.agg(F.count(F.lit(1)), *[F.avg(errors[i] * errors[j]) for i, j in pairs]).first()
    gram = np.zeros((len(errors), len(errors)))
    for (i, j), v in zip(pairs, sums[1:]):
        gram[i, j] = gram[j, i] = np.nan if v is None else v
    return gram, sums[0]


def blend_rmse(gram: np.ndarray, weights: Sequence[float]) -> float:
    """Error of the blend with these weights (which sum to 1)."""
    w = np.asarray(weights, dtype=float)
    return float(np.sqrt(max(w @ gram @ w, 0.0)))


def best_convex_weights(gram: np.ndarray) -> np.ndarray:
    """The weights of at least 0 that sum to 1 and minimise w' G w.

    Active set: solve on the members in use, walk towards the solution until a weight reaches 0, and
    let the member with the steepest gain in; the error falls every time, so it ends.
    """
    n = len(gram)
    w = np.zeros(n)
    w[int(np.argmin(np.diag(gram)))] = 1.0
    tiny = 1e-12 * max(float(np.trace(gram)), 1e-300)
    for _ in range(50 * n):
        slope = gram @ w
        gain = float(w @ slope) - slope
        if gain.max() <= tiny:
            break
        use = w > 0
        use[int(np.argmax(gain))] = True
        while True:
            at = np.flatnonzero(use)
            kkt = np.zeros((len(at) + 1, len(at) + 1))
            kkt[:-1, :-1], kkt[:-1, -1], kkt[-1, :-1] = gram[np.ix_(at, at)], 1.0, 1.0
            goal = np.linalg.lstsq(kkt, np.array([0.0] * len(at) + [1.0]), rcond=None)[0][:-1]
            if (goal >= 0).all():
                w[:] = 0.0
                w[at] = goal
                break
            step = goal - w[at]
            down = step < 0
            share = np.min(w[at][down] / -step[down])
            w[at] += share * step
            first = at[down][int(np.argmin(w[at][down]))]
            w[first] = 0.0
            use[first] = False
    return w / w.sum()


def weight_report(df: DataFrame, truth: str, predictions: Sequence[str], blends: dict[str, Sequence[float]] | None = None) -> DataFrame:
    """(blend, n_rows, rmse, weights): the best convex blend, each member alone, and any other blend given."""
    gram, n = error_gram(df, truth, predictions)
    alone = {p: [float(i == j) for j in range(len(predictions))] for i, p in enumerate(predictions)}
    wanted = {**({"best": best_convex_weights(gram).tolist()} if n else {}), **alone, **(blends or {})}
    rows = [(name, n, blend_rmse(gram, w) if n else None, [float(x) for x in w]) for name, w in wanted.items()]
    return df.sparkSession.createDataFrame(rows, "blend string, n_rows long, rmse double, weights array<double>")
