"""Model validation: expanding windows over time, boosting rounds, feature elimination, growing searches.

Every plan writes the model inputs once, runs independent fits side by side, and returns a score
table. Scores are root mean squared errors of the log target.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueflow.functions.columns import rmse
from venueflow.operators.models import LOG_TARGET, log_target
from venueflow.operators.select import select_by_rank, split_importance
from venueflow.operators.split import expanding_folds, fold_frames, fold_sizes
from venueflow.session import in_parallel, materialize, shared_folder


def model_inputs(df: DataFrame, columns: Sequence[str], target: str = "visitors") -> DataFrame:
    """``df`` with its feature vector and log target; the vector is stored sparse where that is shorter."""
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(log_target(df, target))


def fit_score(estimator: Estimator, train: DataFrame, test: DataFrame) -> float | None:
    """Error on ``test`` of the estimator fitted on ``train``; both hold vectors and log target."""
    return estimator.fit(train).transform(test).agg(rmse(LOG_TARGET, "prediction")).first()[0]


def expanding_window_scores(
    df: DataFrame, date: str, ties: Sequence[str], columns: Sequence[str], models: Mapping[str, Estimator],
    k: int = 5, target: str = "visitors", parallelism: int = 4,
) -> DataFrame:
    """(model, fold, n_train, n_test, rmsle): fold i fits on all segments before i and scores segment i.

    Vectors are written once, one folder per segment, so a fold reads just its own segments; no row
    is copied into a fold. A fold without training or test rows has no score.
    """
    spark = df.sparkSession
    shared_folder(spark)  # boosting cuts its lineage there
    folded = expanding_folds(model_inputs(df, columns, target), date, ties, k).select("segment", "features", LOG_TARGET)
    folded = materialize(folded, "expanding-vectors", by="segment")
    sizes = {r["fold"]: (r["n_train"], r["n_test"]) for r in fold_sizes(folded, k).collect()}
    folds = [(name, fold) for fold in range(1, k + 1) for name in models]

    def score(name: str, fold: int):
        n_train, n_test = sizes.get(fold, (0, 0))
        train, test = fold_frames(folded, fold)
        value = fit_score(models[name].copy(), train, test) if n_train and n_test else None
        return name, fold, n_train, n_test, value

    rows = in_parallel(spark, [lambda a=a: score(*a) for a in folds], parallelism)
    return spark.createDataFrame(rows, "model string, fold int, n_train long, n_test long, rmsle double")


def mean_over_folds(scores: DataFrame) -> DataFrame:
    """(model, n_folds, mean_rmsle, pooled_rmsle): folds counted alike, and by their test rows."""
    scored = scores.filter(F.col("rmsle").isNotNull())
    pooled = F.sqrt(F.sum(F.col("rmsle") * F.col("rmsle") * F.col("n_test")) / F.sum("n_test"))
    return scored.groupBy("model").agg(F.count(F.lit(1)).alias("n_folds"), F.avg("rmsle").alias("mean_rmsle"), pooled.alias("pooled_rmsle"))


def backward_elimination(
    train: DataFrame, test: DataFrame, columns: Sequence[str], estimator: Estimator, drops: Sequence[int],
    importance: Callable[[object, Sequence[str]], DataFrame] = split_importance, target: str = "visitors",
) -> DataFrame:
    """(step, n_columns, columns, dropped, rmsle): fit, rank, drop the lowest, refit; each fit scored on ``test``.

    Step 0 fits all columns; step i has dropped another ``drops[i - 1]`` of them, those the fit before
    ranks lowest (columns it never uses first; ties by name). One column always stays. Vectors of all
    columns are written once and sliced per step.
    """
    spark = train.sparkSession
    shared_folder(spark)
    rows = materialize(model_inputs(train, columns, target).select("features", LOG_TARGET), "elimination-train")
    held = materialize(model_inputs(test, columns, target).select("features", LOG_TARGET), "elimination-test")
    names, left, steps = list(columns), list(columns), []
    for step, drop in enumerate([0, *drops]):
        if step:
            used = {r["feature"]: float(r["score"]) for r in importance(model, left).collect()}  # noqa: F821 - fitted in the step before
            ranked = spark.createDataFrame([(c, used.get(c, 0.0)) for c in left], "feature string, score double")
            kept = {r["feature"] for r in select_by_rank(ranked, min(drop, len(left) - 1)).collect()}
        else:
            kept = set(left)
        dropped, left = sorted(set(left) - kept), [c for c in left if c in kept]
        slicer = VectorSlicer(inputCol="features", outputCol="kept", indices=[names.index(c) for c in left])
        model = estimator.copy({estimator.getParam("featuresCol"): "kept"}).fit(slicer.transform(rows))
        error = model.transform(slicer.transform(held)).agg(rmse(LOG_TARGET, "prediction")).first()[0]
        steps.append((step, len(left), left, dropped, error))
    return spark.createDataFrame(steps, "step int, n_columns int, columns array<string>, dropped array<string>, rmsle double")


def successive_halving(
    df: DataFrame, place: Column, columns: Sequence[str], estimator: Estimator, draws: Sequence[Mapping[str, float]],
    held: float = 0.2, target: str = "visitors", parallelism: int = 4,
) -> DataFrame:
    """(round, draw, <parameters>, share, n_train, rmsle, kept): a search that trains many sets on few rows and few on many.

    ``place`` spreads the rows evenly over [0, 1), say by a hash of their key. Rows below ``held`` score
    all rounds. Of the others, the last round uses all and each earlier one half as many as the next;
    the better half of the sets (rounded up; ties by order) goes on, until one is left.
    """
    spark = df.sparkSession
    shared_folder(spark)
    rows = model_inputs(df, columns, target).select("features", LOG_TARGET, place.cast("double").alias("place"))
    rows = materialize(rows, "halving-rows")
    test = rows.filter(F.col("place") < held)
    alive, n_rounds, size = list(range(len(draws))), 1, len(draws)
    while size > 1:
        size, n_rounds = (size + 1) // 2, n_rounds + 1
    out = []
    for i in range(1, n_rounds + 1):
        share = 0.5 ** (n_rounds - i)
        train = rows.filter((F.col("place") >= held) & (F.col("place") < held + (1 - held) * share))
        n_train = train.count()

        def score(draw: int):
            settings = {estimator.getParam(k): v for k, v in draws[draw].items()}
            return fit_score(estimator.copy(settings), train, test) if n_train else None

        scores = in_parallel(spark, [lambda d=d: score(d) for d in alive], parallelism)
        order = sorted(range(len(alive)), key=lambda j: (scores[j] is None, scores[j], alive[j]))
        best = sorted(alive[j] for j in order[: (len(alive) + 1) // 2]) if len(alive) > 1 else alive
        out += [(i, d, *(float(v) for v in draws[d].values()), share, n_train, e, d in best) for d, e in zip(alive, scores)]
        alive = best
    names = ", ".join(f"{n} double" for n in (draws[0] if draws else {}))
    return spark.createDataFrame(out, f"round int, draw int, {names}, share double, n_train long, rmsle double, kept boolean")


def drawn_sets(grid: Mapping[str, Sequence[float]], n: int, seed: int) -> list[dict[str, float]]:
    """``n`` parameter sets of a grid, drawn without replacement in the md5 order of seed and values."""
    import hashlib

    sets = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return sorted(sets, key=lambda s: hashlib.md5("|".join([str(seed), *map(str, s.values())]).encode()).hexdigest())[:n]
