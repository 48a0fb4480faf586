import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from venueflow.operators import blend, evaluate, select


def test_null_aware_mix(spark):
    df = spark.createDataFrame([(10.0, 20.0), (10.0, None), (10.0, -1.0)], "model double, baseline double")
    got = [r[0] for r in df.select(blend.null_aware_mix("model", "baseline")).collect()]
    assert got == [pytest.approx(0.7 * 10 + 0.3 * 20 * 1.1), 10.0, 10.0]


def test_half_and_fixed_mix(spark):
    df = spark.createDataFrame([(10.0, 20.0)], "model double, baseline double")
    assert df.select(blend.half_blend("model", "baseline")).first()[0] == pytest.approx(16.0)
    assert df.select(blend.mix_with_baseline("model", "baseline")).first()[0] == pytest.approx(13.6)


def test_log_blend_is_floored(spark):
    df = spark.createDataFrame([(math.log1p(3.0), math.log1p(3.0)), (-2.0, -2.0)], "a double, b double")
    got = [r["visitors"] for r in blend.blend_log_predictions(df, ["a", "b"], [0.3, 0.7]).collect()]
    assert got == [pytest.approx(3.0), 0.0]


def test_missing_and_compared_forecasts(spark):
    a = spark.createDataFrame([("x", 3.0), ("y", 1.0), ("z", 5.0)], "id string, visitors double")
    b = spark.createDataFrame([("x", 2.0), ("y", 4.0), ("w", -1.0)], "id string, visitors double")
    assert [r["id"] for r in blend.missing_forecasts(b).collect()] == ["w"]
    r = blend.compare_forecasts(blend.join_forecasts(a, b)).first()
    assert (r["n_rows"], r["n_first_higher"], r["mean_difference"]) == (2, 1, -1.0)


def test_metrics(spark):
    df = spark.createDataFrame([(math.e - 1, 0.0, 1, 1), (0.0, 0.0, 2, 3)], "t double, p double, a int, b int")
    assert evaluate.rmsle(df, "t", "p").first()[0] == pytest.approx(math.sqrt(0.5))
    assert evaluate.accuracy(df, "a", "b").first()[0] == 0.5
    logged = df.select(F.log1p("t").alias("log_target"), F.log1p("p").alias("prediction"))
    metric = evaluate.LogRmse()
    assert metric.evaluate(logged) == pytest.approx(math.sqrt(0.5)) and not metric.isLargerBetter()
    report = {r["model"]: r["rmse"] for r in evaluate.score_report(df, "t", ["p", "t"]).collect()}
    assert report["t"] == 0.0 and report["p"] > 1


def test_anova_matches_numpy(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 4, 200)
    x = np.stack([rng.normal(size=200), y + rng.normal(size=200), np.ones(200)], axis=1)

    def f(col):
        groups = [col[y == g] for g in range(4)]
        between = sum(len(g) * (g.mean() - col.mean()) ** 2 for g in groups) / 3
        return between / (sum(((g - g.mean()) ** 2).sum() for g in groups) / 196)

    rows = [(int(a), *map(float, b), [float(v) for v in b]) for a, b in zip(y, x)]
    df = spark.createDataFrame(rows, "y int, a double, b double, c double, v array<double>")
    wide = {r["feature"]: r["score"] for r in select.anova_f(df, ["a", "b", "c"], "y").collect()}
    assert wide["a"] == pytest.approx(f(x[:, 0])) and wide["b"] == pytest.approx(f(x[:, 1])) and wide["c"] is None
    deep = {r["feature"]: r["score"] for r in select.anova_f_vector(df, "v", "y").collect()}
    assert deep[1] == pytest.approx(wide["b"])


def test_select_by_rank(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", 2.0)], "feature string, score double")
    assert sorted(r["feature"] for r in select.select_by_rank(df, 1).collect()) == ["a", "c"]
