import numpy as np
import pytest
from pyspark.sql import functions as F

from venueflow.operators import models, select
from venueflow.operators.evaluate import LogRmse
from venueflow.plans.tuning import cross_validated_grid


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    data = [(f"i{n:03d}", int(c), float(x), float(np.expm1(1 + 0.5 * c + x + 0.05 * rng.normal())))
            for n, (c, x) in enumerate(zip(rng.integers(0, 4, 300), rng.random(300)))]
    return spark.createDataFrame(data, "id string, c int, x double, visitors double").cache()


def error(model, df):
    out = models.predict_log(model, df, "prediction").withColumn("log_target", F.log1p("visitors"))
    return LogRmse().evaluate(out)


def spread(df):
    return df.agg(F.stddev_pop(F.log1p("visitors"))).first()[0]


@pytest.mark.parametrize("estimator", [
    lambda: models.boosted_trees(rounds=10, depth=3),
    lambda: models.boosted_trees_with_column_sampling(rounds=10, depth=3),
    lambda: models.random_forest(depth=5),
    lambda: models.linear(),
    lambda: models.lasso(0.01),
], ids=["trees", "sampled", "forest", "linear", "lasso"])
def test_models_beat_the_mean(rows, estimator):
    model = models.fit_log_target(estimator(), rows, ["c", "x"])
    assert error(model, rows) < 0.7 * spread(rows)


def test_lasso_matches_the_closed_form(spark):
    x = np.linspace(0, 3, 40)
    y = 0.5 * x + 1
    df = spark.createDataFrame([(float(a), float(np.expm1(b))) for a, b in zip(x, y)], "x double, visitors double")
    model = models.fit_log_target(models.lasso(0.1), df, ["x"]).stages[-1]
    slope = (np.cov(x, y, bias=True)[0, 1] - 0.1) / x.var()
    assert model.coefficients[0] == pytest.approx(slope, abs=1e-6)


def test_importances(rows):
    model = models.fit_log_target(models.boosted_trees(rounds=5, depth=3), rows, ["c", "x"]).stages[-1]
    shares = select.split_importance(model, ["c", "x"]).collect()
    assert sum(r["score"] for r in shares) == pytest.approx(1) and shares[0]["score"] <= shares[-1]["score"]
    assert {r["feature"] for r in select.gain_importance(model, ["c", "x"]).collect()} == {"c", "x"}


def test_cross_validated_grid(rows):
    grid = cross_validated_grid(models.linear(), {"regParam": [0.0, 5.0]}, rows, ["c", "x"], "id", 3)
    best = [r["regParam"] for r in grid.filter("is_best").collect()]
    assert best == [0.0]
