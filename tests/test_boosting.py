"""Boosting with columns per tree, early stopping, and scores by round."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from venueflow.functions.columns import rmse
from venueflow.operators import models
from venueflow.operators.boosting import ColumnSampledBoosting, drawn_columns

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    x = rng.random((800, 4))
    y = 2 + x @ np.array([1.0, 0.5, 0.3, 0.2]) + 0.4 * rng.normal(size=800)
    data = [(*map(float, r), float(np.expm1(t)), bool(i % 4 == 0)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "a double, b double, c double, d double, visitors double, held boolean").cache()


def error(df, p="p"):
    return df.agg(rmse(F.log1p("visitors"), p)).first()[0]


def test_one_column_per_tree_is_the_seeded_draw(rows):
    model = ColumnSampledBoosting(rounds=6, depth=2, columns=0.25, seed=11).fit(rows, NAMES)
    assert model.tree_columns() == [drawn_columns(NAMES, 0.25, 11, i) for i in range(1, 7)]
    assert len({c for t in model.tree_columns() for c in t}) > 1


def test_beats_the_mean_and_scores_match_predictions(rows):
    model = ColumnSampledBoosting(rounds=8, depth=3, columns=0.75, validation="held", write_every=3).fit(rows, NAMES)
    scores = model.scores_by_round(rows).orderBy("round").collect()
    assert [r["round"] for r in scores] == list(range(9)) and scores[-1]["train_rmsle"] < 0.85 * scores[0]["train_rmsle"]
    held = model.predict_log(rows.filter("held"), "p")
    assert error(held) == pytest.approx(scores[-1]["validation_rmsle"])


def test_leaf_values_are_shrunk_sums(spark):
    df = spark.createDataFrame([(0.0, float(np.expm1(1))), (0.0, float(np.expm1(2))), (1.0, float(np.expm1(6)))], "a double, visitors double")
    model = ColumnSampledBoosting(rounds=1, depth=1, rate=0.5, rows=1.0, columns=1.0, ridge=2.0).fit(df, ["a"])
    got = {r["a"]: r["p"] for r in model.predict_log(df, "p").collect()}
    assert got == pytest.approx({0.0: 3 + 0.5 * -3 / 4, 1.0: 3 + 0.5 * 3 / 3})


def test_a_noisy_fit_stops_early_and_keeps_its_best_trees(spark):
    rng = np.random.default_rng(1)
    noise = [(*map(float, rng.random(2)), float(np.expm1(3 + rng.normal())), i % 3 == 0) for i in range(600)]
    df = spark.createDataFrame(noise, "a double, b double, visitors double, held boolean")
    model = ColumnSampledBoosting(rounds=30, depth=4, rate=0.5, validation="held", patience=3).fit(df, ["a", "b"])
    errors = [e[1] for e in model.errors]
    assert len(errors) - 1 < 30 and len(model.trees) == int(np.argmin(errors))
    spark_model = models.fit_log_target(models.boosted_trees_until("held", tolerance=0.05, rounds=30, depth=4, rate=0.5), df, ["a", "b"])
    assert spark_model.stages[-1].getNumTrees < 30


def test_scores_by_round_of_spark_boosting(rows):
    model = models.fit_log_target(models.boosted_trees(rounds=4, depth=2), rows, NAMES)
    scores = models.scores_by_round(model, rows).orderBy("round").collect()
    assert [r["round"] for r in scores] == [1, 2, 3, 4]
    assert scores[-1]["rmsle"] == pytest.approx(error(models.predict_log(model, rows, "p")))


def test_clashing_names_and_no_rows(rows):
    odd = rows.withColumns({"_f": F.lit(1), "_leaf": F.lit("x"), "_row": F.lit(2)})
    model = ColumnSampledBoosting(rounds=1, depth=1).fit(odd, NAMES)
    assert model.predict_log(odd, "p").columns == [*odd.columns, "p"]
    with pytest.raises(ValueError):
        ColumnSampledBoosting(rounds=1).fit(rows.limit(0), NAMES)
