"""Validation plans on planted problems."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from venueflow.functions.columns import rmse
from venueflow.operators import blend, models, select
from venueflow.plans import validation


@pytest.fixture(scope="module")
def rows(spark):
    """log target = 1 + 2 a + b; c is noise; dates and ids in row order."""
    rng = np.random.default_rng(3)
    x = rng.random((600, 3))
    y = 1 + 2 * x[:, 0] + x[:, 1] + 0.05 * rng.normal(size=600)
    data = [(i, f"2020-{1 + i // 100:02d}-{1 + i % 28:02d}", *map(float, r), float(np.expm1(t))) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id int, d string, a double, b double, c double, visitors double").withColumn("d", F.to_date("d")).cache()


def test_expanding_window_equals_fits_by_hand(rows):
    linear = {"linear": models.linear(), "lasso": models.lasso(0.05)}
    out = {(r["model"], r["fold"]): r for r in validation.expanding_window_scores(rows, "d", ["id"], ["a", "b"], linear, k=3).collect()}
    assert set(out) == {(m, f) for m in linear for f in (1, 2, 3)}
    ordered = rows.orderBy("d", "id").toPandas()
    x, y = ordered[["a", "b"]].to_numpy(), np.log1p(ordered["visitors"].to_numpy())
    design = np.column_stack([np.ones(len(x)), x])
    for fold in (1, 2, 3):
        lo, hi = 150 * fold, 150 * (fold + 1)
        w = np.linalg.lstsq(design[:lo], y[:lo], rcond=None)[0]
        r = out["linear", fold]
        assert (r["n_train"], r["n_test"]) == (lo, 150)
        assert r["rmsle"] == pytest.approx(float(np.sqrt(np.mean((y[lo:hi] - design[lo:hi] @ w) ** 2))), rel=1e-6)
    means = {r["model"]: r for r in validation.mean_over_folds(validation.expanding_window_scores(rows, "d", ["id"], ["a"], {"m": models.linear()}, k=2)).collect()}
    assert means["m"]["n_folds"] == 2


def test_folds_without_rows_have_no_score(rows):
    out = validation.expanding_window_scores(rows.limit(2), "d", ["id"], ["a"], {"m": models.linear()}, k=3).collect()
    assert [r["rmsle"] for r in out] == [None] * 3


def test_elimination_drops_the_noise_first(rows):
    train, test = rows.filter("id % 4 <> 0"), rows.filter("id % 4 = 0")
    out = validation.backward_elimination(train, test, ["a", "b", "c"], models.boosted_trees(rounds=8, depth=3), [1, 1, 5], select.gain_importance).orderBy("step").collect()
    assert [r["dropped"] for r in out] == [[], ["c"], ["b"], []] and [r["n_columns"] for r in out] == [3, 2, 1, 1]
    assert out[2]["rmsle"] > out[1]["rmsle"] and abs(out[1]["rmsle"] - out[0]["rmsle"]) < 0.05


def test_halving_finds_the_winner_of_the_full_grid_with_fewer_row_fits(rows):
    draws = validation.drawn_sets({"regParam": [0.0, 0.3, 1.0, 3.0], "elasticNetParam": [0.0, 1.0]}, 8, seed=4)
    assert len({tuple(d.items()) for d in draws}) == 8 and draws == validation.drawn_sets({"regParam": [0.0, 0.3, 1.0, 3.0], "elasticNetParam": [0.0, 1.0]}, 8, seed=4)
    place = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    out = validation.successive_halving(rows, place, ["a", "b", "c"], models.linear(), draws).collect()
    assert [sum(r["round"] == i for r in out) for i in (1, 2, 3, 4)] == [8, 4, 2, 1]
    shares = {r["round"]: (r["share"], r["n_train"]) for r in out}
    assert [shares[i][0] for i in (1, 2, 3, 4)] == [0.125, 0.25, 0.5, 1.0]
    assert sum(r["n_train"] for r in out) < 8 * shares[4][1]
    winner = next(r for r in out if r["round"] == 4)
    assert winner["kept"] and winner["regParam"] == 0.0


def test_gram_gives_the_error_of_any_blend(spark):
    rng = np.random.default_rng(2)
    y = rng.normal(size=400)
    p = np.stack([y + s * rng.normal(size=400) + b for s, b in ((0.5, 0.0), (0.4, 0.3), (2.0, 0.0))], axis=1)
    df = spark.createDataFrame([(float(t), *map(float, r)) for t, r in zip(y, p)] + [(None, 1.0, 1.0, 1.0)], "y double, m1 double, m2 double, m3 double")
    gram, n = blend.error_gram(df, "y", ["m1", "m2", "m3"])
    assert n == 400
    for w in ([1, 0, 0], [0.2, 0.5, 0.3]):
        direct = df.agg(rmse("y", sum(F.col(c) * float(x) for c, x in zip(("m1", "m2", "m3"), w)))).first()[0]
        assert blend.blend_rmse(gram, w) == pytest.approx(direct)
    grid = min(blend.blend_rmse(gram, [i / 50, j / 50, (50 - i - j) / 50]) for i, j in itertools.product(range(51), repeat=2) if i + j <= 50)
    best = blend.best_convex_weights(gram)
    assert best.min() >= 0 and best.sum() == pytest.approx(1) and grid - 1e-3 <= blend.blend_rmse(gram, best) <= grid + 1e-12


@pytest.mark.parametrize("seed", range(12))
def test_weights_satisfy_the_optimality_conditions(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 7))
    a = rng.normal(size=(n + (seed % 3) * 4 + 1, n)) + rng.normal(size=n)
    if seed % 4 == 0:
        a[:, -1] = a[:, 0]  # two members alike
    gram = a.T @ a
    w = blend.best_convex_weights(gram)
    slope = gram @ w
    assert w.min() >= 0 and w.sum() == pytest.approx(1)
    assert slope.min() >= w @ slope - 1e-8 * np.trace(gram)


def test_report_without_rows(spark):
    empty = spark.createDataFrame([], "y double, m double")
    assert [tuple(r)[:3] for r in blend.weight_report(empty, "y", ["m"]).collect()] == [("m", 0, None)]
