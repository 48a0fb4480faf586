import numpy as np
import pytest

from venueflow.operators import approximate, knn

SCHEMA = "{} long, vec array<double>, label int"


def sides(spark, q, x):
    ids = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    asked = [(i, v.tolist(), i % 3) for i, v in enumerate(q)]
    return spark.createDataFrame(asked, SCHEMA.format("query_id")), spark.createDataFrame(ids, SCHEMA.format("train_id"))


def listed(df):
    return {(r["query_id"], r["train_id"]): (r["rank"], r["distance"], r["label"]) for r in df.collect()}


def test_cuts_halve_and_own_leaf_comes_first():
    x = np.random.default_rng(0).normal(size=(4096, 8))
    tree = approximate.fit_cuts(x, 5)
    own = approximate.leaves(x, tree)
    assert np.bincount(own[:, 0]).tolist() == [128] * 32
    many = approximate.leaves(x[:200], tree, 32)
    assert (many[:, 0] == own[:200, 0]).all() and (np.sort(many, axis=1) == np.arange(32)).all()


def test_recall_without_structure(spark):
    rng = np.random.default_rng(1)
    asked, train = sides(spark, rng.uniform(size=(500, 16)), rng.uniform(size=(20_000, 16)))
    exact = knn.nearest(asked, train, 4)
    found = approximate.nearest_approximate(asked, train, 4, tables=4, probes=6, leaf_rows=256)
    row = approximate.recall(found, exact).first()
    assert row["n_exact"] == 2000 and row["recall"] >= 0.9
    want, got = listed(exact), listed(found)
    assert len(got) == 2000
    for pair in want.keys() & got.keys():
        assert got[pair][1:] == want[pair][1:] and got[pair][0] <= want[pair][0]


@pytest.mark.parametrize("n", [2_000, 8_000])
def test_rows_sent_grow_in_proportion(spark, n):
    rng = np.random.default_rng(2)
    x = rng.uniform(size=(n, 16))
    asked, train = sides(spark, x[:100], x)
    trees = [approximate.fit_cuts(x, 6, i) for i in range(3)]
    assert approximate._with_leaves(train, "vec", trees, 1).count() == 3 * n
    assert approximate._with_leaves(asked, "vec", trees, 5).count() == 3 * 5 * 100


@pytest.mark.parametrize("block", [8192, 16])
def test_hot_copies_and_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(approximate, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 4))
    x[::3] = x[0]
    asked, train = sides(spark, x[:50], x)
    # Every leaf is visited, so the answer is the exact one, ties included.
    found = approximate.nearest_approximate(asked, train, 4, tables=2, probes=64, leaf_rows=32)
    assert listed(found) == listed(knn.nearest(asked, train, 4))


def test_folds_and_few_rows(spark):
    rng = np.random.default_rng(4)
    asked, train = sides(spark, rng.normal(size=(9, 3)), rng.normal(size=(9, 3)))
    found = approximate.nearest_approximate(
        asked.withColumnRenamed("label", "f"), train.withColumn("f", train["label"]), 8, fold="f"
    ).collect()
    assert len(found) == 9 * 6 and all(r["query_id"] % 3 != r["label"] for r in found)
    with pytest.raises(ValueError):
        approximate.nearest_approximate(asked, train.filter("label > 5"), 4)
