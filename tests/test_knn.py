import os
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from venueflow.operators import evaluate, knn, split


def frame(spark, points, labels=None, id_col="train_id", **extra):
    rows = [(i, [float(x) for x in p], int(labels[i]) if labels is not None else 0) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, f"{id_col} long, vec array<double>, label int")


def brute(points, queries, k, allowed=None):
    out = {}
    for qi, q in enumerate(queries):
        d = ((points - q) ** 2).sum(1)
        ids = [i for i in np.lexsort((np.arange(len(points)), d)) if allowed is None or allowed(qi, i)]
        out[qi] = [int(i) for i in ids[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["train_id"])
    return out


@pytest.mark.parametrize("block_rows", [7, 40, 4096])
@pytest.mark.parametrize("dims", [1, 3, 16])
def test_matches_brute_force_at_any_block_size(spark, dims, block_rows):
    rng = np.random.default_rng(dims)
    points, queries = np.round(rng.normal(size=(150, dims)), 1), np.round(rng.normal(size=(60, dims)), 1)
    got = knn.nearest(
        frame(spark, queries, id_col="query_id"), frame(spark, points), 5, block_rows=block_rows, max_pivots=12
    )
    assert found(got) == brute(points, queries, 5)


def test_a_third_of_the_rows_are_copies(spark):
    rng = np.random.default_rng(0)
    points = np.concatenate([np.zeros((100, 2)), rng.normal(size=(200, 2))])
    got = knn.nearest(frame(spark, points, id_col="query_id"), frame(spark, points), 4, block_rows=16)
    assert found(got) == brute(points, points, 4)


def test_clustered_points_visit_few_cells(spark):
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(scale=0.1, size=(50, 2)) + 100 * np.array([c, -c]) for c in range(6)])
    train = frame(spark, points)
    pivots = points[::50]
    cells = knn._with_cells(train, "vec", pivots)
    summary = knn._cell_summary(cells, len(pivots), 3, None)
    visits = knn._with_visits(frame(spark, points, id_col="query_id"), "vec", None, pivots, summary, 3)
    assert visits.agg(F.max(F.size("_cells"))).first()[0] == 1


def test_other_folds_only(spark):
    rng = np.random.default_rng(5)
    points = np.round(rng.normal(size=(90, 2)), 1)
    fold = np.arange(90) % 3
    df = frame(spark, points).withColumn("fold", (F.col("train_id") % 3).cast("int"))
    asked = df.select(F.col("train_id").alias("query_id"), "vec", "fold")
    got = knn.nearest(asked, df, 6, fold="fold", block_rows=20)
    assert found(got) == brute(points, points, 6, lambda q, i: fold[q] != fold[i])


def test_fewer_rows_than_k(spark):
    points = np.array([[0.0], [1.0]])
    assert found(knn.nearest(frame(spark, [[0.2]], id_col="query_id"), frame(spark, points), 5)) == {0: [0, 1]}


def test_string_ids_break_ties_in_order(spark):
    train = spark.createDataFrame([("b", [0.0], 1), ("a", [2.0], 2), ("c", [9.0], 3)], "train_id string, vec array<double>, label int")
    asked = spark.createDataFrame([("q", [1.0])], "query_id string, vec array<double>")
    assert found(knn.nearest(asked, train, 2)) == {"q": ["a", "b"]}


def test_no_training_rows(spark):
    empty = frame(spark, [[0.0]]).filter("train_id < 0")
    with pytest.raises(ValueError):
        knn.nearest(frame(spark, [[0.0]], id_col="query_id"), empty, 1)


def test_votes():
    labels = np.array([[2, 1, 1], [5, 3, 3]])
    distances = np.array([[0.5, 1.0, 1.0], [0.0, 1.0, 2.0]])
    assert knn._prefix_votes(labels, distances, "uniform").tolist() == [[2, 1, 1], [5, 3, 3]]
    # 1/0.5 equals 1/1 + 1/1, so the smaller label wins; an exact match beats everything.
    assert knn._prefix_votes(labels, distances, "distance").tolist() == [[2, 2, 1], [5, 5, 5]]


def test_regression_and_classification(spark):
    points = np.array([[0.0], [1.0], [2.0], [10.0]])
    train = frame(spark, points, labels=[1, 1, 4, 9])
    near = knn.nearest(frame(spark, [[0.9]], id_col="query_id"), train, 3)
    assert knn.regress(near).first()["prediction"] == 2.0
    assert knn.classify(near, 3).first()["prediction"] == 1


def test_grid_equals_separate_runs(spark):
    rng = np.random.default_rng(9)
    points = rng.normal(size=(80, 2))
    labels = (points[:, 0] > 0).astype(int)
    df = frame(spark, points, labels).withColumnRenamed("train_id", "vec_id")
    folded = split.stratified_folds(df, "label", ["vec_id"], 4).cache()
    scores = {(r["n_neighbors"], r["weights"], r["fold"]): (r["n_hits"], r["n_rows"]) for r in knn.grid_scores(folded, 5).collect()}
    fold = {r["vec_id"]: r["fold"] for r in folded.collect()}
    for k in (1, 4, 5):
        for f in range(1, 5):
            hits = 0
            asked = [i for i in range(80) if fold[i] == f]
            for i in asked:
                d = ((points - points[i]) ** 2).sum(1)
                near = [j for j in np.argsort(d) if fold[int(j)] != f][:k]
                votes = np.bincount(labels[near], minlength=2)
                hits += int(votes.argmax() == labels[i])
            assert scores[(k, "uniform", f)] == (hits, len(asked))
    assert len(scores) == 5 * 2 * 4


def test_search_over_scores(spark):
    rows = [(k, w, 0.5 + (k == 3) * 0.2) for k in range(1, 6) for w in ("uniform", "distance")]
    scored = spark.createDataFrame(rows, "n_neighbors int, weights string, pooled_score double")
    best = evaluate.best_params(scored, "pooled_score", ["n_neighbors", "-weights"]).first()
    assert (best["n_neighbors"], best["weights"]) == (3, "uniform")
    drawn = evaluate.random_search(scored, ["n_neighbors", "weights"], 4, [1, 2])
    per_seed = drawn.groupBy("seed").agg(F.countDistinct("n_neighbors", "weights").alias("n")).collect()
    assert [r["n"] for r in per_seed] == [4, 4]
    again = evaluate.random_search(scored, ["n_neighbors", "weights"], 4, [1, 2])
    assert drawn.exceptAll(again).count() == 0


def test_workers_need_no_installed_package(tmp_path):
    """The driver finds the package through sys.path only; the workers start in another folder."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pyspark.sql import SparkSession
from venueflow.operators import knn
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
rows = [(i, [float(i)], i % 2) for i in range(5)]
train = spark.createDataFrame(rows, "train_id long, vec array<double>, label int")
near = knn.nearest(train.withColumnRenamed("train_id", "query_id"), train, 2)
print("classified", knn.classify(near, 2).count())
"""
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=240,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "classified 5" in run.stdout, run.stderr[-2000:]
