import datetime as dt
import random

import pytest
from conftest import plan
from pyspark.sql import functions as F

from venueflow.operators import split
from venueflow.operators.position import with_position


@pytest.fixture(scope="module")
def panel(spark):
    """500 rows, a third of them on one day."""
    rng = random.Random(1)
    rows = [(dt.date(2017, 1, 1) + dt.timedelta(days=7 if i % 3 == 0 else rng.randrange(30)), f"s{i:04d}") for i in range(500)]
    rng.shuffle(rows)
    return sorted(rows), spark.createDataFrame(rows, "d date, s string").repartition(7)


def test_positions_are_exact_with_a_hot_key(panel):
    rows, df = panel
    got = with_position(df, ["d", "s"]).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(500))
    assert [(r["d"], r["s"]) for r in got] == rows


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.15, 0.333, 0.9, 1.0])
def test_holdout_is_the_exact_tail(panel, fraction):
    rows, df = panel
    head, tail = split.head_tail(df, "d", ["s"], fraction)
    cut = len(rows) - int(len(rows) * fraction)
    assert sorted((r["d"], r["s"]) for r in tail.collect()) == rows[cut:]
    assert sorted((r["d"], r["s"]) for r in head.collect()) == rows[:cut]


@pytest.mark.parametrize("k", [2, 5, 7])
def test_expanding_folds(panel, k):
    rows, df = panel
    folded = split.expanding_folds(df, "d", ["s"], k)
    size = len(rows) // (k + 1)
    for fold in range(1, k + 1):
        train, test = split.fold_frames(folded, fold)
        start = len(rows) - (k - fold + 1) * size
        assert sorted((r["d"], r["s"]) for r in test.collect()) == rows[start : start + size]
        assert train.count() == start
    sizes = {r["fold"]: (r["n_train"], r["n_test"]) for r in split.fold_sizes(folded, k).collect()}
    assert sizes[1] == (len(rows) - k * size, size) and sizes[k] == (len(rows) - size, size)


def test_twelve_rows_five_folds(spark):
    df = spark.createDataFrame([(dt.date(2017, 1, 1 + i), "s") for i in range(12)], "d date, s string")
    sizes = split.fold_sizes(split.expanding_folds(df, "d", ["s"], 5), 5).orderBy("fold").collect()
    assert [(r["n_train"], r["n_test"]) for r in sizes] == [(2, 2), (4, 2), (6, 2), (8, 2), (10, 2)]


def test_splits_do_not_shuffle_the_facts(panel):
    _, df = panel
    flagged = split.chronological_holdout(df.coalesce(1), "d", ["s"], 0.2)
    assert "Exchange hashpartitioning" not in plan(flagged) and "rangepartitioning" not in plan(flagged)


@pytest.mark.parametrize("k", [2, 5, 10])
def test_stratified_folds_match_ntile(spark, k):
    rows = [(i, 0 if i % 3 else i % 7) for i in range(301)]
    df = spark.createDataFrame(rows, "id int, label int")
    df.createOrReplaceTempView("labelled")
    want = spark.sql(f"SELECT id, ntile({k}) OVER (PARTITION BY label ORDER BY id) AS fold FROM labelled")
    got = split.stratified_folds(df, "label", ["id"], k).select("id", "fold")
    assert got.exceptAll(want).count() == 0 and got.count() == 301


def test_fold_smaller_than_k(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id int, label int")
    got = {r["id"]: r["fold"] for r in split.stratified_folds(df, "label", ["id"], 5).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_position_is_stable_between_reads(panel):
    _, df = panel
    placed = with_position(df, ["d", "s"])
    again = placed.alias("a").join(placed.alias("b"), ["d", "s"]).filter(F.col("a.position") != F.col("b.position"))
    assert again.count() == 0


def test_holdout_counts_are_exact_on_ties_and_missing_dates(spark):
    from pyspark.sql import functions as F

    from venueflow.operators.split import chronological_holdout

    df = spark.range(20).select(F.lit("2020-01-01").cast("date").alias("d"), F.lit(1).alias("k"), F.col("id").alias("v"))
    assert chronological_holdout(df, "d", ["k"], 0.1).filter("is_validation").count() == 2
    gaps = spark.range(10).select(F.when(F.col("id") >= 6, F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))).alias("d"), F.col("id").alias("k"))
    for fraction in (0.2, 0.5, 0.9):
        assert chronological_holdout(gaps, "d", ["k"], fraction).filter("is_validation").count() == int(10 * fraction)


def test_rows_with_map_columns_are_ordered(spark):
    from venueflow.functions.columns import row_hash
    from venueflow.operators.split import chronological_holdout

    rows = spark.range(20).selectExpr("date'2020-01-01' as d", "id % 2 as s", "map('k', id) as m", "struct(map(1, id) as n) as t")
    assert chronological_holdout(rows, "d", ["s"], 0.25).filter("is_validation").count() == 5
    two = spark.sql("SELECT map('a', 1, 'b', 2) AS m UNION ALL SELECT map('b', 2, 'a', 1)")
    assert two.select(row_hash(two).alias("h")).distinct().count() == 1
