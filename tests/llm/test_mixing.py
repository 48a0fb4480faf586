from collections import Counter

import pytest
from pyspark.sql import functions as F

from venueflow.llm import mixing
from llm_fixtures import docs, empty  # noqa: F401


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, total = {}, set(names), sum(sizes.values())
    while True:
        share = {s: total * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3 * sizes[s]
            total -= target[s]
        left -= over


@pytest.mark.parametrize("sizes", [{"a": 900, "b": 30, "c": 20, "d": 700}, {"a": 10, None: 10}, {"x": 5}, {"a": 1000, "b": 1, "c": 1, "d": 1, "e": 2}])
def test_targets_stop_at_three_times_the_source(docs, sizes, spark):
    rows = [(i, " ".join(["w"] * 5), "en", s, None) for s, n in sizes.items() for i in range(n // 5)] + [(0, "w " * (n % 5), "en", s, None) for s, n in sizes.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = mixing.mix(df)
    want = plain_targets(sizes)
    got = {r["source"]: r for r in out.groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("taken"), F.max("size").alias("most")).collect()}
    assert set(got) == set(want)
    for s, r in got.items():
        assert r["t"] == pytest.approx(want[s]) and abs(r["taken"] - want[s]) <= r["most"]
    assert out.filter("taken > 3 * size").count() == 0 and out.count() == len(rows)


def test_positions_follow_the_schedule(spark):
    df = spark.range(0, 1001).select((F.col("id") / 1000).alias("u"))
    for ramp in (0.5, 0.0, -0.5):
        t = mixing.positions(F.col("u") * 50, F.lit(50.0), F.lit(ramp))
        back = df.select("u", ((1 - ramp) * t + ramp * t * t).alias("v"))
        assert back.filter(F.abs(F.col("u") - F.col("v")) > 1e-9).count() == 0


def test_training_order_repeats_and_keeps_columns(docs):
    rows = docs(["one two three"] * 4 + ["a b c d e f g h i j"] * 4, sources=("s",)).withColumnRenamed("lang", "seat")
    rows = rows.withColumn("source", F.when(F.col("doc_id") < 4, "p").otherwise("q"))
    out = mixing.training_order(rows)
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(rows).collect()}
    assert out.columns == rows.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({d: n for d, n in plan.items() if n})


def test_edges(docs, empty):
    assert mixing.mix(empty).count() == 0 and mixing.training_order(empty).columns == empty.columns
    out = mixing.mix(docs([None, "", "a b", "a b"], sources=(None, "x"), ids=[None, 1, 1, 1])).collect()
    assert sorted((r["size"], r["taken"]) for r in out)[:2] == [(0, 0), (0, 0)] and len(out) == 4
    same = docs(["a b c"] * 6, sources=("x",), ids=[1] * 6)
    assert mixing.training_order(same).count() == 6


def test_a_third_of_the_ids_missing_leaves_no_crowded_slice(docs, spark):
    texts = [f"text {i} " + "w " * (i % 9) for i in range(2000)] + ["always the same"] * 1000
    rows = docs(texts, sources=("s",), ids=[None if i % 3 else i for i in range(2000)] + [None] * 1000)
    first = sorted(map(tuple, mixing.mix(rows).select("doc_id", "size", "taken", "begins").collect()), key=repr)
    again = sorted(map(tuple, mixing.mix(rows.repartition(7)).select("doc_id", "size", "taken", "begins").collect()), key=repr)
    assert first == again and len(first) == 3000
    ends = sorted((r[3], r[3] + r[1]) for r in first)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))  # rows follow each other without gap or overlap


def test_equal_rows_are_cut_into_groups_at_places_of_their_own(docs, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 10)
    out = mixing.mix(docs(["one two"] * 95 + [f"x y {i}" for i in range(95)], sources=("s",), ids=[None] * 190))
    begins = sorted(r["begins"] for r in out.filter("size = 2").collect())
    runs = 1 + sum(b - a != 2 for a, b in zip(begins, begins[1:]))
    assert len(begins) == 95 and runs > 4


def test_map_columns_take_part_in_the_training_order(docs):
    rows = docs(["a b", "c d", "a b"], ids=[1, 2, 1]).withColumns({"m": F.create_map(F.lit("k"), F.col("text")), "deep": F.array(F.create_map(F.lit(1), F.lit(2)))})
    out = mixing.training_order(rows)
    assert out.columns == rows.columns and {r["m"]["k"] for r in out.collect()} <= {"a b", "c d"} and out.count() >= 3
