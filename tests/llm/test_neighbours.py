import numpy as np
import pytest

from venueflow.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20, every=20):
    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, x in rows:
        if q % every == 0:
            out.setdefault(q, sorted(((-float(x @ v), i) for i, v in rows if i != q))[:k])
    return out


def test_recall_and_scores_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in df.collect()])
    hits = total = 0
    got = {}
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert set(got) == set(want)
    for q, best in want.items():
        assert len(got[q]) == 20 and got[q] == sorted(got[q])
        hits += sum(s <= best[-1][0] + 1e-12 for s, _ in got[q])
        total += len(best)
    assert hits / total >= 0.95


@pytest.mark.parametrize("shard", [4096, 16])
def test_copies_ties_and_bad_vectors(spark, monkeypatch, shard):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).round(1).tolist(), 0) for i in range(60)] + [(i, [1.0, 0.0, 0.0, 0.0], 0) for i in range(60, 120)]
    bad = [(200, None, 0), (220, [0.0] * 4, 0), (240, [1.0, None, 0.0, 0.0], 0), (260, [float("nan"), 1.0, 1.0, 1.0], 0), (280, [float("inf")] * 4, 0), (300, [1.0], 0), (None, [1.0] * 4, 0)]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows + bad, SCHEMA)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = brute([(i, v) for i, v, _ in rows])
    assert got == {q: [i for _, i in best] for q, best in want.items()}


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (20, [0.0, 1.0], 0)], SCHEMA)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in neighbours.nearest(few).collect()) == [(0, 1, 20, 0.0), (20, 1, 0, 0.0)]
    assert neighbours.nearest(spark.createDataFrame([(0, [1.0], 0)], SCHEMA)).count() == 0
    assert neighbours.nearest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_on_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(100, 64))[rng.integers(0, 100, 4000)] + 0.1 * rng.normal(size=(4000, 64))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, SCHEMA), every=40).collect():
        got.setdefault(r["query_id"], []).append(r["score"])
    score = x[::40].astype(float) @ x.astype(float).T
    score[np.arange(100), np.arange(0, 4000, 40)] = -np.inf
    lowest = np.sort(score, axis=1)[:, -20]
    hits = sum(s >= lowest[q // 40] - 1e-9 for q, found in got.items() for s in found)
    assert all(len(found) == 20 for found in got.values()) and hits / 2000 >= 0.9


def test_tasks_hold_bounded_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 64)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 16, raising=False)
    search = neighbours._search

    def bounded(k):
        run = search(k)

        def checked(graph, queries):
            assert queries.num_rows <= 64  # blocks are dealt by hash, 16 rows each on average
            return run(graph, queries)

        return checked

    monkeypatch.setattr(neighbours, "_search", bounded)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(200)]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA), every=1).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == {q: [i for _, i in best] for q, best in brute(rows, every=1).items()}


def test_repeated_ids_are_listed_once(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    # The table twice; id 20 on two vectors, one of them also id 40's, both with 20 as their smallest id; id 7 on many vectors that lie nearest to id 0.
    near = (10 * np.array(rows[0][1]) + rng.normal(scale=0.01, size=(150, 4))).tolist()
    rows = 2 * rows + [(20, rows[40][1])] + [(7, v) for v in near] + [(0, v) for v in near[:40]]
    best = {}
    for q, x in rows:
        for i, v in rows:
            if q % 20 == 0 and i != q:
                score = float(np.array(x, dtype=np.float32).astype(float) @ np.array(v, dtype=np.float32).astype(float))
                best[q, i] = max(score, best.get((q, i), -np.inf))
    want = {q: sorted((-s, i) for (p, i), s in best.items() if p == q)[:20] for q in (0, 20, 40)}
    got = {}
    for r in neighbours.nearest(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert {q: [i for _, i in found] for q, found in got.items()} == {q: [i for _, i in found] for q, found in want.items()}
    assert all(np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]]) for q in want)


@pytest.mark.parametrize("shard", [4096, 16])
def test_doubles_keep_their_digits_and_range(spark, monkeypatch, shard):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard)
    rows = [(0, [1.0, 0.0])] + [(i, [1 + i * 1e-12, 0.0]) for i in range(1, 50)] + [(50, [1e200, 0.0]), (51, [1e-200, 1.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("query_id = 0").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [50, *range(49, 30, -1)]
    assert [r["score"] for r in got] == [1e200] + [1 + i * 1e-12 for i in range(49, 30, -1)]


def test_recall_on_clusters_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 1000)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 64)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 32))[rng.integers(0, 60, 5000)] * rng.uniform(0.5, 2, size=(5000, 1)) + 0.1 * rng.normal(size=(5000, 32))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    x = x.astype(np.float32).astype(float)
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in got:
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score, kind="stable")[:20].tolist()))
    assert len(got) == 250 and hits / (20 * len(got)) >= 0.9


def _recall(spark, x, monkeypatch, shard, visit_rows):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", shard)
    sent = []
    with_visits = neighbours._with_visits
    monkeypatch.setattr(neighbours, "_with_visits", lambda q, p, held, most: sent.append((held, with_visits(q, p, held, most))) or sent[-1][1])
    got = {}
    found = neighbours.nearest(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA), visit_rows=visit_rows)
    for r in found.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    held, visits = sent[0]
    rows = {}
    for r in visits.select("query", "cell").collect():
        rows[r["query"]] = rows.get(r["query"], 0) + int(held[r["cell"]])
    hits = 0
    x = x.astype(np.float32).astype(float)
    for q in got:
        score = x @ x[q]
        score[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-score, kind="stable")[:20].tolist()))
    assert len(got) == len(x) // 20 and held.sum() == len(x)
    return hits / (20 * len(got)), max(rows.values()) - held.max()


def test_recall_where_clusters_are_visited_in_part(spark, monkeypatch):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(80, 32))[rng.integers(0, 80, 8000)] + 0.3 * rng.normal(size=(8000, 32))
    recall, most = _recall(spark, x, monkeypatch, 250, 1000)
    assert recall >= 0.9 and most < 1000


def test_recall_where_vectors_without_structure_are_visited_in_part(spark, monkeypatch):
    rng = np.random.default_rng(13)
    x = rng.normal(size=(8000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    recall, most = _recall(spark, x, monkeypatch, 250, 3000)
    assert recall >= 0.9 and most < 3000


def test_a_crowd_is_cut_into_shards_that_are_all_visited(spark, monkeypatch):
    rng = np.random.default_rng(14)
    x = np.concatenate((1 + 1e-4 * rng.normal(size=(1200, 8)), rng.normal(size=(800, 8))))
    monkeypatch.setattr(neighbours, "SAMPLE_PER_CELL", 500)
    recall, most = _recall(spark, x, monkeypatch, 100, 1200)
    assert recall >= 0.9 and most < 1200


def test_pivots_whatever_the_numbers():
    x = np.concatenate((np.full((40, 3), 1e300), np.full((40, 3), -1e-300), np.zeros((1, 3))))
    pivots = neighbours.Pivots(x, 8)
    cells = pivots.cells(x)
    assert cells.min() >= 0 and cells.max() < len(pivots.pivots) and len(np.unique(cells)) >= 2
    held = np.bincount(cells, minlength=len(pivots.pivots))
    assert all(held[v].sum() == 81 for v in pivots.visits(x[:41], held, 1000))
