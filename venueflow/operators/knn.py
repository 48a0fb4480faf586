"""Exact nearest neighbours, their regression and classification, and the one-pass grid search.

Training points are grouped into cells around a bounded set of pivots. The triangle inequality
tells which cells can hold a neighbour of a query, so the rest are never visited; visited cells are
compared in bounded blocks and each block returns only its k best per query.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venueflow.session import materialize

# The functions below travel with the tasks, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 8192  # most rows of either side compared in one group
LEAST_BLOCK = 64  # small tables are cut into a block per task slot, but none below this
QUERY_CHUNK = 256  # queries ranked at a time inside a block
EXACT_CHUNK = 100_000  # candidate pairs measured at a time
MAX_PIVOTS = 256


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def _to_pivots(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((points - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def _thin_copies(train: DataFrame, k: int, train_id: str, vector: str, fold: str | None) -> DataFrame:
    """Of equal vectors only the k smallest ids (per fold) can be among k nearest by (distance, id).

    The rank filter is applied map-side first, so a hot group of copies never travels whole.
    """
    same = Window.partitionBy(vector, *([fold] if fold else [])).orderBy(train_id)
    return train.withColumn("_copy", F.row_number().over(same)).filter(F.col("_copy") <= k).drop("_copy")


def _pick_pivots(train: DataFrame, train_id: str, vector: str, rows: int, block_rows: int, max_pivots: int):
    n = int(min(max_pivots, max(1, -(-rows // block_rows))))
    picked = train.select(vector).orderBy(F.xxhash64(train_id), train_id).limit(n).collect()
    return np.array([r[0] for r in picked], dtype=np.float64)


def _with_cells(train: DataFrame, vector: str, pivots: np.ndarray) -> DataFrame:
    schema = T.StructType([*train.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_radius", T.DoubleType())])
    names = schema.fieldNames()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            d = _to_pivots(_matrix(b.column(vector)), pivots)
            cell = d.argmin(axis=1)
            extra = [pa.array(cell, pa.int32()), pa.array(d[np.arange(len(cell)), cell])]
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=names)

    return train.mapInArrow(assign, schema)


def _cell_summary(cells: DataFrame, n_cells: int, k: int, fold: str | None):
    """Row count and radius range per cell, and the k smallest radii per cell (and fold).

    Sizes are bounded by pivots x folds x k numbers, independent of the data.
    """
    low, high, count = np.full(n_cells, np.inf), np.full(n_cells, -np.inf), np.zeros(n_cells, dtype=np.int64)
    for r in cells.groupBy("_cell").agg(F.count(F.lit(1)), F.min("_radius"), F.max("_radius")).collect():
        count[r[0]], low[r[0]], high[r[0]] = r[1], r[2], r[3]
    by = ["_cell", *([fold] if fold else [])]
    ranked = cells.select(*by, "_radius").withColumn(
        "_r", F.row_number().over(Window.partitionBy(*by).orderBy("_radius"))
    )
    near: dict = {}
    for r in ranked.filter(F.col("_r") <= k).collect():
        near.setdefault(r[fold] if fold else None, {}).setdefault(r["_cell"], []).append(r["_radius"])
    return count, low, high, near


def _nearest_radii(near: dict, n_cells: int, k: int, excluded) -> np.ndarray:
    """Per cell the k smallest radii over all folds but the excluded one, padded with infinity."""
    out = np.full((n_cells, k), np.inf)
    for c in range(n_cells):
        radii = sorted(x for f, cells in near.items() if f != excluded or f is None for x in cells.get(c, []))[:k]
        out[c, : len(radii)] = radii
    return out


def _with_visits(queries: DataFrame, vector: str, fold: str | None, pivots, summary, k: int) -> DataFrame:
    count, low, high, near = summary
    n_cells = len(pivots)
    radii = {f: _nearest_radii(near, n_cells, k, f) for f in (near if fold else [None])}
    all_radii = _nearest_radii(near, n_cells, k, object())
    schema = T.StructType([*queries.schema.fields, T.StructField("_cells", T.ArrayType(T.IntegerType()))])
    names = schema.fieldNames()

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            d = _to_pivots(_matrix(b.column(vector)), pivots)
            folds = b.column(fold).to_pylist() if fold else [None] * b.num_rows
            floor = np.maximum(np.maximum(d - high, low - d), 0.0)
            visits = []
            for i, f in enumerate(folds):
                # The k-th smallest upper bound is at least the distance of the k-th neighbour.
                bounds = (d[i][:, None] + radii.get(f, all_radii)).ravel()
                reach = np.partition(bounds, k - 1)[k - 1] if bounds.size >= k else np.inf
                visits.append(np.flatnonzero((count > 0) & (floor[i] <= reach * (1 + 1e-9) + 1e-12)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(visits, pa.list_(pa.int32()))], names=names)

    return queries.mapInArrow(choose, schema)


def _block_nearest(p: np.ndarray, q: np.ndarray, order: np.ndarray, k: int, folds=None):
    """(query row, point row, squared distance) of the k best points per query within one block.

    A matrix product ranks roughly; every point within its rounding error of the k-th is measured
    again by plain differences, so the result is exact, ties included.
    """
    eps, dims = np.finfo(float).eps, p.shape[1]
    centre = p.mean(axis=0)
    pc, qc = p - centre, q - centre
    p_sq, q_sq = (pc * pc).sum(axis=1), (qc * qc).sum(axis=1)
    reach = np.sqrt(p_sq.max()) + np.sqrt(q_sq)
    largest = max(np.abs(p).max(), np.abs(q).max())
    slack = 8 * eps * ((dims + 4) * reach * reach + np.sqrt(dims) * largest * reach)
    found = []
    for at in range(0, len(q), QUERY_CHUNK):
        rows = slice(at, at + QUERY_CHUNK)
        rough = p_sq[None, :] + q_sq[rows, None] - 2 * qc[rows] @ pc.T
        if folds is not None:
            rough[folds[1][rows, None] == folds[0][None, :]] = np.inf
        edge = np.partition(rough, k - 1, axis=1)[:, k - 1] if len(p) > k else np.full(len(rough), np.inf)
        qi, pi = np.nonzero((rough <= (edge + 2 * slack[rows])[:, None]) & np.isfinite(rough))
        qi += at
        sq = np.empty(len(qi))
        for c in range(0, len(qi), EXACT_CHUNK):
            part = slice(c, c + EXACT_CHUNK)
            sq[part] = ((p[pi[part]] - q[qi[part]]) ** 2).sum(axis=1)
        best = np.lexsort((order[pi], sq, qi))
        qi, pi, sq = qi[best], pi[best], sq[best]
        first = np.searchsorted(qi, qi, side="left")
        keep = np.arange(len(qi)) - first < k
        found.append((qi[keep], pi[keep], sq[keep]))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def nearest(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    query_id: str = "query_id",
    train_id: str = "train_id",
    vector: str = "vec",
    payload: str = "label",
    fold: str | None = None,
    block_rows: int | None = None,
    max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """The k nearest training rows of every query by (Euclidean distance, id), exactly.

    Returns (query_id, rank, train_id, distance, payload). With ``fold``, a query only sees
    training rows of other folds. ``train_id`` and ``query_id`` must be unique. A block holds the
    training rows of one task slot, between LEAST_BLOCK and BLOCK_ROWS, unless ``block_rows`` is given.
    """
    by_fold = [fold] if fold else []
    train = train.select(train_id, vector, payload, *by_fold)
    queries = queries.select(query_id, vector, *by_fold)
    kept = materialize(_thin_copies(train, k, train_id, vector, fold), "points")
    rows = kept.count()
    if rows == 0:
        raise ValueError("no training rows")
    if block_rows is None:
        slots = train.sparkSession.sparkContext.defaultParallelism
        block_rows = min(BLOCK_ROWS, max(LEAST_BLOCK, -(-rows // slots)))
    pivots = _pick_pivots(kept, train_id, vector, rows, block_rows, max_pivots)
    cells = materialize(_with_cells(kept, vector, pivots), "cells")
    summary = _cell_summary(cells, len(pivots), k, fold)
    visits = materialize(_with_visits(queries, vector, fold, pivots, summary, k), "visits")

    # Both sides of a cell are cut into blocks, so a crowded cell is many groups, not one.
    per_cell = {r[0]: r[1] for r in visits.select(F.explode("_cells").alias("c")).groupBy("c").count().collect()}
    n_cells = len(pivots)
    t_blocks = F.lit([max(1, int(-(-c // block_rows))) for c in summary[0]])
    q_blocks = F.lit([max(1, -(-per_cell.get(c, 0) // block_rows)) for c in range(n_cells)])
    t_n, q_n = F.element_at(t_blocks, F.col("_cell") + 1), F.element_at(q_blocks, F.col("_cell") + 1)
    left = cells.drop("_radius").withColumns({"_tn": t_n, "_qn": q_n})
    right = visits.withColumn("_cell", F.explode("_cells")).drop("_cells").withColumns({"_tn": t_n, "_qn": q_n})
    found = _meet(left, right, k, query_id, train_id, vector, payload, fold)
    return _ranked(found, k, query_id, train_id, payload)


def _ranked(found: DataFrame, k: int, query_id: str, train_id: str, payload: str) -> DataFrame:
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy(query_id).orderBy("_sq", train_id)))
    return ranked.filter(F.col("rank") <= k).select(
        query_id, "rank", train_id, F.sqrt("_sq").alias("distance"), payload
    )


def _meet(
    left: DataFrame, right: DataFrame, k: int, query_id: str, train_id: str, vector: str, payload: str, fold: str | None
) -> DataFrame:
    """(query_id, train_id, _sq, payload): the k best of every block of a cell for each query of that cell.

    ``left`` holds training rows and ``right`` queries, one row per ``_cell``, with the number of
    blocks ``_tn`` and ``_qn`` that either side of the cell is cut into.
    """
    left = left.withColumn("_tb", F.pmod(F.xxhash64(train_id), F.col("_tn"))).withColumn(
        "_qb", F.explode(F.sequence(F.lit(0), F.col("_qn") - 1))
    )
    right = right.withColumn("_qb", F.pmod(F.xxhash64(query_id), F.col("_qn"))).withColumn(
        "_tb", F.explode(F.sequence(F.lit(0), F.col("_tn") - 1))
    )
    blocks = {"_tb": F.col("_tb").cast("int"), "_qb": F.col("_qb").cast("int")}
    left, right = left.drop("_tn", "_qn").withColumns(blocks), right.drop("_tn", "_qn").withColumns(blocks)
    fields = [right.schema[query_id], left.schema[train_id], T.StructField("_sq", T.DoubleType()), left.schema[payload]]
    schema = T.StructType(fields)

    def best(points: pa.Table, asked: pa.Table) -> pa.Table:
        if points.num_rows == 0 or asked.num_rows == 0:
            return pa.Table.from_pylist([], schema=pa.schema([
                (query_id, asked.schema.field(query_id).type), (train_id, points.schema.field(train_id).type),
                ("_sq", pa.float64()), (payload, points.schema.field(payload).type)]))
        ids = points.column(train_id).to_numpy()
        order = np.unique(ids, return_inverse=True)[1]
        folds = None
        if fold:
            both = [*points.column(fold).to_pylist(), *asked.column(fold).to_pylist()]
            codes = np.unique(both, return_inverse=True)[1]
            folds = codes[: points.num_rows], codes[points.num_rows :]
        q_at, p_at, sq = _block_nearest(
            _matrix(points.column(vector)), _matrix(asked.column(vector)), order, k, folds
        )
        return pa.table({
            query_id: asked.column(query_id).take(pa.array(q_at)),
            train_id: points.column(train_id).take(pa.array(p_at)),
            "_sq": sq,
            payload: points.column(payload).take(pa.array(p_at)),
        })

    group = ["_cell", "_tb", "_qb"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(best, schema)


def regress(neighbours: DataFrame, query_id: str = "query_id", payload: str = "label", name: str = "prediction") -> DataFrame:
    """Uniform mean of the neighbours' target."""
    return neighbours.groupBy(query_id).agg(F.avg(payload).alias(name))


def _prefix_votes(labels: np.ndarray, distances: np.ndarray, weighting: str) -> np.ndarray:
    """Winning label among the first 1..k neighbours, per row; ties go to the smallest label."""
    if weighting == "uniform":
        w = np.isfinite(distances).astype(float)
    else:
        with np.errstate(divide="ignore"):
            w = np.where(distances[:, :1] == 0, (distances == 0).astype(float), 1.0 / distances)
    same = labels[:, :, None] == labels[:, None, :]
    votes = np.cumsum(same * w[:, :, None], axis=1)
    winner = votes >= votes.max(axis=2, keepdims=True)
    return np.where(winner, labels[:, None, :], np.iinfo(np.int64).max).min(axis=2)


def classify_all_k(
    neighbours: DataFrame,
    k: int,
    query_id: str = "query_id",
    payload: str = "label",
    weightings: tuple[str, ...] = ("uniform", "distance"),
) -> DataFrame:
    """Predictions of every (n_neighbors 1..k, weights) pair from one neighbour table.

    Each query brings at most k neighbours; the result is (query_id, predictions), an array of
    (n_neighbors, weights, prediction). Labels are integers.
    """
    entry = F.struct("rank", F.col(payload).cast("long").alias("l"), F.col("distance").alias("d"))
    lists = neighbours.groupBy(query_id).agg(F.sort_array(F.collect_list(entry)).alias("n"))
    lists = lists.select(query_id, F.col("n.l").alias("_labels"), F.col("n.d").alias("_distances"))
    out = T.ArrayType(T.LongType())
    schema = T.StructType([lists.schema[query_id], *[T.StructField(w, out) for w in weightings]])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            # Rows with fewer than k neighbours are padded; padding never votes (its weight is 0).
            labels = np.full((b.num_rows, k), np.iinfo(np.int64).max, dtype=np.int64)
            distances = np.full((b.num_rows, k), np.inf)
            held = b.column("_labels")
            there = np.arange(k) < held.value_lengths().to_numpy(zero_copy_only=False)[:, None]
            labels[there], distances[there] = held.flatten().to_numpy(), b.column("_distances").flatten().to_numpy()
            columns = [pa.array(list(_prefix_votes(labels, distances, w)), pa.list_(pa.int64())) for w in weightings]
            yield pa.RecordBatch.from_arrays([b.column(query_id), *columns], names=schema.fieldNames())

    voted = lists.mapInArrow(vote, schema)

    def entries(weighting: str):
        return F.transform(
            F.sequence(F.lit(1), F.lit(k)),
            lambda i: F.struct(
                i.alias("n_neighbors"),
                F.lit(weighting).alias("weights"),
                F.element_at(F.col(weighting), i).alias("prediction"),
            ),
        )

    return voted.select(query_id, F.flatten(F.array(*[entries(w) for w in weightings])).alias("predictions"))


def classify(
    neighbours: DataFrame,
    k: int,
    weights: str = "uniform",
    query_id: str = "query_id",
    payload: str = "label",
    name: str = "prediction",
) -> DataFrame:
    """Majority vote of the first k neighbours; ``distance`` weighs by 1/d, exact matches win."""
    voted = classify_all_k(neighbours, k, query_id, payload, (weights,))
    return voted.select(query_id, F.element_at("predictions", k)["prediction"].cast("int").alias(name))


def grid_scores(
    folded: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector: str = "vec",
    label: str = "label",
    fold: str = "fold",
    weightings: tuple[str, ...] = ("uniform", "distance"),
    **options,
) -> DataFrame:
    """Cross-validated hits per (n_neighbors, weights, fold) for the whole grid from one search.

    The k nearest rows of other folds are found once per row; smaller n_neighbors are prefixes.
    Counting hits is a partial aggregation onto params x folds rows.
    """
    queries = folded.select(F.col(id_col).alias("_query"), vector, fold)
    train = folded.select(F.col(id_col).alias("_train"), vector, label, fold)
    found = nearest(queries, train, k, "_query", "_train", vector, label, fold, **options)
    voted = classify_all_k(found, k, "_query", label, weightings)
    truth = folded.select(F.col(id_col).alias("_query"), F.col(label).cast("long").alias("_truth"), fold)
    tried = voted.join(truth, "_query").select(fold, "_truth", F.explode("predictions").alias("p"))
    return tried.groupBy(F.col("p.n_neighbors").alias("n_neighbors"), F.col("p.weights").alias("weights"), fold).agg(
        F.sum((F.col("p.prediction") == F.col("_truth")).cast("long")).alias("n_hits"),
        F.count(F.lit(1)).alias("n_rows"),
    )
