"""Approximate nearest neighbours by random projections, for vectors without structure.

Each of ``tables`` trees halves the training rows ``depth`` times: level j of a tree projects on one
random direction and cuts every node at the middle of its projections, so leaves are of like size
and hold about ``leaf_rows`` rows. A query visits its ``probes`` leaves per tree of least distance
to the cuts it crosses. So every training row is sent ``tables`` times and every query
``tables * probes`` times, however large the table, where the exact search must send each query to
nearly all cells once they cannot be pruned.

The cuts are fitted on a sample of at most ``SAMPLE_VALUES`` numbers; every row is indexed. A leaf
that outgrows ``BLOCK_ROWS`` (cuts stop at ``MAX_LEAVES`` leaves a tree, and at eight sampled rows a
leaf) is cut into blocks that all meet, so nothing in a visited leaf is left out.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venueflow.operators.knn import BLOCK_ROWS, _matrix, _meet, _ranked, _thin_copies
from venueflow.session import materialize

# The functions below travel with the tasks, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_VALUES = 8_000_000  # numbers in the sample that fits the cuts, 64 MB
SAMPLE_PER_LEAF = 8
MAX_LEAVES = 16_384  # a tree; bounds the cuts sent to tasks and the table of leaf sizes
LEAF_ROWS = 512
TABLES = 6
PROBES = 8
SEED = 11


def fit_cuts(sample: np.ndarray, depth: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Directions (depth, dims) and cuts (2 ** depth, heap order from 1) of one tree.

    A cut is the middle of the sampled projections of a node; a node without any cuts at infinity,
    so its rows stay together.
    """
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(depth, sample.shape[1]))
    directions /= np.maximum(np.linalg.norm(directions, axis=1, keepdims=True), 1e-300)
    cuts = np.full(2**depth, np.inf)
    node = np.ones(len(sample), dtype=np.int64)
    for j in range(depth):
        value = sample @ directions[j]
        order = np.lexsort((value, node))
        held, first, n = np.unique(node[order], return_index=True, return_counts=True)
        ranked = value[order]
        cuts[held] = (ranked[first + (n - 1) // 2] + ranked[first + n // 2]) / 2
        node = 2 * node + (value > cuts[node])
    return directions, cuts


def leaves(x: np.ndarray, tree: tuple[np.ndarray, np.ndarray], probes: int = 1) -> np.ndarray:
    """Per row the ``probes`` leaves of least squared distance to the cuts crossed, own leaf first; -1 pads."""
    directions, cuts = tree
    rows = np.arange(len(x))[:, None]
    node = np.ones((len(x), 1), dtype=np.int64)
    cost = np.zeros((len(x), 1))
    for a in directions:
        gap = (x @ a)[:, None] - cuts[node]
        side = gap > 0
        # Beyond a cut at infinity nothing lies, and the cost there is infinite too.
        node = np.hstack((2 * node + side, 2 * node + ~side))
        cost = np.hstack((cost, cost + gap * gap))
        if node.shape[1] > probes:
            best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
            node, cost = node[rows, best], cost[rows, best]
    return np.where(np.isfinite(cost), node - 2 ** len(directions), -1)


def _sample(train: DataFrame, train_id: str, vector: str, rows: int) -> np.ndarray:
    dims = len(train.select(vector).first()[0])
    want = max(1, SAMPLE_VALUES // max(1, dims))
    # Twice the wanted share by hash first, so only that much is ranked.
    share = max(1, rows // (2 * want))
    some = train.filter(F.pmod(F.xxhash64(train_id), F.lit(share)) == 0).orderBy(F.xxhash64(train_id, F.lit(SEED)), train_id)
    return _matrix(some.select(vector).limit(want).toArrow().column(0))


def _with_leaves(df: DataFrame, vector: str, trees: list, probes: int) -> DataFrame:
    """One row per visited leaf, numbered through all trees in ``_cell``."""
    schema = T.StructType([*df.schema.fields, T.StructField("_cells", T.ArrayType(T.IntegerType()))])
    names = schema.fieldNames()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            x = _matrix(b.column(vector))
            found = [(leaves(x, t, probes), i * len(t[1])) for i, t in enumerate(trees)]
            cells = np.hstack([np.where(leaf >= 0, leaf + at, -1) for leaf, at in found])
            lists = pa.array([c[c >= 0] for c in cells], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=names)

    return df.mapInArrow(assign, schema).withColumn("_cell", F.explode("_cells")).drop("_cells")


def nearest_approximate(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    query_id: str = "query_id",
    train_id: str = "train_id",
    vector: str = "vec",
    payload: str = "label",
    fold: str | None = None,
    tables: int = TABLES,
    probes: int = PROBES,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """Like ``knn.nearest``, but only among the training rows of the leaves visited.

    Distances and their order are exact; a query whose leaves hold fewer than k rows gets fewer.
    More ``tables``, ``probes`` or ``leaf_rows`` raise the recall and the work. ``train_id`` and
    ``query_id`` must be unique, and vectors of one length.
    """
    by_fold = [fold] if fold else []
    train = train.select(train_id, vector, payload, *by_fold)
    queries = queries.select(query_id, vector, *by_fold)
    kept = materialize(_thin_copies(train, k, train_id, vector, fold), "points")
    rows = kept.count()
    if rows == 0:
        raise ValueError("no training rows")
    sample = _sample(kept, train_id, vector, rows)
    wanted = min(MAX_LEAVES, rows // leaf_rows, len(sample) // SAMPLE_PER_LEAF)
    depth = max(0, int(np.floor(np.log2(max(1, wanted)))))
    trees = [fit_cuts(sample, depth, SEED + i) for i in range(tables if depth else 1)]
    left = materialize(_with_leaves(kept, vector, trees, 1), "leaves")
    right = materialize(_with_leaves(queries, vector, trees, probes), "visits")

    def blocks(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias(name))

    # At most tables * MAX_LEAVES rows; a leaf without rows or without queries needs no task.
    sizes = F.broadcast(materialize(blocks(left, "_tn").join(blocks(right, "_qn"), "_cell"), "leaf-blocks"))
    found = _meet(left.join(sizes, "_cell"), right.join(sizes, "_cell"), k, query_id, train_id, vector, payload, fold)
    # A pair may meet in several trees; its distance is the same in all.
    once = found.groupBy(query_id, train_id).agg(F.min("_sq").alias("_sq"), F.first(payload).alias(payload))
    return _ranked(once, k, query_id, train_id, payload)


def recall(found: DataFrame, exact: DataFrame, query_id: str = "query_id", train_id: str = "train_id") -> DataFrame:
    """One row: n_exact pairs, n_found of them, and their share."""
    hits = exact.select(query_id, train_id).join(found.select(query_id, train_id, F.lit(1).alias("_hit")), [query_id, train_id], "left")
    counted = hits.agg(F.count(F.lit(1)).alias("n_exact"), F.count("_hit").alias("n_found"))
    return counted.withColumn("recall", F.try_divide("n_found", "n_exact"))
