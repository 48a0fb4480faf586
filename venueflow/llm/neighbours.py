"""Approximate nearest neighbours by inner product: NN-descent graphs and greedy graph search.

Distinct vectors are dealt to the nearest of some pivots, about one pivot to ``SHARD_ROWS`` of them; a
cell that holds more is cut by hash, so a shard stays small enough for a task. In each shard a
neighbour graph grows from random links: Spark joins every node's neighbours (both ways) with their
neighbours, and the task that holds the shard's vectors keeps the K nearest of what it was offered.
Rounds end after ``ROUNDS``, or when few links still change. A query visits the cells where it expects
the largest products, best first, until they hold ``VISIT_ROWS`` vectors, so its work does not grow
with the table; a table of at most that many is visited whole. In a shard it walks the graph greedily,
keeping a beam of the best nodes found and expanding the best not yet expanded. It starts from its own
node, where the shard has it, and from a set of nodes that every node is in or linked to, so no
cluster is out of reach. The queries of a shard are dealt by hash into blocks of about ``QUERY_ROWS``,
and a task holds one shard and one block. The best cell of a query is searched first; the others then
answer only with what is no worse than the k + 1 ids found there, so answers do not grow with the cells
visited. The shards' answers are merged by score.

Only the pivots come from a sample, of at most about ``SAMPLE_VALUES`` numbers taken by hash on the
driver; every row is indexed. The sample bounds the pivots to ``SAMPLE_VALUES / SAMPLE_PER_CELL``
numbers (16 MB), which at 64 dimensions is 31,250 cells or 128 million vectors; in larger tables a cell
has more shards, all of which are visited with it.

Equal vectors are indexed once; a query's answer lists their ids again, smallest first. No answer
needs more than k + 1 ids of one vector, and the rank filter that keeps these runs before the
shuffle, so a hot vector stays harmless. A search goes on until it names k + 1 different ids: where
the beam holds fewer, since few ids have many vectors, the query is compared with the whole shard.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
nor do vectors of another length than most; rows without an id take no part; repeated rows count
once; an id with several vectors has one answer and is listed once in others', and two ids are as near
as the nearest of their vectors; no id is its own neighbour; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from venueflow.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD_ROWS = 4096
QUERY_ROWS = 4096  # queries that meet a shard in one task
VISIT_ROWS = 262_144  # vectors in the cells that a query visits
SAMPLE_VALUES = 16_000_000  # numbers in the sample that fits the pivots
SAMPLE_PER_CELL = 8
PIVOT_ROUNDS = 4
REACH = 2.5  # how many deviations beyond its pivot a cell is expected to reach
SEED = 17
PIVOT_BLOCK = 512
K = 16  # links of a node
ROUNDS = 8
STILL = 0.02  # share of links that may still change when the rounds end
BEAM = 96
EXPAND = 4  # nodes expanded at a time
QUERY_BLOCK = 128
NODE_BLOCK = 256
WHOLE_IDS = 1_000_000  # ids ranked at a time where queries are compared with a whole shard


def usable(vector) -> F.Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _gaps(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances less the rows' own squared lengths; what overflows counts as far."""
    return np.nan_to_num((pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T), nan=np.inf, posinf=np.inf, neginf=-np.inf)


def _nearest_pivot(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    parts = [_gaps(x[i : i + PIVOT_BLOCK], pivots).argmin(axis=1) for i in range(0, len(x), PIVOT_BLOCK)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def _centres(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` pivots of the rows: some of them at first, then means of the rows nearest to each."""
    pivots = x[np.random.default_rng(SEED).permutation(len(x))[:n]].copy()
    for _ in range(PIVOT_ROUNDS if len(pivots) > 1 else 0):
        at = _nearest_pivot(x, pivots)
        held = np.bincount(at, minlength=len(pivots))
        sums = np.zeros_like(pivots)
        np.add.at(sums, at, x)
        pivots[held > 0] = sums[held > 0] / held[held > 0, None]
    return pivots


class Pivots:
    """Pivots of two levels, fitted on sampled rows; a cell belongs to a pivot of the second level."""

    def __init__(self, sample: np.ndarray, cells: int):
        cells = max(1, min(cells, len(sample) // SAMPLE_PER_CELL))
        self.scale = float(np.abs(sample).max()) if cells > 1 else 1.0
        x = sample / self.scale
        self.top = _centres(x, math.ceil(math.sqrt(cells))) if cells > 1 else np.zeros((1, sample.shape[1]))
        at = _nearest_pivot(x, self.top)
        each = np.maximum(1, np.round(cells * np.bincount(at, minlength=len(self.top)) / max(1, len(x)))).astype(int) if cells > 1 else [1]
        below = [_centres(x[at == i], n) if (at == i).any() else self.top[i : i + 1] for i, n in enumerate(each)]
        self.first = np.cumsum([0, *[len(b) for b in below]])
        self.pivots = np.concatenate(below)
        self.spread = np.zeros(len(self.pivots))
        if cells > 1:
            cell = self.cells(sample)
            gap = ((x - self.pivots[cell]) ** 2).mean(axis=1)
            held = np.bincount(cell, minlength=len(self.pivots))
            self.spread = np.sqrt(np.bincount(cell, gap, len(self.pivots)) / np.maximum(held, 1))

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        if len(self.pivots) == 1:
            return np.zeros(len(x), dtype=np.int64)
        with np.errstate(all="ignore"):
            x = x / self.scale
            out = _nearest_pivot(x, self.top)
            for i in np.unique(out):
                rows = np.flatnonzero(out == i)
                out[rows] = -1 - self.first[i] - _nearest_pivot(x[rows], self.pivots[self.first[i] : self.first[i + 1]])
        return -1 - out

    def visits(self, q: np.ndarray, held: np.ndarray, most: int) -> list[np.ndarray]:
        """Per query the cells of largest expected products, until they hold ``most`` rows; empty cells are left out."""
        some = np.flatnonzero(held)
        if len(some) == 1:
            return [some] * len(q)
        out = []
        for i in range(0, len(q), PIVOT_BLOCK):
            block = q[i : i + PIVOT_BLOCK].astype(np.float64)
            with np.errstate(all="ignore"):
                block = block / np.abs(block).max(axis=1, keepdims=True)
                length = np.sqrt((block * block).sum(axis=1, keepdims=True))
                order = np.argsort(-(block @ self.pivots[some].T + REACH * length * self.spread[some]), axis=1, kind="stable")
            before = np.cumsum(held[some][order], axis=1) - held[some][order]
            out += [some[o[b < most]] for o, b in zip(order, before)]
        return out


def fit_pivots(nodes: DataFrame, rows: int) -> Pivots:
    """Pivots of ``nodes(vector)``; the sample is the rows of least hash, in expectation ``SAMPLE_VALUES`` numbers at most."""
    if rows <= SHARD_ROWS:
        return Pivots(np.zeros((0, 1)), 1)
    want = max(1, SAMPLE_VALUES // len(nodes.first()["vector"]))
    key = F.xxhash64("vector", F.lit(SEED))
    some = nodes.filter(F.pmod(key, F.lit(math.ceil(rows / want))) == 0).select("vector", key.alias("key")).limit(2 * want).toArrow()
    return Pivots(_matrix(some.sort_by("key").column("vector")).astype(np.float64), math.ceil(rows / SHARD_ROWS))


def _with_cells(nodes: DataFrame, pivots: Pivots) -> DataFrame:
    def run(batches):
        for b in batches:
            cell = pivots.cells(_matrix(b.column("vector")).astype(np.float64)) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32())], names=[*b.schema.names, "cell"])

    kind = nodes.schema["vector"].dataType.simpleString()
    return nodes.select("node", "vector").mapInArrow(run, f"node long, vector {kind}, cell int")


def _with_visits(queries: DataFrame, pivots: Pivots, held: np.ndarray, most: int) -> DataFrame:
    """One row per query and visited cell, numbered from 0 in ``nth``."""

    def run(batches):
        for b in batches:
            cells = pivots.visits(_matrix(b.column("vector")), held, most) if b.num_rows else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*b.schema.names, "cells"])

    kind = queries.schema["vector"].dataType.simpleString()
    found = queries.select("query", "vector").mapInArrow(run, f"query long, vector {kind}, cells array<int>")
    return found.select("query", "vector", F.posexplode("cells").alias("nth", "cell"))


def random_links(n: int, seed: int) -> np.ndarray:
    """Up to K distinct other nodes for each of n nodes; -1 pads when there are fewer."""
    out = np.full((n, K), -1, dtype=np.int32)
    if n > 1:
        steps = np.random.default_rng(seed).permutation(np.arange(1, n))[:K]
        out[:, : len(steps)] = (np.arange(n)[:, None] + steps) % n
    return out


def _start(group: pa.Table) -> pa.Table:
    group = group.sort_by("node")
    links = random_links(group.num_rows, int(group.column("shard")[0].as_py()))
    return _graph(group, links, np.full(group.num_rows, K))


def _graph(group: pa.Table, links: np.ndarray, changed: np.ndarray) -> pa.Table:
    rows = pa.array([[x for x in r if x >= 0] for r in links.tolist()], pa.list_(pa.int32()))
    return pa.table({"shard": group.column("shard"), "at": pa.array(np.arange(group.num_rows), pa.int32()), "node": group.column("node"),
                     "vector": group.column("vector"), "links": rows, "changed": pa.array(changed, pa.int32())})


GRAPH = "shard long, at int, node long, vector array<{}>, links array<int>, changed int"


def _improve(nodes: pa.Table, offers: pa.Table) -> pa.Table:
    """One round in a shard: each node keeps the K nearest of its links and the offered nodes."""
    nodes = nodes.sort_by("at")
    x = _matrix(nodes.column("vector"))
    n = len(x)
    old = np.full((n, K), -1, dtype=np.int32)
    for i, r in enumerate(nodes.column("links").to_pylist()):
        old[i, : len(r)] = r
    lists = offers.column("offered").combine_chunks()
    who = np.repeat(offers.column("to").to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False))
    what = lists.flatten().to_numpy()
    pair = np.unique(np.concatenate((who.astype(np.int64) * n + what, (np.arange(n)[:, None] * n + old)[old >= 0])))
    who, what = pair // n, pair % n
    who, what = who[who != what], what[who != what]
    score = np.concatenate([np.einsum("ij,ij->i", x[who[i : i + 100_000]], x[what[i : i + 100_000]]) for i in range(0, len(who), 100_000)] or [np.zeros(0)])
    order = np.lexsort((what, -score, who))
    who, what = who[order], what[order]
    rank = np.arange(len(who)) - np.searchsorted(who, who)
    links = np.full((n, K), -1, dtype=np.int32)
    kept = rank < K
    links[who[kept], rank[kept]] = what[kept]
    same = (links[:, :, None] == old[:, None, :]) & (links[:, :, None] >= 0)
    return _graph(nodes, links, (links >= 0).sum(axis=1) - same.any(axis=2).sum(axis=1))


def build_graph(nodes: DataFrame) -> DataFrame:
    """GRAPH rows of ``nodes(shard, node, vector)``."""
    schema = GRAPH.format(nodes.schema["vector"].dataType.elementType.simpleString())
    graph = materialize(nodes.groupBy("shard").applyInArrow(_start, schema), "ann-graph-0")
    total = graph.count()
    for i in range(ROUNDS):
        out = graph.select("shard", "at", F.explode("links").alias("via"))
        both = out.union(out.select("shard", F.col("via").alias("at"), F.col("at").alias("via")))
        near = graph.select("shard", F.col("at").alias("via"), F.col("links").alias("offered"))
        offers = both.join(near, ["shard", "via"]).select(F.col("shard").alias("to_shard"), F.col("at").alias("to"), "offered")
        graph = materialize(graph.groupBy("shard").cogroup(offers.groupBy("to_shard")).applyInArrow(_improve, schema), f"ann-graph-{i + 1}")
        if graph.agg(F.coalesce(F.sum("changed"), F.lit(0))).first()[0] <= STILL * K * total:
            break
    return graph


def neighbour_table(links: np.ndarray) -> np.ndarray:
    """Links of both directions, one row per node, padded with -1."""
    n = len(links)
    a = np.repeat(np.arange(n), links.shape[1])[links.ravel() >= 0]
    b = links.ravel()[links.ravel() >= 0]
    pair = np.unique(np.concatenate((a.astype(np.int64) * n + b, b.astype(np.int64) * n + a)))
    a, b = pair // n, pair % n
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    out = np.full((n, int(rank.max()) + 1 if len(rank) else 1), -1, dtype=np.int32)
    out[a, rank] = b
    return out


def spanning_starts(table: np.ndarray) -> np.ndarray:
    """Nodes such that every node is one of them or linked to one; so every component holds some."""
    covered = np.zeros(len(table), dtype=bool)
    starts = []
    for i, row in enumerate(table):
        if not covered[i]:
            starts.append(i)
            covered[i] = True
            covered[row[row >= 0]] = True
    return np.array(starts, dtype=np.int64)


def greedy(x: np.ndarray, table: np.ndarray, q: np.ndarray, beam: int, starts: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Nodes in each query's final beam, best first, padded with -1. All queries of the block step together.

    ``own`` is each query's own node, -1 where there is none.
    """
    n, m = len(x), len(q)
    rows = np.arange(m)[:, None]
    seen = np.zeros((m, n), dtype=bool)
    seen[:, starts] = True
    extra = (own >= 0) & ~seen[np.arange(m), np.maximum(own, 0)]
    seen[extra, own[extra]] = True
    ids = np.hstack((np.broadcast_to(starts, (m, len(starts))), np.where(extra, own, -1)[:, None], np.full((m, beam), -1)))
    score = np.full(ids.shape, -np.inf, dtype=x.dtype)
    score[:, : len(starts)] = q @ x[starts].T
    score[extra, len(starts)] = np.einsum("ij,ij->i", q[extra], x[own[extra]])
    order = np.argsort(-score, axis=1, kind="stable")[:, :beam]
    ids, score = ids[rows, order], score[rows, order]
    done = ids < 0
    while True:
        open_score = np.where(done, -np.inf, score)
        pick = np.argpartition(-open_score, min(EXPAND, beam) - 1, axis=1)[:, :EXPAND]
        chosen = np.take_along_axis(open_score, pick, axis=1) > -np.inf
        live = chosen.any(axis=1)
        if not live.any():
            break
        np.put_along_axis(done, pick, True, axis=1)
        found = table[np.where(chosen, np.take_along_axis(ids, pick, axis=1), 0)]
        found = np.where(chosen[:, :, None], found, -1).reshape(m, -1)
        r, c = np.nonzero(found >= 0)
        pair = np.unique(r * n + found[r, c])
        r, c = pair // n, pair % n
        fresh = ~seen[r, c]
        r, c = r[fresh], c[fresh]
        seen[r, c] = True
        s = np.einsum("ij,ij->i", q[r], x[c])
        better = s > score[r, -1]
        r, c, s = r[better], c[better], s[better]
        most = int(np.bincount(r, minlength=m).max()) if len(r) else 0
        if most:
            place = np.arange(len(r)) - np.searchsorted(r, r)
            new_ids, new_score = np.full((m, most), -1, dtype=np.int64), np.full((m, most), -np.inf, dtype=x.dtype)
            new_ids[r, place], new_score[r, place] = c, s
            ids, score = np.hstack((ids, new_ids)), np.hstack((score, new_score))
            done = np.hstack((done, new_ids < 0))
        order = np.argsort(-score, axis=1, kind="stable")[:, :beam]
        ids, score, done = ids[rows, order], score[rows, order], done[rows, order]
    return ids


def _best_ids(score: np.ndarray, nodes: np.ndarray, ids: np.ndarray, first: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score): the ``most`` best different ids of each row's ``nodes`` (-1 pads); ties go to the smaller id."""
    r, c = np.nonzero(nodes >= 0)
    at, s = nodes[r, c], score[r, c]
    n = count[at]
    offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    r, s, named = np.repeat(r, n), np.repeat(s, n), ids[np.repeat(first[at], n) + offset]
    order = np.lexsort((-s, named, r))
    r, s, named = r[order], s[order], named[order]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (named[1:] != named[:-1])
    r, s, named = r[new], s[new], named[new]
    order = np.lexsort((named, -s, r))
    r, s, named = r[order], s[order], named[order]
    kept = np.arange(len(r)) - np.searchsorted(r, r) < most
    return r[kept], named[kept], s[kept]


def _search(k: int):
    def run(graph: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not graph.num_rows or not queries.num_rows:
            return empty
        graph = graph.sort_by("at")
        x, node = _matrix(graph.column("vector")), graph.column("node").to_numpy()
        links = np.full((len(x), K), -1, dtype=np.int32)
        for i, r in enumerate(graph.column("links").to_pylist()):
            links[i, : len(r)] = r
        table = neighbour_table(links)
        starts = spanning_starts(table)
        lists = graph.column("ids").combine_chunks()
        named, count = lists.flatten().to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False)
        first = np.cumsum(count) - count
        q, who, least = _matrix(queries.column("vector")), queries.column("query").to_numpy(), queries.column("least").to_numpy()
        by_node = np.argsort(node)
        own = by_node[np.minimum(np.searchsorted(node, who, sorter=by_node), len(node) - 1)]
        own = np.where(node[own] == who, own, -1)
        wide = x.astype(np.float64)
        beam = max(BEAM, 2 * k)
        parts = []
        for i in range(0, len(q), QUERY_BLOCK):
            block = q[i : i + QUERY_BLOCK]
            ids = greedy(x, table, block, beam, starts, own[i : i + QUERY_BLOCK])
            exact = np.einsum("ijk,ik->ij", wide[np.maximum(ids, 0)], block.astype(np.float64))
            r, v, s = _best_ids(exact, ids, named, first, count, k + 1)
            few = np.bincount(r, minlength=len(block)) <= k
            if few.any() and len(x) > beam:
                parts.append((i + r[~few[r]], v[~few[r]], s[~few[r]]))
                few = np.flatnonzero(few)
                step = max(1, WHOLE_IDS // len(named))
                for some in (few[j : j + step] for j in range(0, len(few), step)):
                    exact = np.einsum("jk,ik->ij", wide, block[some].astype(np.float64))
                    r, v, s = _best_ids(exact, np.broadcast_to(np.arange(len(x)), exact.shape), named, first, count, k + 1)
                    parts.append((i + some[r], v, s))
                continue
            parts.append((i + r, v, s))
        a, b, s = (np.concatenate(p) for p in zip(*parts))
        kept = s >= least[a]
        return pa.table({"query": who[a[kept]], "vec_id": b[kept], "score": s[kept]})

    return run


def nearest(vectors: DataFrame, k: int = 20, every: int = 20, vec_id: str = "vec_id", vector: str = "embedding", visit_rows: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by ``every``.

    Nearness is the largest inner product, in double precision; ties go to the smaller id. ``visit_rows``
    (``VISIT_ROWS`` by default) is how many vectors the cells visited by a query hold: more raise recall and work.
    """
    # Floats stay floats; all other numbers are searched and scored as doubles.
    kind = "float" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[vector].cast(f"array<{kind}>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    size = rows.agg(F.mode(F.size("vector"), True)).first()[0]
    rows = rows.filter(F.size("vector") == F.lit(size if size is not None else 0)).distinct()
    same = Window.partitionBy("vector").orderBy("vec_id")
    copies = rows.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1)
    # A vector's number is that of one of its rows: ids do not tell vectors apart, as one id may have several.
    copies = copies.withColumn("row", F.monotonically_increasing_id()).withColumn("node", F.min("row").over(Window.partitionBy("vector")))
    copies = materialize(copies.drop("row"), "ann-copies")
    nodes = copies.filter("nth = 1").select("node", "vector")
    pivots = fit_pivots(nodes, nodes.count())
    placed = materialize(_with_cells(nodes, pivots), "ann-cells")
    # One row per pivot at most.
    held = np.zeros(len(pivots.pivots), dtype=np.int64)
    for r in placed.groupBy("cell").count().collect():
        held[r["cell"]] = r["count"]
    cuts = np.ceil(held / SHARD_ROWS).astype(np.int64)
    shards = [(i, int(end - n), int(n)) for i, (end, n) in enumerate(zip(np.cumsum(cuts), cuts)) if n]
    cells = F.broadcast(vectors.sparkSession.createDataFrame(shards, "cell int, base long, cuts long"))
    shard = F.col("base") + F.pmod(F.xxhash64("vector"), F.col("cuts"))
    graph = build_graph(placed.join(cells, "cell").select(shard.alias("shard"), "node", "vector"))
    # Queries of one vector are searched once, under the node of that vector.
    asked = rows.filter(F.col("vec_id") % every == 0)
    asked = materialize(asked.join(nodes, "vector").select(F.col("node").alias("query"), F.col("vec_id").alias("query_id")), "ann-queries")
    distinct = nodes.join(asked.select(F.col("query").alias("node")).distinct(), "node", "left_semi").select(F.col("node").alias("query"), "vector")
    distinct = materialize(distinct, "ann-distinct")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    visited = _with_visits(distinct, pivots, held, visit_rows or VISIT_ROWS).join(cells, "cell")
    visited = visited.select("nth", "base", each(F.col("cuts")).alias("cut"), "query", "vector")
    visited = materialize(visited.select("nth", (F.col("base") + F.col("cut")).alias("to_shard"), "query", "vector"), "ann-visits")
    ids = copies.groupBy(F.col("node").alias("of")).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    named = materialize(graph.join(ids, graph["node"] == ids["of"]).select(*[graph[c] for c in graph.columns], "ids"), "ann-named")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        """The k + 1 best ids of a query, since the id that asks may be among them."""
        listed = found.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
        return listed.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1).drop("place")

    def meet(asking: DataFrame) -> DataFrame:
        """A shard and the queries that visit it meet in blocks; neither side of a task grows with the table."""
        blocks = materialize(asking.groupBy("to_shard").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("blocks")), "ann-blocks")
        sent = asking.join(blocks, "to_shard").withColumn("to_block", F.pmod(F.xxhash64("query"), F.col("blocks"))).drop("blocks")
        dealt = named.join(blocks, F.col("shard") == F.col("to_shard")).select(each(F.col("blocks")).alias("block"), *[named[c] for c in named.columns])
        tasks = dealt.groupBy("shard", "block").cogroup(sent.groupBy("to_shard", "to_block"))
        return tasks.applyInArrow(_search(k), "query long, vec_id long, score double")

    columns = ["to_shard", "query", "vector", "least"]
    nothing = F.lit(float("-inf"))
    first = materialize(ranked(meet(visited.filter("nth = 0").withColumn("least", nothing).select(columns))), "ann-first")
    least = first.groupBy("query").agg(F.when(F.count(F.lit(1)) > k, F.min("score")).otherwise(nothing).alias("least"))
    rest = visited.filter("nth > 0").join(least, "query", "left").withColumn("least", F.coalesce("least", nothing))
    listed = ranked(first.unionByName(meet(rest.select(columns))))
    answers = asked.join(listed.select("query", "vec_id", "score"), "query").filter("vec_id <> query_id")
    answers = answers.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    answers = answers.withColumn("rank", F.row_number().over(final).cast("int")).filter(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")
