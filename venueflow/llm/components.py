"""Connected components over a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueflow.session import materialize


def components(links: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links(a long, b long)``; root is the smallest node reachable.

    Every round is written to the shared folder, so lineage stays short and a lost executor costs
    one round. Minima are pre-aggregated, joins are left to Spark so that a hot node is split.
    Nulls take no part; loops and repeated links do no harm; no links give an empty table.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label
    )
    before = None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or (state["n"], state["h"]) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        before = (state["n"], state["h"])
        edges = materialize(_small_star(_large_star(edges)), label)
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node it knows."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("m"))
    # Edges are kept with the larger end first: for node v its larger neighbours are the u of (u, v).
    larger = edges.select(F.col("v").alias("centre"), F.col("u").alias("leaf"))
    out = larger.join(least, larger["centre"] == least["u"]).select(F.col("leaf").alias("u"), F.col("m").alias("v"))
    return out.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
