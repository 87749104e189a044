"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum (combined map-side) joined back to the edges, so a hub's edges are never gathered
in one task, and each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.llm.scratch import Scratch


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Edges come with u > v."""
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(u long, v long) edges to (node, component): the smallest reachable node. Self-loops and repeats are harmless.

    Nodes without an edge to another node aren't in the result. No edges give no rows.
    """
    e = scratch.keep(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    sign = None
    for _ in range(max_rounds):
        nxt = scratch.keep(_small_star(_large_star(e)), "stars")
        row = nxt.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        scratch.drop(e)
        e = nxt
        if (row["n"], row["x"]) == sign:
            break
        sign = (row["n"], row["x"])
    else:
        raise RuntimeError(f"components didn't settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
