"""Connected components by contraction, as a chain of joins and aggregates.

Each round gives every node the neighbour (or itself) with the smallest hash of that
round, relabels both ends of every edge and drops loops and repeats. The hashes differ
between rounds, so an expected constant share of the nodes goes in each; long chains
need no more rounds than stars. A hub's edges are combined before they are shuffled, and
relabelling joins against one row per node (AQE splits a hub's edges). Rounds are
written to the shared folder; nothing comes to the driver but edge counts.

Cases: repeated edges, both directions of one edge and loops change nothing; an edge with
a null end is no edge; a node without edges is not in the result; no edges, no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SIDE_BYTES, broadcast_if_small, staged


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, root) for every node with an edge; equal root, same component."""
    edges = staged(edges.filter(F.col("a") != F.col("b")).distinct(), "cc-edges")
    labels = None
    for turn in range(1000):
        if edges.isEmpty():
            break
        ends = edges.select(F.col("a").alias("node"), F.col("b").alias("to")) \
            .unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("to")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("n"))
        best = ends.groupBy("node").agg(F.min(rank("to")).alias("best"))
        parent = staged(best.select("node", F.least("best", rank("node"))["n"].alias("root")), f"cc-parent{turn}")
        side = broadcast_if_small(parent, SIDE_BYTES)
        moved = edges.join(side.toDF("a", "ra"), "a").join(side.toDF("b", "rb"), "b") \
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        edges = staged(moved.filter(F.col("a") != F.col("b")).distinct(), f"cc-edges{turn}")
        if labels is None:
            labels = parent
        else:
            step = side.toDF("root", "next")
            labels = staged(labels.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root")), f"cc-labels{turn}")
    else:
        raise RuntimeError("components don't converge")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
