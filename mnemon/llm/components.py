"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemon.llm.shared import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that an edge touches; equal roots mean connected.

    Each round gives a node the least of itself and its neighbours, and goes on
    with the edges between the labels; loops and repeated edges go, so the
    graph shrinks by a constant factor a round or more and a star takes two.
    A root is one of its component's nodes, not always the least.  Edges with a
    null end are ignored; no edges give no rows.

    Everything is joins and minima over tables of edges, kept in the shared
    folder between rounds; no node's edges meet in one task before a partial
    minimum, and nothing is collected.
    """
    left = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    left = stored(left.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found: DataFrame | None = None
    while True:
        label = (
            left.select(F.col("a").alias("node"), F.col("b").alias("other"))
            .unionByName(left.select(F.col("b").alias("node"), F.col("a").alias("other")))
            .groupBy("node")
            .agg(F.min("other").alias("least"))
            .select("node", F.least("node", "least").alias("root"))
        )
        label = stored(label, "labels")
        if found is None:
            found = label
        else:
            nxt = label.select(F.col("node").alias("root"), F.col("root").alias("further"))
            found = stored(found.join(nxt, "root", "left").select("node", F.coalesce("further", "root").alias("root")), "roots")
        on_a = label.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        on_b = label.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        between = left.join(on_a, "a").join(on_b, "b").where("ra <> rb")
        left = stored(between.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "edges")
        if left.isEmpty():
            return found
