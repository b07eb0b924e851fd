"""Connected components of an undirected graph, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node that can be reached) of all
    nodes of ``edges`` (``a``, ``b``: longs).

    In each round every node points to the smallest among itself and its
    neighbours; following the pointers, doubled at each step, leads to one
    node that stands for all that point to it.  The edges between different
    such nodes, each once, are the graph of the next round, so dense groups
    shrink to a few edges in the first one.  Pointers and edges are written
    to the shared folder; aggregation is partial before each shuffle.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = nodes.select("node", F.col("node").alias("label"))
    while True:
        # a is the smaller end: it points nowhere by this edge, b may point to it
        least = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to"))
        roots = edges.select(F.col("a").alias("node")).distinct().join(least, "node", "left_anti").select("node", F.col("node").alias("to"))
        pointers = written(least.unionByName(roots), "pointers")
        while True:
            onward = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
            after = written(pointers.join(onward, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "pointers")
            pointers = after.select("node", "to")
            if after.where("moved").isEmpty():
                break
        joined = labels.join(pointers.select(F.col("node").alias("label"), "to"), "label", "left")
        labels = written(joined.select("node", F.coalesce("to", "label").alias("label")), "labels")
        at = lambda c: pointers.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}"))
        moved = edges.join(at("a"), "a").join(at("b"), "b").where("to_a <> to_b")
        edges = written(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
