"""Connected components of an edge table, by contraction to smallest neighbours, without the driver holding any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stage


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the smallest node reachable.

    Every round each node takes the smallest of itself and its neighbours as parent, parents are followed to
    their roots by doubling, and the edges between different roots are the next round's graph. A root is the
    smallest node of its tree, so the last label is the smallest of the component. Tables are written
    between rounds; a hub's rows meet its parent in plain equi-joins, which AQE splits where they are skewed.
    Self-loops and repeated edges are allowed; an edge with a null end is ignored.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL")
    nodes = stage(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct(), "nodes")
    labels = nodes.select("node", F.col("node").alias("component"))
    graph = stage(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "graph")
    for _ in range(most_rounds):
        if graph.isEmpty():
            return labels
        both = graph.unionByName(graph.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")).select(F.col("a").alias("node"), "up"), "parents")
        while True:
            above = parents.select(F.col("node").alias("up"), F.col("up").alias("top"))
            parents_next = stage(parents.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") < F.col("up")).alias("moved")), "jump")
            moved = not parents_next.where("moved").isEmpty()
            parents = parents_next.select("node", "up")
            if not moved:
                break
        labels = stage(labels.join(parents, labels.component == parents.node, "left").select(labels.node, F.coalesce(parents.up, labels.component).alias("component")), "labels")
        left = stage(graph.join(parents, graph.a == parents.node).select(F.col("up").alias("a"), "b"), "left-ends")
        ends = left.join(parents, left.b == parents.node).select(left.a, F.col("up").alias("b")).where("a <> b")
        graph = stage(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "graph")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
