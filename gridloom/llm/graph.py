"""Connected components by contraction, with tables that stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.storage import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v): root is the smallest node it reaches.

    Every round points each node at its smallest neighbour if that is smaller,
    follows these pointers to their ends, and contracts each tree to its root.  A
    node that is no local minimum vanishes, so the rounds are logarithmic in the
    number of nodes; a hub is only ever aggregated by ``min`` or joined on the
    unique side.  Self-loops and repeated edges are fine; null ends are dropped.
    """
    pairs = edges.select("u", "v").where("u <> v")
    left = materialize(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    nodes = None
    while True:
        parent = left.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low"))
        parent = materialize(parent.select("node", F.least("node", "low").alias("root")), "parents")
        while True:
            # a root keeps itself, so only pointers at a non-root still move
            above = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = materialize(parent.join(above, "root").select("node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "jump")
            parent = moved.select("node", "root")
            if moved.where("moved").isEmpty():
                break
        if nodes is None:
            nodes = parent
        else:
            renamed = parent.select(F.col("node").alias("root"), F.col("root").alias("next"))
            nodes = materialize(nodes.join(renamed, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "nodes")
        up = parent.select(F.col("node").alias("u"), F.col("root").alias("a"))
        vp = parent.select(F.col("node").alias("v"), F.col("root").alias("b"))
        left = materialize(left.join(up, "u").join(vp, "v").where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
        if left.isEmpty():
            return nodes
