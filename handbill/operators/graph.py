"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from handbill.session import saved


def _jumped(hooks: DataFrame) -> DataFrame:
    """(node, root) of a forest of pointers (node, to), pointer doubling until all are roots."""
    now = saved(hooks, "components-hooks")
    while True:
        onward = now.select(F.col("node").alias("to"), F.col("to").alias("next"))
        now = saved(now.join(onward, "to", "left").select(
            "node", F.coalesce("next", "to").alias("to"),
            (F.col("next").isNotNull() & (F.col("next") != F.col("to"))).alias("moved")), "components-jumps")
        if now.where("moved").isEmpty():
            return now.select("node", F.col("to").alias("root"))
        now = now.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node connected with each node that has an edge to another one.

    ``edges`` holds (u, v) of any type with an order. In a round every node hooks on to its smallest
    neighbour, if that is smaller; pointer doubling finds the roots of the trees, and the edges between trees
    are the next round's. Only minima and equality joins are used, so a node with very many edges is
    no group of one task; rounds are written to the shared folder.
    """
    left = saved(edges.where("u <> v").select("u", "v").distinct(), "components-edges")
    found = None
    while not left.isEmpty():
        both = left.union(left.select("v", "u"))
        hooks = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("to"))
        trees = saved(_jumped(hooks.select("node", F.least("node", "to").alias("to"))), "components-trees")
        start, stop = (trees.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "uv")
        left = saved(left.join(start, "u").join(stop, "v").where("ru <> rv").select(
            F.col("ru").alias("u"), F.col("rv").alias("v")).distinct(), "components-edges")
        if found is None:
            found = trees
        else:
            later = trees.select(F.col("node").alias("root"), F.col("root").alias("next"))
            found = saved(found.join(later, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root")), "components-found")
    return left.select(F.col("u").alias("node"), F.col("v").alias("root")) if found is None else found
