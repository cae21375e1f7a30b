"""Connected components of a table of links, labelled by their smallest node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odoscan.llm.common import stage


def _roots(up: DataFrame) -> DataFrame:
    """(node, root) from pointers (node, root) that lead to smaller nodes; each round doubles the steps."""
    while True:
        further = up.select(F.col("node").alias("root"), F.col("root").alias("_further"))
        stepped = stage(up.join(further, "root", "left").select("node", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved")))
        up = stepped.select("node", "root")
        if not stepped.filter("_moved").limit(1).count():
            return up


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node in a link; null ends are left out.

    Links are contracted before they are joined. Every node with a smaller neighbour points to the
    smallest one, which an aggregation finds with partial sums in each task; pointers are
    followed to their roots; links then lead from root to root, and all that have become
    equal or loops are dropped. What is left holds no more than half of a component's nodes,
    and of the stars and bundles that the near-copy search makes next to nothing, so the number of rounds is at
    most the logarithm of a component's size. Each round is written to the shared folder.
    A node with very many links is split by the join.
    """
    low, high = F.least(a, b).alias("b"), F.greatest(a, b).alias("a")
    edges = stage(links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(high, low).distinct())
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    trail = []
    while edges.limit(1).count():
        roots = _roots(stage(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))))
        trail.append(roots)
        # The larger end always has a root, the smaller one may be a root itself.
        ends = edges.join(roots.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").select("ra", "b").distinct()
        ends = ends.join(roots.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left").select("ra", F.coalesce("rb", "b").alias("rb"))
        edges = stage(ends.filter("ra != rb").select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct())
    if not trail:
        return nodes.select("node", F.col("node").alias("label"))
    labels = trail[-1].select("node", F.col("root").alias("label"))
    for roots in reversed(trail[:-1]):
        later = labels.select(F.col("node").alias("root"), F.col("label").alias("_later"))
        moved = roots.join(later, "root", "left").select("node", F.coalesce("_later", "root").alias("label"))
        labels = stage(moved.unionByName(labels))
    return nodes.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
