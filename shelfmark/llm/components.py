"""Connected components of a graph held as a DataFrame of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, compact


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b): the smallest node reachable.

    Each round, every node points at its smallest neighbour if that is smaller; paths of
    pointers are then halved until all end at a root, and the graph shrinks to its roots.
    Every root that has links gets or gives a pointer, so rounds grow with the logarithm of
    the nodes. Nothing but counts comes to the driver.
    """
    links = checkpoint(links.select("a", "b").where("a <> b").distinct())
    labels, n = None, links.count()
    while n:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = checkpoint(compact(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), n))
        while True:
            up = roots.select(F.col("node").alias("root"), F.col("root").alias("up"))
            step = checkpoint(compact(roots.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), n))
            roots = step.select("node", "root")
            if step.where("moved").isEmpty():
                break
        if labels is None:
            labels, most = roots.withColumnRenamed("root", "component"), 2 * n
        else:
            on = roots.withColumnsRenamed({"node": "component", "root": "up"})
            labels = checkpoint(compact(labels.join(on, "component", "left").select("node", F.coalesce("up", "component").alias("component")), most))
        for end in ("a", "b"):
            links = links.join(roots.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("root", end)
        links = checkpoint(compact(links.select("a", "b").where("a <> b").distinct(), n))
        n = links.count()
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
