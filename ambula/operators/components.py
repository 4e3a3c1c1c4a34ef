"""Connected components of an undirected graph, as rounds of joins over stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambula.stages import write_stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node that can be reached.

    Each round takes the least label among neighbours and then the label of that label, so long chains halve. Self
    loops are allowed (they add their node); null ends are ignored; repeated edges count once.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    arcs = write_stage(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "arcs")
    # the first round needs no join: the least neighbour, or the node itself
    labels = write_stage(arcs.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    for _ in range(max_rounds):
        near = arcs.join(labels, arcs.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        met = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        up = labels.select(F.col("node").alias("mid"), F.col("component").alias("up"))
        new = write_stage(met.join(up, "mid").select("node", "old", F.least("mid", "up").alias("component")), "labels")
        labels = new.select("node", "component")
        if new.where("old <> component").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
