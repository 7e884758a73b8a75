"""Connected components of a graph held as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import written


def connected_components(edges: DataFrame, nodes: int | None = None) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its smallest node.
    ``nodes`` is a bound on their number, if one is known.

    Each round, every node takes the smallest label among itself and its
    neighbours, then the label of that label; labels only fall, and the rounds end when none changes.
    Labels are written to the shared folder every round, so no round depends
    on the lineage of those before.  Neighbours meet in joins and partial
    minima, so a node with very many edges isn't gathered anywhere."""
    edges = written(edges.filter("a <> b").distinct(), nodes)
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), nodes)
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = lower.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = written(lower.join(jump, "component", "left").select("node", "old", F.coalesce("further", "component").alias("component")), nodes)
        if labels.filter("component <> old").isEmpty():
            return labels.select("node", "component")
