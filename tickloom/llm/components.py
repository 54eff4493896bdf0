"""Connected components with DataFrame operations only.

Nodes start with their own label.  A round gives every node the smallest label
among itself and its neighbours, then follows the label's own label once
(pointer jumping), so long chains shorten as fast as stars.  Rounds are written
out: lineage stays short and a lost executor costs one round.  Labels combine
before the shuffle; a hub's edges are a skewed join that adaptive execution
splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every end of an edge (columns a, b of one type);
    a component is named by its smallest node.  Edges with a null end are
    ignored; an empty edge table gives no rows."""
    known = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = (known.select("a", "b").union(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
            .distinct())
    both = materialize(both, "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    if not labels.limit(1).count():
        return labels
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("heard"))
        step = labels.join(heard, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "heard").alias("component"))
        target = labels.select(F.col("node").alias("at"), F.col("component").alias("jump"))
        moved = step.join(target, step["component"] == target["at"], "left").select(
            "node", "was", F.least("component", F.coalesce("jump", "component")).alias("component"))
        moved = materialize(moved, "labels")
        labels = moved.select("node", "component")
        if not moved.filter(F.col("was") != F.col("component")).limit(1).count():
            return labels
