"""Connected components of an edge table, by smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import cut


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Label every node of edges(a, b) with the smallest node reachable from it.

    Hash-to-min with pointer jumping: each round a node takes the smallest label
    among its own and its neighbours', then the label of that label.  Rounds grow
    with the logarithm of the longest path, not with the number of rows; labels
    are written to the shared folder each round.  Null ends are ignored; an
    empty edge table gives an empty result.  Returns node, component (long).
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = cut(edges.union(edges.select("b", "a")).distinct(), f"{name}-edges")
    labels = cut(
        both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("component")),
        f"{name}-labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy("a")
            .agg(F.min("component").alias("low"))
            .withColumnRenamed("a", "node")
        )
        stepped = labels.join(near, "node").select("node", "component", F.least("component", "low").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        moved = stepped.join(jump, "next").select(
            "node", F.least("next", "far").alias("component"), (F.least("next", "far") < F.col("component")).alias("changed")
        )
        moved = cut(moved, f"{name}-labels")
        labels = moved.select("node", "component")
        if not moved.where("changed").limit(1).count():
            return labels
