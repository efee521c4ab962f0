"""Connected components by labels that shrink to the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import written


def connected_components(edges: DataFrame) -> DataFrame:
    """node, label for every end of ``edges`` (a, b: long); the label is the smallest node of the component.

    Each round takes the smallest label among the neighbours, then the label of that label, so a chain
    shortens by more than half a round; the number of rounds grows with the logarithm of its length.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen")))
        seen = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "seen").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = written(seen.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")), "labels")
        labels = after.select("node", "label")
        if after.filter("label < old").isEmpty():
            return labels
