"""Connected components of an edge table by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of (a, b): the label is the least node of its component.

    Each round a node takes the least label among its neighbours' and its own, and then the
    label of that label. A star settles in two rounds, a path of n nodes in about log n. Node
    labels are written after each round; nothing but the number of changes is collected.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("l")).select("node", F.least("node", "l").alias("label")), "labels")
    while True:
        offered = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("_offer"))
        taken = labels.join(offered, labels["node"] == offered["a"]).select("node", "label", F.least("label", "_offer").alias("_next"))
        target = labels.select(F.col("node").alias("_at"), F.col("label").alias("_far"))
        jumped = taken.join(target, F.col("_next") == F.col("_at")).select("node", "label", F.least("_next", "_far").alias("_next"))
        step = written(jumped, "labels")
        changed = step.where(F.col("label") != F.col("_next")).limit(1).count()
        labels = step.select("node", F.col("_next").alias("label"))
        if not changed:
            return labels
