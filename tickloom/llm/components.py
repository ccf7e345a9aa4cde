"""Connected components of a table of edges, without a driver-side graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.scratch import drop, written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node reachable, for every node of an edge (a, b).

    Each round takes the smallest label among the neighbours and then the label of that label,
    so the number of rounds grows with the logarithm of the longest path. Rounds are written to
    the shared folder; the one before is removed.
    """
    both = written(
        edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges"
    )
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.min("b"), F.first("a")).alias("label")
        ),
        "labels",
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b")
        lowest = near.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        step = labels.join(lowest, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "low").alias("label")
        )
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = step.join(jump, "label").select(
            "node", "was", F.least("label", "further").alias("label")
        )
        new = written(step, "labels")
        changed = new.where("label <> was").limit(1).count()
        drop(labels)
        labels = new
        if not changed:
            drop_later = labels.select("node", "label")
            drop(both)
            return drop_later
