"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.runtime import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (the smallest node) of every node that has an edge.

    Each round takes the smallest label among a node's neighbours, then the label of that label, and writes the
    labels to the shared folder; it ends when nothing changes.  Labels and edges never reach the driver.
    """
    both = stage(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(F.col(b), F.col(a))).filter("u <> v").distinct(), "edges"
    )
    labels = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("u").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("m"))
        lower = labels.join(near, "u").select("u", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("u").alias("label"), F.col("label").alias("further"))
        after = lower.join(jump, "label").select("u", "old", F.least("label", "further").alias("label"))
        after = stage(after.select("u", "label", (F.col("label") < F.col("old")).alias("changed")), "labels")
        labels = after.select("u", "label")
        if after.filter("changed").isEmpty():
            return labels.select(F.col("u").alias("node"), F.col("label").alias("component"))
