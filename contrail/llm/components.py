"""Connected components of a link table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) -> (node, comp): comp is the smallest node
    reachable. Each round takes the least label over a node's neighbours,
    then the label of that label, and is written to the shared checkpoint
    folder; it ends when no label changes. Only counts reach the driver."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.filter("a <> b").distinct(), "edges")
    labels = edges.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("comp"))
    while True:
        labels = stored(labels, "labels")
        near = (edges.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy("a").agg(F.min("comp").alias("m")))
        low = labels.join(near, labels["node"] == near["a"]).select(
            "node", "comp", F.least("comp", "m").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("comp").alias("above"))
        new = stored(low.join(up, "low").select("node", F.least("low", "above").alias("comp"),
                                                F.col("comp").alias("old")), "labels")
        labels = new.select("node", "comp")
        if new.filter("comp <> old").isEmpty():
            return labels
