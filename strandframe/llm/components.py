"""Connected components of a link table, by labels that shrink to the smallest key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``links`` (a, b); the label is the smallest node that can be reached.

    Each round takes the smallest label among neighbours and then the label of that label, so
    long chains halve. Rounds are written tables; sums over keys are combined before the shuffle.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = _written(both, "links")
    labels = _written(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = edges.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("j"), F.col("label").alias("further"))
        step = step.join(jump, F.col("label") == F.col("j"), "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        step = _written(step, "labels")
        labels = step.select("node", "label")
        if step.filter("old <> label").isEmpty():
            return labels
