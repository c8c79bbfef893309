"""Connected components of links between nodes, by repeated joins; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwork.llm.common import gathered, sent_if, stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (node, component) for the nodes of ``edges`` (a, b): the least node that links reach.

    Each round takes the least label among neighbours and then the label of that label, so the
    number of rounds grows with the logarithm of the longest path in practice. Labels are written to
    shared storage after every round; of few links they are sent to all tasks, so that a round is one shuffle.
    ``edges`` should be stored, as they are counted. Raises if ``rounds`` are not enough.
    """
    spark, rows = edges.sparkSession, 2 * edges.count()
    links = stored(spark, gathered(edges.select("a", "b").union(edges.select("b", "a")).distinct(), rows), "links")
    labels = links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component"))
    labels = stored(spark, gathered(labels, rows), "labels")
    for _ in range(rounds):
        beside = sent_if(labels.withColumnRenamed("node", "b"), rows, 16)
        near = gathered(links.join(beside, "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")), rows)
        lower = near.join(sent_if(labels, rows, 16), "node").select("node", F.col("component").alias("before"), F.least("component", "near").alias("component"))
        jump = sent_if(labels.select(F.col("node").alias("component"), F.col("component").alias("root")), rows, 16)
        moved = stored(spark, gathered(lower.join(jump, "component").select("node", "before", F.least("component", "root").alias("component")), rows), "labels")
        labels = moved.select("node", "component")
        if moved.where("before <> component").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {rounds} rounds")
