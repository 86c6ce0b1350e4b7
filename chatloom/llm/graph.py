"""Connected components by min-label propagation with pointer jumping; every step is a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatloom.llm.common import discard, last_table, materialize


def components(edges: DataFrame) -> DataFrame:
    """node, label (the component's smallest node) for each node of edges (a, b). The number of rounds grows with the log of
    a component's diameter; nothing is gathered on the driver but a count."""
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    spark = edges.sparkSession
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        older = last_table()
        seen = both.join(labels.select(F.col("node").alias("b"), F.col("label")), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        step = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "low").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = materialize(step.join(jump, "label").select("node", "old", F.col("further").alias("label")), "labels")
        changed = not step.where("label <> old").isEmpty()
        labels = step.select("node", "label")
        discard(spark, [older])
        if not changed:
            return labels
