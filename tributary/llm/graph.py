"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.llm.common import spread_join, written


def components(links: DataFrame, label: str = "graph") -> DataFrame:
    """node, label: the least node of its component, for the nodes of links (a, b).

    Every round takes the least label among neighbours and then the label of that label; only links and labels
    move. A node with very many links, and a label that very many nodes have, is dealt over several tasks.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")), f"{label}-links")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), f"{label}-labels"
    )
    while True:
        met = spread_join(both, labels.withColumnRenamed("node", "b"), ["b"])
        seen = met.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        least = written(
            labels.join(seen, "node").select("node", "label", F.least("label", "near").alias("next")), f"{label}-least"
        )
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = written(spread_join(least, jump, ["next"]).select(
            "node", F.col("label").alias("was"), F.least("next", "far").alias("label")
        ), f"{label}-labels")
        labels = moved.select("node", "label")
        if moved.filter("was <> label").isEmpty():
            return labels
