"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanmill.llm.frames import kept, release, side


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable from each node of ``links`` (a, b).

    Every round gives a node the smallest label among its neighbours' labels and
    then the label of its label, so a chain of n links takes about log2(n)
    rounds. Labels are checkpointed each round, which keeps plans short and
    survives lost executors. An empty table has no components.
    """
    both = kept(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label"))
    labels = kept(labels)
    while True:
        near = both.join(side(labels), F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("m"))
        low = labels.join(side(near), F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        up = low.select(F.col("node").alias("n"), F.col("label").alias("next"))
        new = kept(low.join(side(up), F.col("label") == F.col("n"), "left").select("node", "old", F.least("label", "next").alias("label")))
        labels = new.select("node", "label")
        if new.filter("old <> label").isEmpty():
            release(links.sparkSession)
            return labels
