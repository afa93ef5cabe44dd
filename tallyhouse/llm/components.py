"""Connected components of a graph whose nodes have a bounded number of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that can be reached, for every node of
    ``edges`` (columns a, b; any direction, repeats allowed).

    Each round takes the smallest label among the neighbours and then that label's
    own label, so chains shorten quickly.  Rounds read and write tables in the
    shared folder; only the count of changed labels reaches the driver.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.col("node"), F.min("b")).alias("label"))
                     .withColumn("changed", F.lit(True)), "labels")
    while labels.where("changed").limit(1).count():
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("seen")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen")))
        step = labels.select("node", "label").join(near, "node", "left") \
            .select("node", "label", F.least("label", "seen").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("beyond"))
        labels = written(step.join(jump, "via", "left").select(
            "node", F.least("via", "beyond").alias("new"), "label",
        ).select("node", F.col("new").alias("label"), (F.col("new") < F.col("label")).alias("changed")), "labels")
    return labels.select("node", "label")
