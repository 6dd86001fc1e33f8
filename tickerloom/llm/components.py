"""Connected components of a table of links, in shuffles alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickerloom.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); component is its least node.

    Each round every node takes the least label among its own, its neighbours' and
    that of the node its label names, so labels travel twice as far each time. A
    round's table is written to the shared folder; only a count of changes is read
    on the driver.
    """
    both = saved(links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
                 .where("a <> b").distinct(), "links")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        heard = (both.join(labels.withColumnRenamed("node", "b"), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard")))
        near = labels.join(heard, "node").select(
            "node", F.col("component").alias("old"),
            F.least("component", "heard").alias("near"))
        above = labels.select(F.col("node").alias("near"), F.col("component").alias("above"))
        following = saved(
            near.join(above, "near").select(
                "node", F.least("near", "above").alias("component"),
                (F.least("near", "above") != F.col("old")).alias("moved")), "labels")
        labels = following.select("node", "component")
        if not following.where("moved").limit(1).count():
            return labels
