"""Connected components of links, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import saved


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of `links`, a frame of two columns of numbers; root is the smallest node reached.

    Every node points at the smallest label around it, then at that one's label, until nothing
    changes. Labels are minima, which tasks combine before they shuffle, so a hub costs no more
    than its links; joins of a hub are split by Spark as skewed joins.
    """
    a, b = links.columns
    ends = saved(
        links.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .unionByName(links.select(F.col(b).alias("u"), F.col(a).alias("v")))
        .where("u <> v")
        .distinct()
    )
    labels = saved(ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("root")))
    while True:
        # Smallest label of the neighbours.
        around = (
            ends.join(labels.select(F.col("node").alias("v"), F.col("root").alias("r")), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("r").alias("r"))
        )
        lower = labels.join(around, "node").select("node", F.col("root").alias("old"), F.least("root", "r").alias("root"))
        # A node whose label fell takes its old label along.
        carried = (
            lower.select(F.col("old").alias("node"), F.col("root").alias("r"))
            .groupBy("node")
            .agg(F.min("r").alias("r"))
        )
        lower = lower.join(carried, "node", "left").select("node", "old", F.least("root", "r").alias("root"))
        lower = saved(lower)
        jumped = lower.join(
            lower.select(F.col("node").alias("root"), F.col("root").alias("r")), "root"
        ).select("node", "old", F.least("root", "r").alias("root"))
        jumped = saved(jumped)
        labels = jumped.select("node", "root")
        if not jumped.where("root <> old").take(1):
            return labels
