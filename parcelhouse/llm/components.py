"""Connected components of a table of links, by contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelhouse.plans.scratch import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every node of ``links``; the label is the least node it reaches.

    Each round points every node at its least neighbour, follows one more pointer, and
    contracts the links to the targets; the rounds needed grow with the logarithm of the
    longest path. Minima combine before the shuffle, so a node with a third of all links is
    no burden. Rounds are written out, which cuts lineage; nothing but a count reaches the driver.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    links = materialize(links, "links")
    labels = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = labels.withColumn("label", F.col("node"))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        onward = least.select(F.col("a").alias("m"), F.col("m").alias("mm"))
        point = least.join(onward, "m", "left").select("a", F.coalesce("mm", "m").alias("to"))
        point = materialize(point, "pointers")
        labels = materialize(
            labels.join(point.withColumnRenamed("a", "label"), "label", "left")
            .select("node", F.coalesce("to", "label").alias("label")), "labels")
        links = materialize(
            links.join(point.withColumnRenamed("to", "ta"), "a")
            .join(point.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b")
            .select(F.col("ta").alias("a"), F.col("tb").alias("b")).where("a <> b").distinct(),
            "links")
    return labels
