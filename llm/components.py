"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelf.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b): the label is the smallest node it reaches.

    Every round each node takes the smallest label around it, then the label of its label. Only
    minima are aggregated, so a node with very many links is combined before the shuffle. Each
    round's table is written to the shared folder; rounds end when no label changes, and grow with
    the logarithm of the longest chain. No edges give no rows.
    """
    given = stage(edges.select("a", "b").where("a <> b").distinct(), "given-links")
    # Each node keeps its smallest neighbour, which its other neighbours are handed on to; these
    # links repeat each other, so far fewer are left.
    least = given.groupBy("a").agg(F.min("b").alias("m"))
    handed = given.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    fewer = least.select("a", F.col("m").alias("b")).unionByName(handed).distinct()
    both = fewer.unionByName(fewer.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.distinct(), "links")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label"), F.lit(True).alias("changed")
    ), "labels")
    while not labels.where("changed").isEmpty():
        old = labels.select("node", "label")
        near = both.join(old.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("m"))
        stepped = old.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("was"), F.least("label", "m").alias("label")
        )
        jump = old.select(F.col("node").alias("label"), F.col("label").alias("far"))
        labels = stage(stepped.join(jump, "label").select(
            "node", F.least("label", "far").alias("label"),
            (F.least("label", "far") < F.col("was")).alias("changed"),
        ), "labels")
    return labels.select("node", "label")
