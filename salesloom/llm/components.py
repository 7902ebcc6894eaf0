"""Connected components of a graph given as edges, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.shared import written


def connected_components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id that is reachable) for every id of ``edges`` (a, b).

    Every round replaces the edges by shorter ones with the same components: each node is linked with the smallest
    node next to it, first its larger neighbours, then its smaller ones (Kiveris et al., 2014). The edges of a round
    are written to the shared folder; joins have plain exchanges on both sides, so that Spark splits a node of many
    edges. The rounds end when the edges are stars around the smallest nodes.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "edges")
    while True:
        both = edges.union(edges.select("low", "high")).toDF("node", "near")
        least = written(
            both.groupBy("node").agg(F.least("node", F.min("near")).alias("least")), "least"
        )
        # large star: larger neighbours to the smallest node around
        large = edges.join(least, edges["low"] == least["node"]).select("high", F.col("least").alias("low"))
        large = written(large.where("high <> low").distinct(), "large")
        # small star: smaller neighbours and the node itself to the smallest of them
        smallest = written(large.groupBy("high").agg(F.min("low").alias("least")), "smallest")
        linked = large.join(smallest, "high")
        new = linked.select(F.col("low").alias("high"), F.col("least").alias("low")).union(
            smallest.select("high", F.col("least").alias("low"))
        )
        new = written(new.where("high <> low").distinct(), "edges")
        # stars: no node is both a centre and a leaf, and each leaf has one centre
        counts = new.agg(F.count(F.lit(1)).alias("edges"), F.countDistinct("high").alias("leaves")).first()
        leaf_centres = new.select("low").distinct().join(new.select(F.col("high").alias("low")).distinct(), "low", "left_semi")
        if counts["edges"] == counts["leaves"] and leaf_centres.isEmpty():
            centres = new.select(F.col("low").alias("id")).distinct()
            return new.select(F.col("high").alias("id"), F.col("low").alias("component")).union(
                centres.select("id", F.col("id").alias("component"))
            )
        edges = new
