"""Connected components of an edge list, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paramo.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest node of its component.

    Every round points each edge's larger root at the smaller one, keeps the
    smallest offer a root gets, and lets all nodes jump to their root's root;
    it goes on until no edge joins two roots.  Grouping combines a hub's offers
    before the shuffle, joins on a hub are left to AQE's splitting.  Each
    round is written to the shared folder."""
    edges = edges.where("a <> b")
    labels = store(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().withColumn("root", F.col("node")), "cc-labels")
    left = store(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    while not left.isEmpty():
        offers = left.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("to"))
        # offers always point down, so following them ends; chains are shortened until every one ends at a root that has no offer
        offers = store(offers, "cc-offers")
        while True:
            onward = offers.select(F.col("root").alias("mid"), F.col("to").alias("end"))
            longer = offers.join(onward, offers["to"] == onward["mid"], "left")
            moved = store(longer.select("root", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved")), "cc-offers")
            offers = moved.select("root", "to")
            if moved.where("moved").isEmpty():
                break
        labels = store(labels.join(offers, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "cc-labels")
        a = left.join(offers.select(F.col("root").alias("a"), F.col("to").alias("ra")), "a", "left").select(F.coalesce("ra", "a").alias("a"), "b")
        b = a.join(offers.select(F.col("root").alias("b"), F.col("to").alias("rb")), "b", "left").select("a", F.coalesce("rb", "b").alias("b"))
        left = store(b.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    return labels
