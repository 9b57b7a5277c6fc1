"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewtide.session import Workspace


def components(links: DataFrame, ws: Workspace) -> DataFrame:
    """Per node of ``links`` (a, b): node, label (the smallest node reachable).

    Each round gives a node the smallest label among its neighbours and then the label
    of that label, until nothing changes. Every round is a written table.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = ws.write(both.distinct(), "edges")
    labels = ws.write(
        edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), "labels"
    )
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        nearest = labels.join(near, "node").select(
            "node", "label", F.least("label", "near").alias("to")
        )
        of_to = labels.select(F.col("node").alias("to"), F.col("label").alias("label_of_to"))
        new = ws.write(
            nearest.join(of_to, "to").select(
                "node",
                F.least("to", "label_of_to").alias("label"),
                (F.least("to", "label_of_to") < F.col("label")).alias("changed"),
            ),
            "labels",
        )
        labels = new.select("node", "label")
        if new.filter("changed").isEmpty():
            return labels
