"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from adjudica.session import materialise


def components(links: DataFrame) -> DataFrame:
    """The component of every node that has a link: columns node and label, the label being its smallest node.

    ``links`` has two columns of one type; direction, repeats and loops don't matter. In each round a node takes
    the smallest label around it, then the label of its label, so long chains shrink quickly. A hub's messages
    are reduced to one minimum before they are shuffled. Each round is written to the shared folder, so a lost
    executor costs no more than the round it worked in.
    """
    a, b = links.columns
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    edges = materialise(both.union(both.select("y", "x")).distinct(), "edges")
    # One round without any join: the smallest neighbour, or the node itself.
    labels = materialise(
        edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("label")), "labels"
    )
    while not labels.isEmpty():
        offered = edges.join(labels, F.col("x") == F.col("node")).groupBy(F.col("y").alias("at")).agg(F.min("label").alias("offer"))
        nearer = labels.join(offered, F.col("node") == F.col("at"), "left").select(
            "node", F.col("label").alias("was"), F.least("label", "offer").alias("label")
        )
        nearer = materialise(nearer, "nearer")
        jump = nearer.select(F.col("node").alias("at"), F.col("label").alias("far"))
        moved = materialise(
            nearer.join(jump, F.col("label") == F.col("at"), "left").select(
                "node", "was", F.least("label", "far").alias("label")
            ),
            "labels",
        )
        labels = moved.select("node", "label")
        if moved.where("was <> label").isEmpty():
            break
    return labels
