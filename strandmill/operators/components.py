"""Connected components of an undirected graph given as edges, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.session import settle


def connected_components(edges: DataFrame) -> DataFrame:
    """``a, b`` -> ``node, label``: the smallest node that each node of an edge can reach.

    In every round a node takes the smallest label among its neighbours', then its label's label. Both steps only
    aggregate with a map-side minimum, and each round's labels are settled in the shared folder.
    """
    both = settle(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = settle(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("n_node")).agg(F.min("label").alias("n_label"))
        hooked = labels.join(near, F.col("node") == F.col("n_node")).select("node", F.least("label", "n_label").alias("to"), "label")
        above = labels.select(F.col("node").alias("u_node"), F.col("label").alias("u_label"))
        jumped = settle(
            hooked.join(above, F.col("to") == F.col("u_node")).select(
                "node", F.least("to", "u_label").alias("label"), (F.least("to", "u_label") != F.col("label")).alias("moved")
            )
        )
        labels = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return labels
