"""Connected components of an edge table, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (a, b); the label is the smallest node
    that is reachable.

    In a round every node points to its smallest neighbour or itself, pointers are
    followed until they end, and edges are renamed to those ends; inner edges vanish. The
    edge table shrinks by more than half a round, and each round's tables are written, so
    neither plans nor recovery grow. The driver sees counts only.
    """
    edges = stored(edges.where("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        parents = stored(both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("label")), "parents")
        while True:  # follow pointers to their ends; the distance halves each time
            up = parents.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
            jumped = stored(parents.join(up, F.col("label") == F.col("n2")).select(
                "node", F.col("l2").alias("label"), (F.col("l2") != F.col("label")).alias("moved")), "parents")
            parents = jumped.drop("moved")
            if jumped.where("moved").isEmpty():
                break
        up = parents.select(F.col("node").alias("n2"), F.col("label").alias("l2"))
        if labels is None:
            labels = parents
        else:
            labels = stored(labels.join(up, F.col("label") == F.col("n2"), "left").select(
                "node", F.coalesce("l2", "label").alias("label")), "labels")
        renamed = edges.join(up, F.col("a") == F.col("n2")).select(F.col("l2").alias("a"), "b")
        renamed = renamed.join(up, F.col("b") == F.col("n2")).select("a", F.col("l2").alias("b")).where("a <> b")
        edges = stored(renamed.select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels
