"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the least node of its component, for every node of ``edges``.

    Each round gives every node the least label among itself and its
    neighbours and then the label of that label, so labels travel along paths
    at doubling speed. Rows stay as many as nodes and edges; every round is
    written to the shared checkpoint folder, and ends when nothing changed.
    """
    both = cut(edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
               .union(edges.select(F.col(b), F.col(a))).distinct())
    label = both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("least"))
    label = cut(label.select("node", F.least("node", "least").alias("root")))
    while True:
        near = (both.join(label.select(F.col("node").alias("y"), "root"), "y")
                .groupBy(F.col("x").alias("node")).agg(F.min("root").alias("near")))
        step = label.join(near, "node").select("node", F.col("root").alias("old"),
                                               F.least("root", "near").alias("mid"))
        jump = step.select(F.col("node").alias("mid"), F.col("mid").alias("root"))
        new = cut(step.join(jump, "mid").select("node", "old", "root"))
        label = new.select("node", "root")
        if new.filter("old <> root").isEmpty():
            return label
