"""Connected components as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b), both long; root is some node of the component.

    Each round every node moves to the neighbour (or itself) that is first in a hashed order, twice, and the edges are
    rewritten to the nodes moved to; equal edges merge.  The hashed order makes about half of the nodes of any
    component disappear per round, long chains included.  Every round is written to the shared checkpoint folder.
    """
    edges = materialise(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "cc-edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("x")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b"))).alias("m"))
        own = F.struct(F.xxhash64("x").alias("h"), F.col("x").alias("b"))
        step = step.select("x", F.least("m", own)["b"].alias("y"))
        again = step.select(F.col("x").alias("y"), F.col("y").alias("z"))
        move = materialise(step.join(again, "y").select("x", F.col("z").alias("to")), "cc-move")
        labels = materialise(labels.join(move, labels["root"] == move["x"], "left").select(
            "node", F.coalesce("to", "root").alias("root")), "cc-labels")
        to_a = move.select(F.col("x").alias("a"), F.col("to").alias("ra"))
        to_b = move.select(F.col("x").alias("b"), F.col("to").alias("rb"))
        edges = materialise(edges.join(to_a, "a").join(to_b, "b").filter("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "cc-edges")
    return labels
