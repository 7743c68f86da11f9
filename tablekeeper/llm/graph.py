"""Connected components of an edge table by contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the ``(a, b)`` edges; nodes of one component share a label.

    In each round every node takes its smallest neighbour (or itself), and the edges go between what their ends have
    taken. Rounds go on while edges are left, about the logarithm of the longest chain; each is written to the shared
    folder, so a lost executor repeats one round at most. Edges shrink from round to round, and smallest neighbours are
    combined before the shuffle, so a node with very many edges is no burden on one task.
    """
    edges = stage(edges.where("a <> b").select("a", "b").distinct(), "edges")
    rounds = []
    while edges.limit(1).count():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(edges.select("b", "a"))
        taken = stage(
            both.groupBy("node").agg(F.min("other").alias("other")).select("node", F.least("node", "other").alias("label")),
            "taken",
        )
        rounds.append(taken)
        of_a = taken.select(F.col("node").alias("a"), F.col("label").alias("x"))
        of_b = taken.select(F.col("node").alias("b"), F.col("label").alias("y"))
        edges = stage(
            edges.join(of_a, "a").join(of_b, "b").where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            "edges",
        )
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))

    def follow(labels: DataFrame, taken: DataFrame) -> DataFrame:
        step = taken.select(F.col("node").alias("label"), F.col("label").alias("next"))
        return labels.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))

    return stage(reduce(follow, rounds), "labels")
