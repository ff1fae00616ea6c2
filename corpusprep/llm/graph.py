"""Connected components of edges between 64-bit node numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (a, b): nodes have the same root
    if edges connect them. The root is a node of the component, not always its
    smallest.

    By contraction: every node joins its smallest neighbour or itself, chains are cut
    short, and edges between what has been joined go. Each round at least halves the
    nodes of what is left of a component, and writes narrow rows only. A node with a
    third of all edges is one row per task in every aggregate.
    """
    left = stored(_simple(edges.select("a", "b")), "edges")
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("to"))
        step = stored(_shortened(step), "joined")
        maps.append(step)
        left = stored(_simple(_renamed(_renamed(left, step, "a"), step, "b")), "edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    out = maps[-1].select("node", F.col("to").alias("root"))
    for step in reversed(maps[:-1]):
        # A node that was joined takes the root of what it was joined to.
        later = out.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
        out = step.join(later, F.col("to") == F.col("_n"), "left").select("node", F.coalesce("_r", "to").alias("root"))
    return stored(out, "components")


def _simple(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _shortened(step: DataFrame) -> DataFrame:
    """Every node's target becomes its target's target. Targets fall, so no cycles."""
    target = step.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
    return step.join(target, F.col("to") == F.col("_n"), "left").select("node", F.coalesce("_t", "to").alias("to"))


def _renamed(edges: DataFrame, step: DataFrame, column: str) -> DataFrame:
    target = step.select(F.col("node").alias("_n"), F.col("to").alias("_t"))
    return edges.join(target, F.col(column) == F.col("_n"), "left").withColumn(column, F.coalesce("_t", column)).drop("_n", "_t")
