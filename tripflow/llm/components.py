"""Connected components of an edge table, by alternating large and small stars.

Each round points every node at the smallest node it can see; the number of rounds grows with the logarithm of
the graph. Everything stays in tables, and each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stored


# A table of so few edges is dealt to tasks of `TASK_EDGES`, and its minima go to all executors (some 10 MB): a round
# then takes a few tasks in place of several times the number of shuffle partitions.
FEW_EDGES = 300_000
TASK_EDGES = 50_000


def _tasks(edges: int) -> int | None:
    return 1 + edges // TASK_EDGES if edges <= FEW_EDGES else None


def _least(edges: DataFrame, tasks: int | None) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return F.broadcast(least.coalesce(tasks)) if tasks else least


def _once_each(edges: DataFrame, tasks: int | None) -> DataFrame:
    return edges.distinct().coalesce(tasks) if tasks else edges.distinct()


def _large_star(edges: DataFrame, tasks: int | None) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both.join(_least(both, tasks), "a").where(F.col("b") > F.col("a"))
    return _once_each(seen.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b"), tasks)


def _small_star(edges: DataFrame, tasks: int | None) -> DataFrame:
    # Edges come with a > b.
    least = _least(edges, tasks)
    # Each node keeps its smallest neighbour, and ties the others to it.
    own = F.col("b") == F.col("m")
    tied = edges.join(least, "a").select(F.when(own, F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return _once_each(tied, tasks)


def _star_forest(edges: DataFrame, tasks: int | None) -> bool:
    """Whether each node has one edge to a node that has none of its own: a round would change nothing."""
    by_node = edges.groupBy("a").agg(F.count("*").alias("n"))
    if not by_node.where("n > 1").isEmpty():
        return False
    return edges.join(_least(edges, tasks).select(F.col("a").alias("b")), "b", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node on an edge (columns a, b; any orientation); the label is the smallest node."""
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    while True:
        tasks = _tasks(now.count())
        if _star_forest(now, tasks):
            break
        now = stored(_small_star(_large_star(now, tasks), tasks), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
