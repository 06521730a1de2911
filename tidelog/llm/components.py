"""Connected components by alternating large-star and small-star steps over edge tables.

A step has some ten stages, and there are several. Tables of few edges are therefore taken by few tasks, in
proportion to their rows: with a task and a kept file per shuffle partition, the tasks, files and processes of
a step cost far more than its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import materialize
from tidelog.session import shuffles_removed


EDGES = 4096  # in a task, about


def _towards_min(edges: DataFrame, tasks: int) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the least node of its neighbourhood."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.where("b > a").join(least, "a")
    return linked.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").coalesce(tasks).distinct()


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    """Small star: a node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).coalesce(tasks)
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.coalesce(tasks).unionAll(least.select("a", F.col("m").alias("b")).coalesce(tasks)).distinct()


def _are_stars(edges: DataFrame, tasks: int) -> bool:
    """Whether every node is a root or linked to one root alone, so that no round would change an edge."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    with shuffles_removed(edges.sparkSession):
        return ends.where("up + down > 1").coalesce(tasks).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the least node of its component.

    Each round writes the edges to the checkpoint folder, so the plan stays short and a lost
    executor costs one round at most. No node's neighbours are gathered: stars are joins, whose hot
    keys Spark splits. An edge table without rows gives no rows.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    with shuffles_removed(edges.sparkSession):
        tasks = 1 + edges.count() // EDGES  # no step makes more edges than there were
    edges = edges.coalesce(tasks)
    while not _are_stars(edges, tasks):
        edges = materialize(_small_star(_towards_min(edges, tasks), tasks).coalesce(tasks))
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()).coalesce(tasks)
