"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.work import Workspace, dealt

EACH = 50_000  # edges of a task


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected(work: Workspace, links: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """(node, root) for the nodes of `links` (a, b); root is the smallest node of its component. Each round ties
    every node's larger neighbours, then its smaller ones, to the smallest of them, until all are tied to a root;
    the nodes of a hub never meet in one task, only the smallest of them is looked up. `rows`: of links, where known."""
    first = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = work.keep(first if rows is None else dealt(first, rows, EACH), f"{name}_0")
    turn, rows = 0, edges.count()  # no turn has more
    while not _stars(edges, rows):
        both = _both_ways(edges)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root"))
        large = both.join(least, "a").where("b > a AND b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
        large = work.keep(dealt(large, rows, EACH), f"{name}_large_{turn}")
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(least, "a").where("b <> root").select(
            F.col("b").alias("a"), F.col("root").alias("b")).unionByName(least.withColumnRenamed("root", "b"))
        turn += 1
        edges = work.keep(dealt(dealt(small, rows, EACH).distinct(), rows, EACH), f"{name}_{turn}")
        work.forget(f"{name}_large_{turn - 1}", f"{name}_{turn - 1}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _stars(edges: DataFrame, rows: int) -> bool:
    """Whether every node has one edge to a root, or is a root."""
    sides = edges.select("a", F.lit(True).alias("tied")).unionByName(edges.select(F.col("b").alias("a"), F.lit(False).alias("tied")))
    odd = sides.groupBy("a").agg(F.count_if("tied").alias("ties"), F.count_if(~F.col("tied")).alias("others"))
    return dealt(odd.where("ties > 1 OR (ties > 0 AND others > 0)"), rows, EACH).isEmpty()
