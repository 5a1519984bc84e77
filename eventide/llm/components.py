"""Connected components of an undirected graph, by alternating large-star and small-star rounds.

(Kiveris et al., "Connected components in MapReduce and beyond".) Every step is a minimum per node, combined in the
map tasks, and a join back, which Spark splits where a node is hot; no node's neighbours are ever listed together.
Each round's edges are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.tables import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component, itself included.

    Self loops, repeated edges and edges with a null end change nothing (a null end is no node). No edges: no rows.
    """
    links = stored(_tidy(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    mark = _mark(links)
    while mark[0]:
        links = stored(_small_star(_large_star(links)), "links")
        now = _mark(links)
        if now == mark:
            break
        mark = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select("v", "v").distinct().toDF("node", "root"))


def _tidy(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger end u to the smaller end v."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node's neighbourhood."""
    both = links.union(links.select("v", "u").toDF("u", "v"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _tidy(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u")
    return _tidy(moved.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select("u", F.col("m").alias("v"))))
