"""Connected components of a table of links, by rounds of joins: no link list ever meets in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.llm.common import cut_lineage


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """`a`, `b` (any order, repeats and loops allowed) to node and root, the least node of its component.

    Alternates large-star and small-star rounds: each turns the links of a node toward its least neighbour, with two
    aggregations and one join per round, and ends when nothing changes. A node of very many links costs one row per link.
    """
    edges = cut_lineage(_sorted(links))
    size = _mark(edges)
    for _ in range(most_rounds):
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = _mark(edges)
        if now == size:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
            ).distinct()
        size = now
    raise RuntimeError(f"components: no fixpoint in {most_rounds} rounds")


def _sorted(links: DataFrame) -> DataFrame:
    """The greater node first."""
    return links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _mark(edges: DataFrame) -> tuple:
    found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(found)


def _large_star(edges: DataFrame) -> DataFrame:
    """Greater neighbours of every node go to the least of the node and its neighbours."""
    near = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return near.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of every node, and the node, go to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _sorted(moved.union(least.select("a", F.col("m").alias("b"))))
