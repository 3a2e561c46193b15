"""Connected components of a link table, kept in Spark from start to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir


def components(links: DataFrame) -> DataFrame:
    """node, component (least node reachable) for every node of ``links`` (a, b: long, not null).

    Alternating large-star and small-star steps: every node tells its larger (smaller) neighbours about the
    least one it knows, until the links are stars around the least nodes.  Steps need about the logarithm
    of the longest path.  A node with very many links is spread by the join's skew handling, and its least
    neighbour is found by a partial aggregate, so no task holds a whole neighbourhood.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
        .checkpoint()
    )
    while not _are_stars(edges):
        edges = _small_star(_large_star(edges)).checkpoint()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every larger end has one smaller end, which is no larger end itself."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"))
    )
    ups = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count(F.lit(1)).alias("n"))
    return ups.where("up > 1 or (up = 1 and n > 1)").isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links (v, m) for all neighbours v > u of u, m the least of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # Only larger neighbours are told; in ``edges`` u is the larger end.
    upward = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    return upward.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links of u and of its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    told = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionByName(told).distinct()
