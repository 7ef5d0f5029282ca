"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelens.llm.common import stored


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges u > v.

    Both find the least neighbour by an aggregate that combines before its shuffle;
    the join with it splits where one node has very many links.
    """
    around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    large = (around.join(least, "u").filter("v > u")
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(lowest, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every id in ``links`` (a, b).

    Every round is written to the shared folder, which cuts the lineage. It ends when a
    round changes nothing: then every id points at its component's smallest.
    """
    edges = (links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .distinct())
    edges, before = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
                          .alias("h")).first()
        if state == before or not state["n"]:
            break
        edges, before = stored(_stars(edges), "links"), state
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component")))
