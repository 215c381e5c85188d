"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.session import stored


def _edges(pairs: DataFrame) -> DataFrame:
    return pairs.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return _edges(edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    lower = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _edges(lower.union(least.select("u", F.col("m").alias("v"))))


def connected_components(pairs: DataFrame) -> DataFrame:
    """``node``, ``component`` (least node reachable) for the nodes of ``pairs`` (u, v) that are not the least.

    Stars are formed by a minimum per node and a join, never by gathering a node's neighbours,
    so a node linked with very many others is summed before it is shuffled. Every round is
    written to the shared folder; rounds end when the links stay as they are.
    """
    edges, before = stored(_edges(pairs)), None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before, edges = mark, stored(_small_star(_large_star(edges)))
