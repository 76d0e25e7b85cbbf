"""Edge-list jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def undirected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct unordered pairs with ``v < w``."""
    return (
        edges.filter(F.col(a) != F.col(b))
        .select(F.least(a, b).alias("v"), F.greatest(a, b).alias("w"))
        .distinct()
    )


def allowed_edges(edges: DataFrame, blockers: DataFrame, a: str, b: str) -> DataFrame:
    """Candidate pairs that no blocker names, in either direction."""
    return undirected(edges, a, b).join(undirected(blockers, a, b), ["v", "w"], "left_anti")


def allowed_partner_counts(vertices: DataFrame, vertex: str, blockers: DataFrame, a: str, b: str) -> DataFrame:
    """How many partners each vertex may still be tied to, with no pair built.

    All other vertices minus the distinct blocked ones.
    """
    ids = vertices.select(F.col(vertex).alias("vertex")).distinct()
    pairs = undirected(blockers, a, b).join(ids.withColumnRenamed("vertex", "v"), "v", "left_semi")
    pairs = pairs.join(ids.withColumnRenamed("vertex", "w"), "w", "left_semi")
    blocked = degrees(pairs, "v", "w").withColumnRenamed("degree", "blocked")
    total = ids.agg(F.count(F.lit(1))).scalar()
    free = total - 1 - F.coalesce("blocked", F.lit(0))
    return ids.join(blocked, "vertex", "left").select("vertex", free.alias("partners"))


def degrees(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Degree of each vertex of an undirected edge list."""
    ends = edges.select(F.explode(F.array(a, b)).alias("vertex"))
    return ends.groupBy("vertex").agg(F.count(F.lit(1)).alias("degree"))


def all_degrees_two(degree: DataFrame) -> DataFrame:
    return degree.agg(F.coalesce(F.bool_and(F.col("degree") == 2), F.lit(False)).alias("all_two"))
