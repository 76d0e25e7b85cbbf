"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.scratch import Scratch


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Hang the trees of ``a`` and ``b`` together, each on its smallest node; ``parent`` ends up flat for their roots."""
    while len(a):
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        differ = low != high
        a, b = a[differ], b[differ]
        np.minimum.at(parent, high[differ], low[differ])


def _lowest(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    # written, so that the join below deals both sides out by itself and may split a hot node
    return scratch.write(edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), name)


def components(spark: SparkSession, pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each node of ``pairs`` reaches; nodes are longs.

    A round links every larger neighbour of a node to its smallest neighbour,
    then every smaller one, until each node hangs on the smallest of its
    component.  Each half round is written to the shared folder, so that a lost
    executor costs at most a half round, and nothing reaches the driver but the
    size and the checksum of the edge table.  Nulls link nothing.
    """
    scratch = Scratch(spark, "components")
    larger, smaller = F.greatest(F.col(a), F.col(b)).cast("long"), F.least(F.col(a), F.col(b)).cast("long")
    first = pairs.filter(F.col(a) != F.col(b)).select(larger.alias("u"), smaller.alias("v")).distinct()
    edges, last, turn = scratch.write(first, "0"), None, 0
    while True:
        check = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        state = tuple(edges.agg(F.count("*"), check).first())
        if state == last or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        last, turn = state, turn + 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _lowest(scratch, both, f"{turn}-low")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.write(large, f"{turn}-large")
        low = _lowest(scratch, large, f"{turn}-lower")
        hung = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = scratch.write(hung.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), str(turn))
        scratch.drop(str(turn - 1), f"{turn}-low", f"{turn}-large", f"{turn}-lower")
