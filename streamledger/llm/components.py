"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(pairs: DataFrame) -> DataFrame:
    """``pairs`` (a, b) of longs -> (node, root): root is the smallest node that
    a node is connected with.  Nodes without a pair are not listed.

    Each step is two aggregates and two joins over the remaining edges, whose
    number never grows; the edges are written to the shared folder between
    steps, and the steps grow with the logarithm of a component's size.
    """
    a, b = pairs.columns
    edges = pairs.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = materialize(edges, "components")
    state = _state(edges)
    while state[0]:
        # Large star: a node's larger neighbours move to its smallest neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.where("u != v").distinct()
        # Small star: a node and its smaller neighbours move to the smallest.
        least = moved.groupBy("u").agg(F.min("v").alias("m"))
        smaller = moved.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(smaller.union(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
