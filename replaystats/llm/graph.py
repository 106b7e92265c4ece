"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replaystats.session import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b); the component is its smallest node.

    Alternates large-star and small-star steps until nothing changes: each step joins neighbours to
    the smallest node they share, so a chain of any length is done in a logarithmic number of steps.
    A step is one grouping by node with partial aggregation and a join of the edges with it; a node
    with very many neighbours is one row per map task before the shuffle, and AQE splits it in the
    join. Each step is written to the shared folder, which cuts the lineage.
    """
    edges = stage(_ordered(edges), "edges")
    before = None
    while True:
        edges = stage(_star(edges, large=True), "large-star")
        edges = stage(_star(edges, large=False), "small-star")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = found.select(F.col("component").alias("node"), "component").distinct()
    return found.unionByName(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node ``a`` to the smaller ``b``."""
    return (
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: a node's larger neighbours join the smallest of it and its neighbours. Small: a node and
    its smaller neighbours join the smallest of those."""
    pairs = edges
    if large:
        pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    joined = pairs.join(least, "a")
    if large:
        return _ordered(joined.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
    own = least.select("a", F.col("low").alias("b"))
    return _ordered(joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(own))
