"""Connected components of an undirected graph whose edges are a distributed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import join_key, materialise


def _signature(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    ).first()
    return int(row["n"]), int(row["h"] or 0)


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges with their node's ``m``; a hub's edges can be split."""
    keyed = least.select(join_key("u").alias("_node"), "m").hint("merge")
    return edges.withColumn("_node", join_key("u")).join(keyed, "_node").drop("_node")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _with_least(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _with_least(down, least).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node that has an edge; ``component`` is its smallest node.

    ``edges`` has two columns of one orderable type; self-loops and repeats are
    harmless, nulls are ignored. Alternates the two star operations (Kiveris et
    al., 2014) until the edge set stops changing: then every edge points at the
    smallest node of its component. Minima are combined before the shuffle and
    the hub of a star is one row on the other side of a sort-merge join, so that
    a hub with a third of all edges is split by adaptive execution. Each round is
    written to the scratch folder; the driver sees two numbers per round.
    """
    left, right = edges.columns
    current = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).dropna().filter("u <> v")
    current = materialise(current.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = _signature(current)
    while seen[0]:
        following = materialise(_small_star(_large_star(current)), "edges")
        signature = _signature(following)
        current = following
        if signature == seen:
            break
        seen = signature
    roots = current.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
