"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One step over (u, v) pairs; the result has u > v.

    The minima are written before they are joined, so both sides of the join are plain shuffles and
    adaptive execution may split the partition of a hub.
    """
    least = materialise(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "star-min")
    joined = pairs.join(least, "u")
    if large:
        step = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        step = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step = step.unionByName(least.select("u", F.col("m").alias("v")))
    out = materialise(step.where("u <> v").distinct(), "star")
    release(least)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of links(u, v): root is the least node that can be reached.

    Nodes without a link are absent; links of a node to itself, repeated links and either direction
    are accepted. An empty table of links gives an empty result.
    """
    edges = materialise(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, large=True)
        small = _star(large, large=False)
        release(edges)
        release(large)
        edges, before, mark = small, mark, _mark(small)
        if mark == before:
            break
    star = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
