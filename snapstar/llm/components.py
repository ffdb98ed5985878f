"""Connected components of an edge table, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstar.session import stage


def _star(edges: DataFrame, name: str, large: bool) -> DataFrame:
    """One star operation on edges (a, b).  Large: each node's greater neighbours
    are linked to its least neighbour; small: its lesser ones and itself are."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    linked = both.join(least, "a")
    if large:
        out = linked.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return stage(out.where("a <> b").distinct(), name)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` (the least node of the component) for every node of an edge
    but the roots themselves.

    ``edges``: (a, b) of longs, in any order and repeated at will.  Each round is
    written to the shared checkpoint folder, so lineage stays short; the driver
    sees a count and a checksum.  A hub's edges are merged map-side and joined
    under adaptive skew splitting.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), name)
    seen = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == seen or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        now = _star(_star(now, name, True), name, False)
