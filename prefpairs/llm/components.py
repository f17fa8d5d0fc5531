"""Connected components of a large edge table by alternating large-star and small-star.

Each round is two shuffles of the edges; nothing is gathered on the driver but a count and
a digest of the edges, by which the fixed point is seen. A hub's edges meet only in a
partial minimum and in a join with the minima. These are written first: a join with an
aggregate above its exchange is a form that AQE does not split, one with a table is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prefpairs.llm.common import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v) with v < u. Large: link each larger neighbour to the smallest of the
    node and its neighbours; small: link the node and its smaller neighbours to it."""
    if large:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        low = materialize(low, "component-lows")
        linked = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        low = materialize(low, "component-lows")
        linked = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
    return linked.filter("u <> v").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges`` (a, b) -> (node, component): component is the smallest node reachable.
    Nodes without an edge are absent; loops and repeated edges do no harm."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = materialize(e, name)
    seen = _digest(e)
    while seen[0]:
        e = materialize(_star(_star(e, large=True), large=False), name)
        now = _digest(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
