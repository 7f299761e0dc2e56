"""Connected components of a graph that no task can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakezones.session import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the least node reachable, for every node with an edge.

    Rounds of two steps shorten all paths at once, so their number grows with the logarithm of
    the longest path. In the first, the greater neighbours of a node are tied to its least
    neighbour; in the second, the smaller neighbours and the node itself are. A node of very
    many edges is a group of a minimum and a side of a join, never a list. Each round is written
    to the shared folder. Edges with a null end, loops and repeated edges change nothing.
    """
    ends = edges.select(F.col(a).alias("high"), F.col(b).alias("low")).filter("high <> low")
    state, mark = _settled(ends)
    while True:
        both = state.unionByName(state.select(F.col("low").alias("high"), F.col("high").alias("low")))
        tied = _tie(both).filter("high > centre").select("high", "low")
        tied = stage(tied.filter("high <> low").distinct(), "components-far")
        down = _tie(tied).select("high", "low")
        own = tied.groupBy(F.col("high")).agg(F.min("low").alias("low"))
        state, now = _settled(down.unionByName(own))
        if now == mark:
            break
        mark = now
    nodes = state.select(F.col("high").alias("node"), F.col("low").alias("component"))
    roots = state.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return nodes.unionByName(roots)


def _tie(edges: DataFrame) -> DataFrame:
    """For each edge centre - other, the edge other - least neighbour of the centre (or the centre)."""
    least = edges.groupBy(F.col("high").alias("centre")).agg(F.min("low").alias("least"))
    least = least.select("centre", F.least("centre", "least").alias("least"))
    joined = edges.join(least, F.col("high") == F.col("centre"))
    return joined.select(F.col("low").alias("high"), F.col("least").alias("low"), "centre")


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, greater end first, written, and a mark that changes with them."""
    high, low = F.greatest("high", "low"), F.least("high", "low")
    written = stage(
        edges.select(high.alias("high"), low.alias("low")).filter("high <> low").distinct(), "components"
    )
    hashed = F.xxhash64("high", "low").cast("decimal(20,0)")
    return written, tuple(written.agg(F.count("*"), F.sum(hashed)).first())
