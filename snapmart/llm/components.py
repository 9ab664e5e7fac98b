"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import join_hot, written


#: Edges up to which a task can take all of a node's: 32 MB.
EDGES_OF_NODE = 1 << 20


def _stars(edges: DataFrame, large: bool, total: int) -> DataFrame:
    """Hang neighbours on the smallest one: those above the node (large), or the node and those below.

    `total` is a bound for the edges.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows")).withColumn("m", F.least("u", "m"))
    if total > EDGES_OF_NODE:
        least = written(least, "stars-least")
        hung = join_hot(both, least, "u", "rows", 2 * total).select("u", "v", "m")
    else:
        hung = both.join(least.drop("rows"), "u").select("u", "v", "m")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, label) for all nodes of `edges` (a, b); the label is the smallest node that can be reached.

    The number of edges never grows, and rounds grow with the logarithm of the longest path
    squared at most. Each round is written to the shared folder. Smallest neighbours are taken with
    partial minima. Beyond `EDGES_OF_NODE` edges those of a node with many stay where they are, so no
    task has them all.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{name}-edges"
    )
    state = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s"))
    seen = now.agg(state.alias("x")).first().x
    while seen.n:
        half = _stars(now, True, seen.n)
        if seen.n > EDGES_OF_NODE:
            half = written(half, f"{name}-half")
        now = written(_stars(half, False, seen.n), f"{name}-round")
        after = now.agg(state.alias("x")).first().x
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
