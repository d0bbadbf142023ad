"""Connected components of an edge table, by alternating large-star and small-star rounds.

Both rounds are a grouped minimum (partially aggregated before the shuffle) and one equi-join, so a
node with a third of all edges is a skewed join key that adaptive execution splits, never a group
held by one task.  The state of each round goes to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    """Order-free digest of an edge set (one row)."""
    h = F.xxhash64("u", "v")
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
                  F.sum(F.shiftright(h, 20)).alias("s")).first()
    return tuple(r)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger to the smaller node (u > v)."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``edges(a, b)`` -> ``(node, root)`` for every node that has an edge; root = smallest node.

    Self loops and nulls are dropped, repeated edges count once; an empty table gives an empty one.
    """
    cur = (edges.where("a is not null and b is not null and a != b")
           .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    cur = stored(cur, f"{name}-0")
    state = _state(cur)
    turn = 0
    while state[0]:
        turn += 1
        cur = stored(_small_star(_large_star(cur)), f"{name}-{turn}")
        new = _state(cur)
        if new == state:
            break
        state = new
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
