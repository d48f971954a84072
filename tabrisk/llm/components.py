"""Connected components of an edge table, distributed (alternating large-star / small-star).

Each half round rewires every edge to the smallest neighbour seen; the number
of edges never grows and rounds are logarithmic in the diameter. Every round is
checkpointed to the shared folder, so a lost executor costs one half round.
Nothing is collected but two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Edges (u > v). large: each neighbour above u to u's minimum; small: u and those below it to the minimum."""
    if small:
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
    else:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = both.join(low, "u").where("v > u").select(F.struct(F.col("v").alias("u"), F.col("m").alias("v")).alias("e"))
    return moved.select("e.u", "e.v").where("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (columns a, b, longs); root is the smallest node reachable.

    Self loops, nulls and repeated edges are ignored; no edges give an empty
    table. Nodes without an edge are not returned (they are their own root).
    """
    e = edges.where("a is not null and b is not null and a <> b")
    e = cut_lineage(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(e)
    for _ in range(max_rounds):
        if not state[0]:
            break
        e = cut_lineage(_star(_star(e, small=False), small=True))
        new = _state(e)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError("components did not settle")
    # now a star: every u points at its root; a root has no edge of its own
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
