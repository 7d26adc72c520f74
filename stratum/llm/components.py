"""Connected components of an edge table by alternating large-star and small-star steps.

Both steps keep the components and only rewire edges to smaller ends; when
neither changes anything every node points to the least node of its
component.  Each round is written to the shared folder, so the lineage stays
short; the rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.stage import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges have ``a > b``.  large: link larger neighbours to the least; small: smaller ones."""
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    out = sides.join(least, "u")
    if large:
        out = out.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of an edge (columns ``a``, ``b`` of any ordered type); root is the least node."""
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), name)
    seen = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if not state[0] or state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = state
        now = staged(_star(_star(now, True), False), name)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
