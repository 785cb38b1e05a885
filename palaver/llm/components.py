"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import attach, cut, uncut


def components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (its smallest node) for all nodes of the edges (`a`, `b`).

    A step only takes minima over neighbours and gives them back to the edges; nodes that hold a good share of all
    edges get theirs by broadcast (see `attach`), so no node's edges are gathered.  It ends when no edge changes.  A
    step's copy is deleted once the next one's is written.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = held = cut(pairs)
    before = None
    total = 2 * pairs.count()
    while True:
        # large star: every neighbour larger than the node moves to the smallest of the neighbourhood
        both = pairs.union(pairs.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"), F.count(F.lit(1)).alias("_n"))
        wide = attach(both, low, "a", ["m"], total, F.col("b")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        least = wide.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("_n"))
        moved = attach(wide, least, "a", ["m"], total, F.col("b")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = cut(moved.union(least.select("a", F.col("m").alias("b"))).distinct())
        uncut(held)
        held = pairs
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count_distinct("a")).first()
        if state == before or state[0] == state[2] and not _chained(pairs):
            break
        before = state
        total = max(1, 2 * state[0])
    found = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()


def _chained(pairs: DataFrame) -> bool:
    """Whether some node is both the end and the start of an edge; otherwise all are stars."""
    return not pairs.join(pairs.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty()
