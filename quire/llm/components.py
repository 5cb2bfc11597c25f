"""Connected components of links between 64-bit keys, in the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm._shared import materialize


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Rows (v, root) for every end of an edge (a, b): root is the smallest key it reaches.

    Alternating large-star and small-star steps: each vertex links its larger, then its smaller,
    neighbours to the least one, until every edge ends at a root. Each round is written to
    the shared folder. A hub's neighbours are never gathered: both steps are a grouped minimum
    and an equi-join. Raises if ``most_rounds`` do not suffice (they do for any 2^20 vertices).
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if now.isEmpty():
        return now.select(F.col("u").alias("v"), F.col("v").alias("root"))
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: neighbours above u link to the least of u and its neighbours
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u's smaller neighbours and u itself link to the least of them
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        paired = large.join(lowest, "u")
        small = paired.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lowest.select("u", F.col("m").alias("v")))
        after = materialize(small.where("u <> v").distinct(), "edges")
        # done when no end of an edge is itself linked further: all edges are stars around roots
        roots = after.select(F.col("v").alias("u")).distinct()
        single = after.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        if single and after.join(roots, "u", "left_semi").isEmpty():
            now = after
            return now.select(F.col("u").alias("v"), F.col("v").alias("root")).unionByName(now.select("v").distinct().select("v", F.col("v").alias("root")))
        now = after
    raise RuntimeError(f"the components need more than {most_rounds} rounds")
