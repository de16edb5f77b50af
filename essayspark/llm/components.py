"""Connected components of an edge table, by alternating large and small stars.

Every round is two aggregations (minimum neighbour, combined in every task) and two
joins on the vertex; a hub's rows are spread by the skewed-join handling.  The rounds
needed grow with the logarithm of the longest path.  Each round's edges are
written to the shared checkpoint folder, so a lost executor costs one round at most
and nothing of the graph is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from essayspark.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns a, b (long); rounds go on until none changes an edge.  Returns v, root for every vertex of a link to
    another one: root is the smallest vertex of its component."""
    u, v = F.col("u"), F.col("v")
    state = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(u != v).distinct())
    before = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = state.unionByName(state.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(v > u).select(v.alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))
        state = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    roots = state.select(u.alias("v"), v.alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("v"), "root").distinct())
