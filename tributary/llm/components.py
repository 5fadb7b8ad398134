"""Connected components of an edge list by alternating large and small stars.

Every step is a grouped minimum and a join; the edge list is stored between
rounds, so lost executors cost one step. A component of any size stays a set of
rows (node, smallest node). Null ends are dropped; loops and repeated edges do
no harm; an empty edge list gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """``edges`` (u, v) with u > v, rewired to the smallest neighbour."""
    if large:
        sides = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = edges
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    joined = sides.join(least, "u")
    if large:
        rewired = joined.filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        return rewired.filter("u > v").distinct()
    rewired = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).unionAll(
        least.select("u", F.col("least").alias("v"))
    )
    return rewired.filter("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge; ``edges`` has the long columns a and b."""
    current = stored(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    seen = mark(current)
    while seen[0]:
        current = stored(_stars(_stars(current, large=True), large=False), "edges")
        now = mark(current)
        if now == seen:
            break
        seen = now
    ends = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionAll(ends.select("component", "component").distinct().toDF("node", "component"))
