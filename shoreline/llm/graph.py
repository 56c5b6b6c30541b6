"""Connected components of an edge table, by alternating star contractions.

Every round points each vertex at the least vertex around it: first larger neighbours at
the least one, then smaller ones. A vertex with very many edges is only ever reduced
to its minimum by a partial aggregation and joined back; its edges never meet in one task unless
they are split by the join. Each round is cut with a reliable checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoreline.session import cut_lineage


def _toward_least(edges: DataFrame) -> DataFrame:
    """(u, v) to (v, least of u and its neighbours)."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, component): the least vertex of its component, for each vertex of an edge.

    Loops and repeated edges don't matter. No edges give no rows.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    pairs = cut_lineage(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = _toward_least(large)
        small = small.select("v", "m").unionByName(small.select(F.col("u").alias("v"), "m"))
        pairs = cut_lineage(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before:
            break
        before = now
    own = pairs.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionByName(own)
