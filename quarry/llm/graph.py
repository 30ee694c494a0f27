"""Connected components over an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` of every node of ``edges (a, b)``; the component is its smallest node.

    Each round moves every neighbour to the smallest one it is next to, first
    the larger and then the smaller neighbours (large-star, small-star), until
    nothing changes. A node with very many neighbours is reduced by a partial
    minimum, and the join that follows can be split by Spark. Every round is
    written with checkpoint(); the driver sees one sum a round.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct().checkpoint()
    mark = _mark(e)
    for _ in range(max_rounds):
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
        e = small.where("u <> v").distinct().checkpoint()
        now = _mark(e)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components: not settled")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(e: DataFrame):
    r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return r.n, r.s
