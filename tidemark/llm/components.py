"""Connected components of a graph of long node ids, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest reachable node), for every node of an edge.

    Alternating stars: each node hands its larger neighbours to its smallest one, then all its smaller
    neighbours to the smallest of them, until nothing changes. The number of rounds grows with the logarithm of
    a component's size; each round keeps at most the edges it had, and the minima are combined before the
    shuffle, so a node with very many neighbours costs one row per task there.
    """
    a, b = F.col(a), F.col(b)
    edges = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        edges = stored(small, "edges")
        # Stars whose centre is no leaf of another star: one parent per node, and no parent has a parent.
        state = edges.agg(
            F.count("u").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
