"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import written


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns a, b): the smallest node of its component. Alternating stars:
    each round links the larger neighbours of a node, then the smaller ones, to its smallest neighbour; the number of
    rounds grows with the logarithm of the longest path. Every round is written, so nothing is gathered at the driver
    and lineage stays short."""
    now = written(edges.where("a != b").select("a", "b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if not state[0] or state == before:
            break
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join below reads two exchanges, of which Spark splits those of nodes with many neighbours
        least = written(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    else:
        raise RuntimeError(f"components not found in {max_rounds} rounds")
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    own = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionByName(own.join(roots, "node", "left_anti"))
