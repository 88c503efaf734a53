"""Connected components of a link table, in Spark, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import common


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``links``: ``root`` is the smallest node reachable.

    Large-star: each node links its larger neighbours to its smallest one. Small-star: each node links
    its smaller neighbours and itself to the smallest. Both keep the components and never square a
    group: a node of any degree is reduced by ``min``, and its links are rewritten one by one. The
    minima are stored before they are joined back on the node: both sides of that join are then shuffled for it,
    and the adaptive join splits a node with very many links. Every round is written to the shared folder. It ends when a round changes nothing; the rounds grow with the logarithm of the
    longest chain, and running out of them is an error, not a cut.
    """
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = common.store(edges, "links")

    def checksum(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = checksum(edges)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = common.store(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "links-low")
        large = common.store(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .where("u != v").distinct(), "links-large")
        low = common.store(large.groupBy("u").agg(F.min("v").alias("m")), "links-low")
        small = (large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                             F.col("m").alias("v")).distinct())
        edges = common.store(small, "links")
        after = checksum(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # settled: stars, every link goes from a node to its root
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
