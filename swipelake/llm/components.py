"""Connected components of a graph given by its links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipelake.llm.common import store


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node among the node and its neighbours."""
    both = links.union(links.select(F.col("low").alias("high"), F.col("high").alias("low"))).toDF("node", "other")
    least = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("least"))
    return both.where("other > node").join(least, "node").select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of these."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    rest = links.join(least, "high").where("low > least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return rest.union(least.toDF("high", "low")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: every linked node that isn't its component's smallest, with that smallest node.

    ``links`` has two columns of one type, in any order and with repeats. No neighbour list is ever
    gathered; the rounds grow with the logarithm of the longest path. Each round is stored.
    """
    a, b = links.columns
    links = store(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct()
    )
    seen = None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()
        if state == seen or not state[0]:
            return links.toDF("node", "root")
        seen = state
        links = store(_small_star(_large_star(links)))
