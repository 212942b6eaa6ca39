"""Connected components of a graph of any shape, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposcan.llm.storage import settle


def _state(edges: DataFrame) -> tuple:
    """Count and checksum: two numbers that tell whether a round changed anything."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest id it is connected with, for each id in ``edges`` (a, b).

    Each round points the larger neighbours of every node at its smallest neighbour and then the
    node itself at the smallest of its smaller neighbours; the number of rounds grows with the logarithm of the
    longest path. Smallest neighbours are aggregated before the shuffle, so a node with a third of
    all links costs one row per task there, and joins split it by size.
    """
    now = settle(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = settle(small.distinct(), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
