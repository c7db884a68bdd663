"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Edges that one task handles, and tasks at least: a graph gets as many as its own size asks for,
#: however many partitions the session shuffles to, so rounds over few edges make few tasks and files.
EDGES, LEAST_PARTS = 100_000, 4


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not its component's least.

    Large star: each node hands its greater neighbours to its least one. Small star: each
    node hands its lesser neighbours, and itself, to the least of them. The edges of each
    round are stored, so lost executors cost one round; the number of rounds grows with the
    logarithm of the longest chain. Nothing but a count and a checksum reaches the driver.
    """
    parts = max(LEAST_PARTS, ceil(edges.count() / EDGES))  # stars never have more edges than the graph

    def few(df: DataFrame) -> DataFrame:
        return df.coalesce(parts)

    now = edges.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low"))
    now = cut(few(now.distinct()))
    mark = _mark(now)
    while True:
        both = now.select(F.col("high").alias("u"), F.col("low").alias("v")).unionByName(now.select(F.col("low").alias("u"), F.col("high").alias("v")))
        least = few(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = few(both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low")))
        large = cut(few(large.distinct()))
        least = few(large.groupBy("high").agg(F.min("low").alias("m")))
        joined = few(large.join(least, "high"))
        small = joined.where("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        small = small.unionByName(joined.select("high", F.col("m").alias("low")))
        now = cut(few(few(small).distinct()))
        new = _mark(now)
        if new == mark:
            return now.select(F.col("high").alias("node"), F.col("low").alias("root"))
        mark = new
