"""Connected components over a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm._store import forget, kept

MAX_ROUNDS = 60


def _stars(links: DataFrame) -> DataFrame:
    """Large star then small star: every node's neighbours are joined to the smallest node seen next to it."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    return large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*").where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that a link names; component is the smallest node reachable.

    `links` has two columns of longs. The links stay in Spark; the driver only
    sees a count and a checksum each round, which tell when nothing changes.
    """
    a, b = links.columns
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    now, seen = kept(now), None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b"), F.col("b")).distinct())
        before, now, seen = now, kept(_stars(now)), state
        forget(before)
    raise RuntimeError("components did not settle")
