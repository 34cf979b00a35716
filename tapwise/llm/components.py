"""Connected components of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapwise.llm.scratch import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b): root is the smallest node it reaches.

    Each round ties every node's larger neighbours to its smallest one, then every node and its
    smaller neighbours to the smallest of them; after a logarithmic number of rounds each
    component is a star around its smallest node. Only sums over all links reach the driver. A
    node with very many links is a hot key of joins only, which adaptive execution splits.
    Links of a node with itself, repeated ones and those with a null end say nothing and go.
    """
    tied = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    tied = stored(tied.distinct())
    seen = _sums(tied)
    while seen[0]:
        tied = stored(_small_star(_large_star(tied)))
        now = _sums(tied)
        if now == seen:
            break
        seen = now
    roots = tied.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(tied.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _sums(tied: DataFrame) -> tuple:
    row = tied.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _large_star(tied: DataFrame) -> DataFrame:
    both = tied.select("a", "b").union(tied.select("b", "a"))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("u", "m"))
    return both.join(least, both["a"] == least["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(tied: DataFrame) -> DataFrame:
    least = tied.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = tied.join(least, tied["a"] == least["u"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("u", "m")).distinct()
