"""Connected components of an undirected graph as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b); root is the least node
    of the component.

    Large-star and small-star steps alternate: each node hands its larger, then
    its smaller neighbours to the least of them. Every step is a grouping with
    partial minima and an equi-join, written to the shared folder; no node's
    neighbours are gathered. It ends when a round changes nothing.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), "edges")

    def mark(e):
        r = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a")
                 .select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.*").where("a <> b").distinct())
        now = staged(small, "edges")
        before, seen = seen, mark(now)
        if before == seen:
            break
    star = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return star.unionByName(star.select(F.col("root").alias("node"), "root").distinct())
