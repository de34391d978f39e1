"""Chains of landed pages (F3), followed by their cursors.

A page is fetched with a cursor and names the next one. Following the cursors
one by one is as many steps as a chain has pages; here every chain of every
request is ranked at once by pointer doubling: a jump of 2^k pages is two jumps
of 2^(k-1), and the pages reached so far are moved on by it. A chain of n pages
takes about log2(n) rounds of two joins on (request, cursor). Only the cursors
take part, not the pages' text, and each round is written, so a lost executor
repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import new_path

FIRST = "*"
REPEATED, MISSING, BACK, NO_FIRST, NOT_REACHED = ("repeated page", "missing page", "cursor goes back", "no first page",
                                                  "not reached")


def _written(df: DataFrame, tag: str) -> DataFrame:
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Chains:
    """The chains of some pages.

    ``links``: (request, cursor, next, key, n): one row for each cursor of a
    request, of several pages that were landed for it the one of the least
    ``key``, and how many they are. ``reached``: (request, cursor, page_num)
    from the first cursor on, at most ``max_pages``, each cursor at the first
    place it has."""

    def __init__(self, pages: DataFrame, next_cursor: Column, key: Column, max_pages: int,
                 request: str = "request_id", cursor: str = "cursor", first: str = FIRST):
        self.max_pages, self.first = max_pages, first
        rows = pages.select(F.col(request).alias("request"), F.coalesce(F.col(cursor), F.lit(first)).alias("cursor"),
                            F.when(next_cursor != "", next_cursor).alias("next"), key.alias("key"))
        self.links = _written(rows.groupBy("request", "cursor").agg(F.min(F.struct("key", "next")).alias("page"),
                                                                    F.count(F.lit(1)).alias("n"))
                              .select("request", "cursor", "page.next", "page.key", "n"), "chain-links")
        jump = self.links.where("next IS NOT NULL").select("request", F.col("cursor").alias("at"), F.col("next").alias("to"))
        reached = (self.links.where(F.col("cursor") == first)
                   .select("request", "cursor", F.lit(1).cast("int").alias("page_num")))
        step = 1
        while step < max_pages:
            on = [F.col("r.request") == F.col("j.request"), F.col("r.cursor") == F.col("j.at")]
            ahead = (reached.alias("r").join(jump.alias("j"), on)
                     .select("r.request", F.col("j.to").alias("cursor"), (F.col("r.page_num") + step).alias("page_num")))
            reached = _written(reached.unionByName(ahead).where(F.col("page_num") <= max_pages)
                               .groupBy("request", "cursor").agg(F.min("page_num").alias("page_num")), "chain-reached")
            step *= 2
            if step < max_pages:
                on = [F.col("a.request") == F.col("b.request"), F.col("a.to") == F.col("b.at")]
                jump = _written(jump.alias("a").join(jump.alias("b"), on)
                                .select("a.request", "a.at", "b.to"), "chain-jumps")
                if jump.isEmpty():
                    break
        self.reached = reached

    def pages(self) -> DataFrame:
        """(request, cursor, key, page_num) of the landed pages of each chain."""
        return self.reached.join(self.links, ["request", "cursor"]).select("request", "cursor", "key", "page_num")

    def problems(self) -> DataFrame:
        """(request, cursor, reason, n): pages landed more than once, cursors
        of a chain without a page, cursors that lead back, requests without a
        first page, and pages that no chain reaches within its limit."""
        row = lambda df, reason, n=F.lit(1): df.select("request", "cursor", F.lit(reason).alias("reason"),
                                                       n.cast("bigint").alias("n"))
        places = self.reached.select("request", F.col("cursor").alias("next"), F.col("page_num").alias("place"))
        back = (self.reached.join(self.links.where("next IS NOT NULL"), ["request", "cursor"])
                .join(places, ["request", "next"]).where("place <= page_num"))
        started = self.reached.select("request").distinct()
        unstarted = self.links.join(started, "request", "left_anti").groupBy("request").agg(F.min("cursor").alias("cursor"))
        beyond = self.links.join(self.reached, ["request", "cursor"], "left_anti").join(started, "request", "left_semi")
        return (row(self.links.where("n > 1"), REPEATED, F.col("n") - 1)
                .unionByName(row(self.reached.join(self.links, ["request", "cursor"], "left_anti"), MISSING))
                .unionByName(row(back, BACK)).unionByName(row(unstarted, NO_FIRST)).unionByName(row(beyond, NOT_REACHED)))
