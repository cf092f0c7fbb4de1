"""Connected components of a link table, as a few rounds of joins and aggregations."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusflow.llm.common import saved


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every id that has a link, with the smallest id it can reach.

    Alternates the large-star and small-star steps: each node passes its
    neighbours on to the smallest of them, so paths halve in length and stars
    stay. Minima are aggregated before the shuffle; each round is a table in
    the shared folder. Rows with a null or equal ends, repeated rows and an
    empty table are all fine.
    """
    e = (links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v"))
         .where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = saved(e, "cc")
    if e.isEmpty():
        return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    while True:
        # Large star: neighbours above u go to the smallest neighbour of u (u itself included).
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its neighbours below go to the smallest of them.
        low2 = big.groupBy("u").agg(F.min("v").alias("m"))
        nxt = (big.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(low2.select("u", F.col("m").alias("v"))).distinct())
        nxt = saved(nxt, "cc")
        # Done when no id is both a child and a parent and every child has one parent.
        kids = nxt.groupBy("u").agg(F.count("*").alias("n"))
        more = kids.where("n > 1").select("u").union(nxt.join(nxt.select(F.col("u").alias("p")).distinct(), F.col("v") == F.col("p"), "left_semi").select("u"))
        e = nxt
        if more.isEmpty():
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
