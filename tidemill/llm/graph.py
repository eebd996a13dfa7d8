"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import cut, drop


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b: comparable, not null): root is the smallest node of its component.

    Alternating large-star and small-star steps. Each keeps components, and each writes its links to shared storage, so no plan
    grows and no link comes to the driver; only a count and a checksum do, to see that nothing changed. A round that changes nothing comes after
    about log squared of the longest path, so none is set as the last. A node of very many links has its minimum made by partial aggregation,
    and its joins may be split by the engine. The result is a table of its own; those of the rounds are deleted.
    """
    links = cut(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), codec="snappy")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0))).first())

    before = mark(links)
    while before[0]:
        # large star: every larger neighbour of a node goes to the node's smallest neighbour (or itself)
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a < b").distinct()
        # small star: every smaller neighbour of a node, and the node, go to the smallest
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.explode(F.array("a", "b")).alias("b"), F.col("m").alias("a")).where("a < b").distinct()
        done, links = links, cut(small.select("a", "b"), codec="snappy")
        drop(done)
        after = mark(links)
        if after == before:
            break
        before = after
    stars = links.groupBy("b").agg(F.min("a").alias("root")).withColumnRenamed("b", "node")
    out = cut(stars.unionByName(links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()), codec="snappy")
    drop(links)
    return out
