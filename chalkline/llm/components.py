"""Connected components of a table of links, by alternating large-star and small-star rounds.

Every round keeps connectivity and moves links towards a star around each component's smallest
node; rounds end when the table of links is a fixed point. Tables of a round are written to the
shared folder, so joins read plain scans (which adaptive execution can split where one node has
many links), and lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, session, written


def _print(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def _large_star(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), least


def _small_star(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    least = written(links.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), least


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that a link names; root is its component's smallest node.

    Links with a null end or both ends the same are ignored; repeated links do no harm; an
    empty table gives no rows. Ids are long.
    """
    spark = session(links)
    ends = links.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x <> y")
    now = written(ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")
    seen = _print(now)
    while True:
        large, least_large = _large_star(now)
        large = written(large, "links")
        small, least_small = _small_star(large)
        small = written(small, "links")
        remove(spark, now, large, least_large, least_small)
        now, before, seen = small, seen, _print(small)
        if seen == before:
            break
    # each node but a root has one link now, to its root
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
