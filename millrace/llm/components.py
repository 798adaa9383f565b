"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove_scratch, write_step


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node tells its larger neighbours the smallest node it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (both.where("b > a").join(least, "a").where("b != least")
            .select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) to (node, root): every node that is in a link and is no root.

    The root is the smallest node of its component. Each round is written to the shared folder, so a
    lost executor costs a round at most, and removed when the next one is there; the number of rounds grows with the logarithm of the
    number of nodes. A node with many links is combined in the map tasks, and its joins are split by AQE.
    Links of a node with itself, repeated links and nulls have no effect.
    """
    spark = links.sparkSession
    edges, path = write_step(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).alias("mark")
    before = None
    while True:
        now = edges.agg(mark).first()["mark"]
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, old = now, path
        edges, path = write_step(_small_star(_large_star(edges).distinct()).distinct(), "links")
        remove_scratch(spark, old)
