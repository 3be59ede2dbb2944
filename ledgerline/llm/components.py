"""Connected components of an edge table, by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpoint


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """edges (a long, b long) -> (node, root): every node of an edge with the least node of its component.

    Each round is checkpointed in the shared folder and compared with the last by count and hash sums, computed in
    Spark; links and components never come to the driver. No edges: no rows. Loops and repeated edges do no harm. The number
    of rounds grows with the logarithm of the longest chain; a chain that is not done after most_rounds raises an error, no
    result is left unfinished.
    """
    now = checkpoint(edges.select("a", "b").filter("a <> b").distinct())
    told = None
    for _ in range(most_rounds):
        now = checkpoint(_small_star(_large_star(now)))
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h"), F.sum(F.hash("b", "a").cast("long")).alias("g")).first()
        if mark == told:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        told = mark
    raise RuntimeError("components did not settle")
