"""Connected components of links between 64-bit ids, by stars that are joined round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.runtime import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b) that has another: root is its component's least id.

    Each round hangs a node's larger neighbours on its least one, then what is left on the least. Rounds
    grow with the logarithm of the longest chain; each is written, so that lost executors cost one round.
    """
    now = materialise(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))).first()
        if state == seen or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e")
        )
        now = materialise(small.select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a != b").distinct(), "links")
