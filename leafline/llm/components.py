"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm.storage import remove, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node of edges (a, b): the smallest node reachable.

    Alternating star contraction: each round hangs nodes on the smallest neighbour known, so the number of rounds
    grows with the logarithm of the number of nodes. Each round is a written table. Loops and repeated edges are
    ignored; an empty table gives no rows.
    """
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        star = large.join(small, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b"))).distinct()
        after = written(star, "edges")
        mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        done = mark(now) == mark(after)
        remove(now)
        now = after
        if done:
            break
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
