"""Connected components of a graph that is larger than one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebeam.session import discard, materialize, scratch_path


def _written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that has an edge: root is the smallest node reachable.

    `edges` has columns a and b. Alternating stars (Kiveris et al. 2014): each round hangs larger
    neighbours, then smaller ones, below the smallest neighbour, until nothing changes; that takes
    about the logarithm of the longest path. Minima are aggregated before the shuffle, so a node
    with a third of all edges is one number per task; joins on it are split by AQE. Each round is
    written to the shared folder, so a lost executor costs one round at most.
    """
    now, path = _written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .distinct(), "edges")
    state = None
    while True:
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.filter("a > m").select("a", F.col("m").alias("b"))).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        after, written = _written(small, "edges")
        discard(now.sparkSession, path)
        now, path = after, written
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
                       F.bit_xor(F.xxhash64("b", "a"))).first()
        if seen == state:
            break
        state = seen
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return materialize(roots.union(roots.select(F.col("root").alias("node"), "root").distinct()).distinct(), "roots")
