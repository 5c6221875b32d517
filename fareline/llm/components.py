"""Connected components of an edge table, by alternating star contractions in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.session import scratch_path


def connected_components(spark: SparkSession, edges: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; any order, loops and repeats allowed).

    ``root`` is the smallest node of the component; an empty table gives no rows. Each round hangs
    the larger neighbours of a node on its smallest neighbour, then the smaller ones; the number of
    edges never grows, and the stars that remain are the components. Every round's edges are written
    to the shared folder, so a lost executor costs one round at most.
    """
    base, k = scratch_path(spark, "components"), 0

    def stored(df: DataFrame) -> DataFrame:
        nonlocal k
        k += 1
        df.write.parquet(f"{base}/{k}")
        return spark.read.parquet(f"{base}/{k}")

    edges = stored(edges.select("a", "b").filter("a is not null and b is not null"))  # read several times
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("x"), F.col("m")), F.struct(F.col("a").alias("x"), F.col("m")))).alias("e"))
        small = small.select(F.col("e.x").alias("a"), F.col("e.m").alias("b")).filter("a <> b").distinct()
        small = stored(small)
        # done once every node hangs on one root that hangs on nothing
        parents = small.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        open_ = parents.filter("n > 1").limit(1).count() or small.join(parents.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count()
        now = small
        if not open_:
            break
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    return nodes.join(now.withColumnRenamed("a", "node"), "node", "left").select("node", F.coalesce("b", "node").alias("root"))
