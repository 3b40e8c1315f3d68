"""Connected components of links by alternating large-star and small-star steps.

Edges stay in tables: a step is an aggregation (smallest neighbour of every
node) and a join back, so a node with very many links is combined map-side and
its join partition can be split by adaptive execution.  Every round is written
to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, reread, write


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node that has a
    link; ``edges`` has the columns a and b.  Links to oneself are ignored."""
    spark = edges.sparkSession
    e = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b").distinct()
    path = write(e, "links")
    schema = e.schema
    while True:
        e = reread(spark, path, schema)
        new = write(_small_star(_large_star(e)), "links")
        discard(spark, path)
        path, e = new, reread(spark, new, schema)
        ends = e.select(F.col("a").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionByName(
            e.select(F.col("b").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("root")))
        open_ = ends.groupBy("n").agg(F.sum("child").alias("c"), F.max("root").alias("r")).filter("c > 1 or (c = 1 and r = 1)")
        if open_.isEmpty():                    # a forest of stars: every node hangs on its root alone
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
