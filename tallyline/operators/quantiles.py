"""Exact percentiles of many distinct values by rank selection.

Spark's exact ``percentile`` keeps a map of all values of a group in one task.
Here the ranks that a percentile lies between are found by refining histograms:
the interval known to hold a rank is cut into equal buckets, the group's values in
each bucket are counted (map-side first, so a group is at most a bucket count per
task), and the interval becomes the one bucket that holds the rank.  Every round
divides the interval by the number of buckets, so 64-bit values take at most seven
rounds of 1,024 and second-level gaps of a few years three.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import read_table, remove, write_table

BUCKETS = 1024


def _same(keys: list[str], suffix: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(k + suffix))
    return out


def _narrowed(values: DataFrame, targets: DataFrame, group: list[str], buckets: int) -> DataFrame:
    """One round: every target's interval [lo, hi] becomes one of its buckets.
    Targets of one interval share its counts."""
    step = F.expr(f"div(hi - lo, {buckets}) + 1")
    interval = targets.filter("hi > lo").select(*[F.col(k).alias(f"{k}_i") for k in group], "lo", "hi", step.alias("step")).distinct()
    inside = values.join(interval, _same(group, "_i") & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
    counts = inside.groupBy(*group, "lo", "step", F.expr("div(v - lo, step)").alias("bucket")).agg(F.count("*").alias("here"))
    before = Window.partitionBy(*group, "lo").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)     # one row per bucket
    counts = counts.withColumn("earlier", F.coalesce(F.sum("here").over(before), F.lit(0))).select(
        *[F.col(k).alias(f"{k}_c") for k in group], F.col("lo").alias("lo_c"), "step", "bucket", "here", "earlier")
    at = F.col("rank") - F.col("below")
    found = targets.join(counts, _same(group, "_c") & (F.col("lo") == F.col("lo_c")) & (at >= F.col("earlier")) & (at < F.col("earlier") + F.col("here")), "left")
    low = F.col("lo") + F.col("bucket") * F.col("step")
    return found.select(*group, "rank", F.coalesce(low, "lo").alias("lo"), F.coalesce(F.least(low + F.col("step") - 1, "hi"), "hi").alias("hi"),
                        (F.col("below") + F.coalesce("earlier", F.lit(0))).alias("below"))


def exact_quantiles(df: DataFrame, group: list[str], value: str, ps: Sequence[float], names: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """``group`` and a column per percentile, linearly interpolated between the two
    ranks around it (PERCENTILE_CONT).  ``value`` is a whole number between -2^62 and
    2^62; nulls do not count, a group of nulls has no row."""
    spark = df.sparkSession
    values_at = write_table(df.select(*group, F.col(value).cast("bigint").alias("v")).filter("v is not null"), "values")
    values = read_table(spark, values_at)
    stats = values.groupBy(*group).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    place = lambda p: (F.col("n") - 1).cast("double") * F.lit(float(p))
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(p)).cast("bigint"), F.ceil(place(p)).cast("bigint")) for p in ps])))
    path = write_table(stats.select(*group, F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("bigint").alias("below")), "ranks")
    sizes = read_table(spark, write_table(stats.select(*group, "n"), "sizes"))
    while not read_table(spark, path).filter("hi > lo").isEmpty():
        new = write_table(_narrowed(values, read_table(spark, path), group, buckets), "ranks")
        remove(spark, path)
        path = new
    remove(spark, values_at)
    found = read_table(spark, path).groupBy(*group).agg(F.map_from_entries(F.collect_list(F.struct("rank", "lo"))).alias("_at"))   # two ranks a percentile
    rows = sizes.join(found.select(*[F.col(k).alias(f"{k}_f") for k in group], "_at"), _same(group, "_f"))

    def at(p: float) -> Column:
        lo = F.element_at("_at", F.floor(place(p)).cast("bigint")).cast("double")
        hi = F.element_at("_at", F.ceil(place(p)).cast("bigint")).cast("double")
        return lo + (hi - lo) * (place(p) - F.floor(place(p)).cast("double"))

    return rows.select(*group, *[at(p).alias(n) for p, n in zip(ps, names)])
