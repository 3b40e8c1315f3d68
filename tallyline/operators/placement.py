"""Node placement history: node counts, region counts, reallocation gaps and
their percentiles.

Input ``nodes``: customer_id, region_id, node_id, start_date (one row per
stint); ``regions``: region_id, region_name.

Scale notes: counts are reduced per region before the region join; the gap
metric first reduces stints to one first-visit row per (customer, region,
node), so the per-customer window sorts at most one row per node visited.
Percentiles are exact (``percentile`` keeps a value->count map per group,
merged partially), so a region holding a third of all rows is combined from
per-task maps of distinct day gaps, not sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparts import seconds
from .quantiles import exact_quantiles


def distinct_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.countDistinct("node_id").alias("unique_nodes"))


def nodes_per_region(nodes: DataFrame, regions: DataFrame, distinct: bool = True) -> DataFrame:
    """Nodes per region: distinct nodes (the question), or every stint row
    (``distinct=False``, as written)."""
    agg = F.countDistinct("node_id") if distinct else F.count("node_id")
    per = nodes.groupBy("region_id").agg(agg.alias("nodes"))
    return per.join(regions, "region_id").select("region_id", "region_name", "nodes").orderBy("region_id")


def customers_per_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    per = nodes.groupBy("region_id").agg(F.countDistinct("customer_id").alias("customers"))
    return per.join(regions, "region_id").select("region_id", "region_name", "customers").orderBy("region_id")


def reallocation_gaps(nodes: DataFrame) -> DataFrame:
    """Days between a customer's first visits of successive distinct nodes
    (returns to a node are collapsed into its first visit).  Visits on the same
    day are ordered by node id; the multiset of gaps does not depend on it."""
    first = nodes.groupBy("customer_id", "region_id", "node_id").agg(F.min("start_date").alias("first_date"))
    w = Window.partitionBy("customer_id").orderBy("first_date", "node_id")
    return first.withColumn("moving_days", F.datediff(F.lead("first_date").over(w), F.col("first_date")))


def reallocation_seconds(moves: DataFrame) -> DataFrame:
    """The same gaps to the second, of rows customer_id, region_id, node_id, moved_at
    (a local timestamp): ``moving_seconds`` between the whole seconds of two visits."""
    first = moves.groupBy("customer_id", "region_id", "node_id").agg(F.min("moved_at").alias("first_at"))
    w = Window.partitionBy("customer_id").orderBy("first_at", "node_id")
    at = seconds("first_at")
    return first.withColumn("moving_seconds", F.lead(at).over(w) - at)


STINT_CHUNK = 1_000_000


def stint_gaps(nodes: DataFrame, chunk: int = STINT_CHUNK) -> DataFrame:
    """Per-stint reading: days from the start of each run of consecutive
    stints on one node to the start of the customer's next run (stints are
    ordered by (start_date, stint_id)).

    Computed in two levels so that no window holds a whole customer: stints
    fall into ordered *blocks* (customer, day, stint_id div ``chunk``);
    windows keyed by a block order its stints, and windows keyed by customer
    run over one row per block (about one per active day).
    """
    n = nodes.select("customer_id", "node_id", "start_date", "stint_id",
                     F.floor(F.col("stint_id") / F.lit(chunk)).cast("bigint").alias("block"))
    blk = ["customer_id", "start_date", "block"]
    in_blk = Window.partitionBy(*blk).orderBy("stint_id")
    whole_blk = in_blk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one pass over the stints: previous node inside the block, last node of the block
    # (max_by, not last(): deterministic expressions let Spark reuse the shared exchange)
    s = n.select("*", F.lag("node_id").over(in_blk).alias("prev_in_block"),
                 F.max_by("node_id", "stint_id").over(whole_blk).alias("block_last"))
    by_blk = Window.partitionBy("customer_id").orderBy("start_date", "block")
    blocks = s.groupBy(*blk).agg(F.max("block_last").alias("block_last")) \
              .select(*blk, F.lag("block_last").over(by_blk).alias("prev_block_last"))
    s = s.join(blocks, blk)
    starts_run = F.when(F.col("prev_in_block").isNull(),
                        F.col("prev_block_last").isNull() | (F.col("prev_block_last") != F.col("node_id"))) \
                  .otherwise(F.col("prev_in_block") != F.col("node_id"))
    starts = s.filter(starts_run).withColumn("later_in_block", F.lead("stint_id").over(in_blk))
    run_blocks = starts.groupBy(*blk).agg(F.count("*").alias("n_starts")) \
                       .select(*blk, F.lead("start_date").over(by_blk).alias("next_date"))
    j = starts.join(run_blocks, blk)
    gap = F.when(F.col("later_in_block").isNotNull(), F.lit(0)).otherwise(F.datediff("next_date", "start_date"))
    return j.withColumn("moving_days", gap)


def realloc_avg(nodes: DataFrame, per_stint: bool = False) -> DataFrame:
    gaps = stint_gaps(nodes) if per_stint else reallocation_gaps(nodes)
    return gaps.agg(F.round(F.avg(F.col("moving_days").cast("double")), 0).alias("avg_moving_days"))


PCT_NAMES = {0.5: "median", 0.8: "percentile_80", 0.95: "percentile_95"}


def realloc_percentiles(nodes: DataFrame, regions: DataFrame,
                        ps: Sequence[float] = (0.5, 0.8, 0.95), exact: bool = True,
                        accuracy: int = 10000) -> DataFrame:
    """Percentiles of the gap per region: exact and linearly interpolated
    (PERCENTILE_CONT), or with ``exact=False`` the bounded-memory
    ``approx_percentile`` (returns an observed value, no interpolation)."""
    gaps = reallocation_gaps(nodes).filter(F.col("moving_days").isNotNull())

    def pct(p: float):
        if exact:
            return F.percentile(F.col("moving_days"), F.lit(p))
        return F.approx_percentile(F.col("moving_days"), p, accuracy).cast("double")

    cols = [PCT_NAMES.get(p, "p" + f"{Decimal(str(float(p))) * 100:f}".rstrip("0").rstrip(".").replace(".", "_")) for p in ps]
    per = gaps.groupBy("region_id").agg(*[pct(p).alias(n) for p, n in zip(ps, cols)])
    return per.join(regions, "region_id").select("region_id", "region_name", *cols).orderBy("region_id")


def realloc_second_percentiles(moves: DataFrame, regions: DataFrame, ps: Sequence[float] = (0.5, 0.8, 0.95)) -> DataFrame:
    """Exact percentiles per region of gaps to the second, whose values are nearly
    all distinct: by rank selection, without a map of a region's values."""
    names = [PCT_NAMES.get(p, f"p{p}") for p in ps]
    gaps = reallocation_seconds(moves).filter("moving_seconds is not null")
    per = exact_quantiles(gaps, ["region_id"], "moving_seconds", ps, names)
    return per.join(regions, "region_id").select("region_id", "region_name", *names).orderBy("region_id")
