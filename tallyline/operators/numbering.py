"""Identity columns that follow an order, over a whole table or within keys.

Rows are put into ranges of (keys, order, all other columns), so the ranges follow
the order and a key with very many rows spans several of them.  The ranges' sizes
are summed up in order (one row per range and key) and a row's id is the sum
before its range plus its place within it.  No task holds more than a range, no
window runs over a whole table or key, and ids do not depend on how many ranges
there are.  A number of ``ranges`` in proportion to the rows keeps them small at any
size; without one the session's partitions decide.

Identical rows are counted first and regenerated with consecutive ids, so a row
that is repeated very often does not fill a range either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import read_table, write_table

CHUNK = 100_000        # ids of one identical row that are generated at a time


def _in_ranges(df: DataFrame, by: list[str], ranges: int | None) -> DataFrame:
    """The distinct rows with their count ``_n`` and the number ``_range`` of their
    range; written, so that every use sees the same ranges."""
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    rows = rows.repartitionByRange(ranges, *by) if ranges else rows.repartitionByRange(*by)
    rows = read_table(df.sparkSession, write_table(rows.withColumn("_range", F.spark_partition_id()), "ranges"))
    return rows.repartitionByRange(ranges, "_range") if ranges else rows        # a range or two in a task


def _expanded(rows: DataFrame, columns: list[str], out: str) -> DataFrame:
    """A row per copy: ids ``_first`` to ``_first + _n - 1``."""
    chunks = rows.select(*columns, "_first", "_n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"div(_n - 1, {CHUNK})"))).alias("_chunk"))
    lo = F.col("_first") + F.col("_chunk") * CHUNK
    return chunks.select(*columns, F.explode(F.sequence(lo, F.least(F.col("_first") + F.col("_n") - 1, lo + CHUNK - 1))).alias(out))


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str, ranges: int | None = None) -> DataFrame:
    """``df`` with the ids 1, 2, 3, ... within ``keys``, in the order of ``order``
    and then of the other columns (identical rows are interchangeable)."""
    by = [*keys, *order, *[c for c in df.columns if c not in (*keys, *order)]]
    rows = _in_ranges(df, by, ranges)
    one = [*keys, "_range"]
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(*one).agg(F.sum("_n").alias("_size")).select(*one, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    # Only keys that span ranges need an offset, fewer than there are ranges; null keys are keys, too.
    sizes = sizes.filter("_before > 0").select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(one)], "_before")
    same = F.lit(True)
    for i, c in enumerate(one):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    inside = Window.partitionBy(*one).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(sizes), same, "left")
    return _expanded(rows.withColumn("_first", F.coalesce("_before", F.lit(0)) + F.col("_in") + 1), df.columns, out)


def with_global_ids(df: DataFrame, order: list[str], out: str, ranges: int | None = None) -> DataFrame:
    """``df`` with the ids 1 to n over the whole table, in the order of ``order`` and
    then of the other columns.  The sizes of the ranges (one number each) are added
    up on the driver, so no window is without keys."""
    by = [*order, *[c for c in df.columns if c not in order]]
    rows = _in_ranges(df, by, ranges)
    before, offsets = 0, []
    for r in rows.groupBy("_range").agg(F.sum("_n").alias("n")).orderBy("_range").collect():
        offsets.append((r["_range"], before))
        before += r["n"]
    offset = df.sparkSession.createDataFrame(offsets, "_range int, _before bigint")
    inside = Window.partitionBy("_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(offset), "_range")
    return _expanded(rows.withColumn("_first", F.col("_before") + F.col("_in") + 1), df.columns, out)
