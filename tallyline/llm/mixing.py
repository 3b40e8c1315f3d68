"""Mixing sources to target weights.

Sources share the words of the corpus in proportion to their weights; no
source gets more than ``MAX_EPOCHS`` times its own words, and what it cannot
take is shared among the others by weight.  Within a source the documents are
put into a hash-random order, a distributed prefix sum of their sizes is built
and the order is cut at the source's exact budget: a budget of 2.3 times the
source's words takes every document twice and the first documents of the order
once more, up to the very word at which the budget ends.

The prefix sum has two levels: the random keys of a source are cut into equal
ranges (``BUCKET_ROWS`` rows each on average, so a source with a third of all
rows becomes many ranges), the ranges' totals are summed up in order, and the
rows are summed up within their range.  No task holds a whole source.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, last in the order of the weights; documents
that tie in key, id and size are interchangeable; an empty table gives an
empty table; further columns are ignored by ``mix`` and kept by ``apply``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BUCKET_ROWS = 2048


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """src, source_size, n_docs, target of every source; one row per source.

    ``sized`` has the columns src (struct of null flag and source) and size.
    The weights repeat along the order of the sources.  The final shares are
    those of the reshared excess: every source gets min(cap, level * weight)
    for the one level at which the shares sum up to the corpus.  In the order
    of cap / weight the level is found by running sums over the sources (one
    row each, after an aggregation)."""
    per = sized.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy("src")
    cases = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", cases).withColumn("cap", F.col("source_size") * float(max_epochs)).withColumn("full_at", F.col("cap") / F.col("w"))
    everything = Window.partitionBy()
    before = Window.orderBy("full_at", "src").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    # The level when all sources before this one are at their cap; the first
    # source that stays under its cap gives the final one.
    levels = per.withColumn("level", rest / left).withColumn("open", F.col("level") <= F.col("full_at"))
    final = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        Window.orderBy("full_at", "src").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("target", F.least(F.col("cap"), F.coalesce(final, F.lit(0.0)) * F.col("w"))).select(
        "src", "source_size", "n_docs", "target")


def _place(rows: DataFrame, per: DataFrame) -> DataFrame:
    """``rows`` (doc_id, src, size, u and more) plus the columns of ``per`` and ``taken``."""
    ranges = F.ceil(F.col("n_docs") / F.lit(float(BUCKET_ROWS)))
    rows = rows.join(per, "src").withColumn("range", F.floor(F.col("u") * ranges))
    totals = rows.groupBy("src", "range").agg(F.sum("size").alias("range_size"))
    before = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("src", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("range_start"))
    within = Window.partitionBy("src", "range").orderBy("u", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inner_start", F.coalesce(F.sum("size").over(within), F.lit(0))).join(starts, ["src", "range"])
    placed = placed.withColumn("budget", F.round("target").cast("long")).withColumn(
        "epochs", F.expr("CASE WHEN source_size > 0 THEN budget div source_size ELSE 0L END"))
    over = F.col("budget") - F.col("epochs") * F.col("source_size") - F.col("range_start") - F.col("inner_start")
    return placed.withColumn("taken", F.col("epochs") * F.col("size") + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), over)))


def _uniform(seed: int) -> Column:
    """A uniform number in [0, 1) from 48 bits of the MD5 of seed and id."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def _source() -> Column:
    return F.struct(F.col("source").isNull().alias("none"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"))


def mix(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 7) -> DataFrame:
    """doc_id, size, source, source_size, target and taken of every row."""
    sized = written(docs.select("doc_id", _source().alias("src"), word_count(F.col("text")).alias("size"), _uniform(seed).alias("u")), "mix-sizes")
    per = written(targets(sized, weights, max_epochs), "mix-targets")
    return _place(sized, per).select("doc_id", "size", F.when(~F.col("src.none"), F.col("src.name")).alias("source"),
                                     "source_size", "target", "taken")


def apply(docs: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 7) -> DataFrame:
    """``docs`` as the mix takes them, with their own columns: a row per copy
    taken, the text of a source's last copy cut after the budget's last word."""
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = docs.select("doc_id", _source().alias("src"), word_count(F.col("text")).alias("size"), _uniform(seed).alias("u"), own)
    sized = written(rows.drop("own"), "mix-sizes")
    per = written(targets(sized, weights, max_epochs), "mix-targets")
    taken = _place(rows, per).filter("taken > 0")
    copies = taken.select("own", "size", F.explode(F.transform(
        F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1),
        lambda k: F.least(F.col("size"), F.col("taken") - k * F.col("size")))).alias("n"))
    n = F.col("n").cast("int")
    gaps, found = F.split("own.text", WORD), F.regexp_extract_all(F.col("own.text"), F.lit(WORD), F.lit(0))
    cut = F.array_join(F.zip_with(F.slice(gaps, F.lit(1), n), F.slice(found, F.lit(1), n), lambda g, w: F.concat(g, w)), "")
    text = F.when(F.col("n") < F.col("size"), cut).otherwise(F.col("own.text"))
    return copies.select(*[(text if c == "text" else F.col(f"own.`{c}`")).alias(c) for c in docs.columns])
