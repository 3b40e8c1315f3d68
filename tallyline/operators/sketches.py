"""Distinct counts that merge: one sketch per month, stored, united for any range.

Exact distinct counts over a range need all its rows again.  A HyperLogLog sketch
(Spark's own functions) holds a month in a few kilobytes, and the union of sketches
is the sketch of the union in any order.  The relative standard error is about
1.04 / sqrt(2^lg_k); ``error_bound`` is three of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import read_table, write_table

LG_K = 14


def error_bound(lg_k: int = LG_K) -> float:
    return 3 * 1.04 / 2 ** (lg_k / 2)


def monthly_sketches(df: DataFrame, date: str, value: str, lg_k: int = LG_K) -> DataFrame:
    """month (its first day), sketch of the distinct values."""
    return df.groupBy(F.trunc(date, "month").alias("month")).agg(F.hll_sketch_agg(F.col(value), F.lit(lg_k)).alias("sketch"))


def estimate(sketches: DataFrame, *by) -> DataFrame:
    """``by`` and ``estimate``: the distinct values of all sketches of a group."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch", F.lit(False))).alias("estimate"))


def yearly_customers(txns: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """year, customers (the exact count), within_bound: whether the estimate of the
    stored monthly sketches is within the stated error of it."""
    stored = read_table(txns.sparkSession, write_table(monthly_sketches(txns.filter("txn_date is not null"), "txn_date", "customer_id", lg_k), "sketches"))
    near = estimate(stored, F.year("month").alias("year"))
    exact = txns.filter("txn_date is not null").groupBy(F.year("txn_date").alias("year")).agg(F.count_distinct("customer_id").alias("customers"))
    off = F.abs(F.col("estimate") - F.col("customers"))
    return exact.join(near, "year").select("year", "customers", (off <= F.ceil(F.col("customers") * error_bound(lg_k))).alias("within_bound")).orderBy("year")
