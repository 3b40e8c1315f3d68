"""Ledger metrics: type summaries, deposit averages, active customers,
month-end closing balances, balance growth, running balances.

Input ``txns``: customer_id, txn_id, txn_date (DATE), txn_type, txn_amount
(integer money; debits are 'withdrawal' and 'purchase', every other type is a
credit).  ``txn_id`` breaks ties between transactions of one day.

Scale notes:
* Month-end balances never build a customers x calendar join.  Transactions
  are first summed per (customer, month) (map-side combine), then each
  customer's monthly nets -- at most one per calendar month -- become one map,
  and the dense month grid is generated per customer with ``sequence`` from
  the global bounds (scalar subqueries).  A customer with a third of all rows
  still contributes only one row per month after the first aggregation.
* Running balances are computed in two levels over ordered blocks
  (customer, day, txn_id range): block totals give each block's opening
  balance (a window over about one row per active day), and the running sum
  inside a block is a window keyed by the block.  No window partition holds a
  whole customer's (or a whole day's) transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clean as C
from .orders import int_avg


def signed(txns: DataFrame) -> Column:
    return C.signed_amount("txn_type", "txn_amount")


def txn_summary(txns: DataFrame) -> DataFrame:
    """Rows and amount per type; types compare without case and outer blanks."""
    return txns.groupBy(C.norm_text("txn_type").alias("txn_type")).agg(F.count("*").alias("unique_count"),
                                        F.sum("txn_amount").cast("bigint").alias("total_amount"))


def deposit_averages(txns: DataFrame) -> DataFrame:
    """Integer averages over customers of their deposit count and amount."""
    dep = txns.filter(C.norm_text("txn_type") == "deposit").groupBy("customer_id").agg(
        F.count("*").alias("dep_count"), F.sum("txn_amount").alias("dep_amount"))
    return dep.agg(int_avg("dep_count").alias("avg_dep_count"), int_avg("dep_amount").alias("avg_dep_amount"))


def active_customers(txns: DataFrame, as_written: bool = False) -> DataFrame:
    """Customers per month with more than one deposit and at least one
    purchase or withdrawal in that month.

    Default: calendar months (first day of the month).  ``as_written``: month
    of year (years merge) and the deposit / purchase conditions inverted
    (non-deposits and non-purchases are counted).
    """
    t = C.norm_text("txn_type")     # type names compare case-insensitively
    if as_written:
        month = F.month("txn_date")
        dep = F.when(t == "deposit", 0).otherwise(1)
        pur = F.when(t == "purchase", 0).otherwise(1)
    else:
        month = F.trunc("txn_date", "month")
        dep = F.when(t == "deposit", 1).otherwise(0)
        pur = F.when(t == "purchase", 1).otherwise(0)
    wd = F.when(t == "withdrawal", 1).otherwise(0)
    per = txns.groupBy("customer_id", month.alias("month")).agg(
        F.sum(dep).alias("deposit_count"), F.sum(pur).alias("purchase_count"), F.sum(wd).alias("withdrawal_count"))
    ok = (F.col("deposit_count") > 1) & ((F.col("purchase_count") >= 1) | (F.col("withdrawal_count") >= 1))
    # (customer, month) is unique after the first aggregation: count(*) = count(distinct customer)
    return per.filter(ok).groupBy("month").agg(F.count("*").alias("customer_count")).orderBy("month")


def monthly_net(txns: DataFrame) -> DataFrame:
    return txns.groupBy("customer_id", F.last_day("txn_date").alias("end_date")).agg(
        F.sum(signed(txns)).cast("bigint").alias("net"))


MAX_YEAR = 2199    # a grid beyond it comes from a sentinel date such as 9999-12-31


def month_bounds(txns: DataFrame, start: str | None = None, end: str | None = None) -> tuple[Column, Column]:
    """First and last month start of the grid: the data's first and last
    transaction months (one scalar subquery for both) unless fixed dates are
    given.  A last month after ``MAX_YEAR`` is an error, since every customer
    would get a row for each of its months."""
    both = txns.agg(F.struct(F.min("txn_date").alias("lo"), F.max("txn_date").alias("hi")).alias("b")).scalar()
    lo = F.lit(start).cast("date") if start else both["lo"]
    hi = F.lit(end).cast("date") if end else both["hi"]
    hi = F.when(F.year(hi) > MAX_YEAR, F.raise_error(F.lit(f"the month grid would run beyond {MAX_YEAR}: give an end date"))).otherwise(hi)
    return F.trunc(lo, "month"), F.trunc(hi, "month")


def monthly_grid(txns: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """customer_id, end_date, net (NULL in months without transactions) for
    every customer and every month from the start to the last month."""
    nets = monthly_net(txns)
    per_cust = nets.groupBy("customer_id").agg(
        F.map_from_entries(F.collect_list(F.struct("end_date", "net"))).alias("m"))
    lo, hi = month_bounds(txns, start, end)
    grid = per_cust.select("customer_id", "m",
                           F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    end = F.last_day("month_start")
    return grid.select("customer_id", end.alias("end_date"), F.try_element_at("m", end).alias("net"))


def closing_balance(txns: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Month-end closing balance per customer over a dense month grid.

    ``transactions`` is the month's net (0 when none); ``closing_balance`` is
    the running sum of the month nets, NULL before the customer's first
    transaction month (as a running SUM over NULLs is NULL).  ``start`` /
    ``end`` fix the first / last month of the grid (default: the data's).
    """
    w = Window.partitionBy("customer_id").orderBy("end_date").rowsBetween(Window.unboundedPreceding, 0)
    g = monthly_grid(txns, start, end)
    return g.select("customer_id", "end_date",
                    F.coalesce("net", F.lit(0)).cast("bigint").alias("transactions"),
                    F.sum("net").over(w).cast("bigint").alias("closing_balance"))


def growth_pct(txns: DataFrame, threshold: float = 5.0, use_abs: bool = False,
               start: str | None = None) -> DataFrame:
    """Percent of customers whose closing balance rises by more than
    ``threshold`` percent from one month to the next in at least one month.

    The change is 100*(next - cur)/cur (``use_abs``: divided by |cur|, so a
    negative base does not flip the sign); months with a zero or NULL base are
    skipped.  The denominator is every customer with a transaction.
    """
    cb = closing_balance(txns, start)
    w = Window.partitionBy("customer_id").orderBy("end_date")
    cur, nxt = F.col("closing_balance"), F.col("next_balance")
    base = F.abs(cur) if use_abs else cur
    pct = F.lit(100.0) * (nxt - cur).cast("double") / base.cast("double")
    rows = cb.withColumn("next_balance", F.lead("closing_balance").over(w))
    valid = (cur != 0) & nxt.isNotNull()
    per_cust = rows.groupBy("customer_id").agg(F.max(F.when(valid, pct > threshold)).alias("grew"))
    return per_cust.agg((F.lit(100.0) * F.sum(F.when(F.col("grew"), 1).otherwise(0)).cast("double")
                         / F.count("*").cast("double")).alias("pct_customers"))


RUN_CHUNK = 1_000_000


def running_balance(txns: DataFrame, chunk: int = RUN_CHUNK) -> DataFrame:
    """Balance after each transaction, ordered by (date, txn_id) per customer.

    Two levels, split by ordered ranges so that no window partition is large:
    a *block* is (customer, day, txn_id div ``chunk``) -- it holds at most
    ``chunk`` transactions and blocks follow the transaction order.  Block
    nets (map-side combined) give each block's opening balance through a
    per-customer window over blocks (about one row per active day); the
    running sum inside a block is a window keyed by the block.
    """
    s = txns.withColumn("signed_amount", signed(txns)) \
            .withColumn("block", F.floor(F.col("txn_id") / F.lit(chunk)).cast("bigint"))
    blk = ["customer_id", "txn_date", "block"]
    nets = s.groupBy(*blk).agg(F.sum("signed_amount").alias("block_net"))
    wb = Window.partitionBy("customer_id").orderBy("txn_date", "block") \
               .rowsBetween(Window.unboundedPreceding, -1)
    offsets = nets.select(*blk, F.coalesce(F.sum("block_net").over(wb), F.lit(0)).alias("opening"))
    wi = Window.partitionBy(*blk).orderBy("txn_id").rowsBetween(Window.unboundedPreceding, 0)
    intra = s.withColumn("in_block", F.sum("signed_amount").over(wi))
    return intra.join(offsets, blk).select(
        "customer_id", "txn_id", "txn_date", "txn_type", "txn_amount",
        (F.col("opening") + F.col("in_block")).cast("bigint").alias("running_balance"))


def month_summary(txns: DataFrame, chunk: int = RUN_CHUNK) -> DataFrame:
    """customer_id, month, net, top, first, last of the months with transactions:
    the month's sum, the highest of its running sums in the order (date, txn_id),
    and the places (date, txn_id) of its first and last transaction.

    Two summaries of adjoining stretches combine: net = net1 + net2 and
    top = max(top1, net1 + top2).  The blocks of ``running_balance`` are summed up
    this way, so no offset is joined back to the rows."""
    place = F.struct("txn_date", "txn_id")
    s = txns.withColumn("signed_amount", signed(txns)).withColumn("block", F.floor(F.col("txn_id") / F.lit(chunk)).cast("bigint"))
    blk = ["customer_id", "txn_date", "block"]
    inside = Window.partitionBy(*blk).orderBy("txn_id").rowsBetween(Window.unboundedPreceding, 0)
    blocks = s.withColumn("_run", F.sum("signed_amount").over(inside)).groupBy(*blk).agg(
        F.sum("signed_amount").alias("net"), F.max("_run").alias("top"), F.min(place).alias("first"), F.max(place).alias("last"))
    before = Window.partitionBy("customer_id", "month").orderBy("txn_date", "block").rowsBetween(Window.unboundedPreceding, -1)
    rows = blocks.withColumn("month", F.last_day("txn_date"))
    rows = rows.withColumn("top", F.coalesce(F.sum("net").over(before), F.lit(0)) + F.col("top"))
    return rows.groupBy("customer_id", "month").agg(
        F.sum("net").cast("bigint").alias("net"), F.max("top").cast("bigint").alias("top"), F.min("first").alias("first"), F.max("last").alias("last"))


def summary_peaks(summaries: DataFrame) -> DataFrame:
    """customer_id, month, peak, balance of month summaries: the highest balance
    of the month, the one carried in included, and the last one."""
    w = Window.partitionBy("customer_id").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.sum("net").over(w), F.lit(0))
    return summaries.select("customer_id", "month", (carried + F.greatest("top", F.lit(0))).cast("bigint").alias("peak"),
                            (carried + F.col("net")).cast("bigint").alias("balance"))


def balance_stats(txns: DataFrame) -> DataFrame:
    rb = running_balance(txns)
    return rb.groupBy("customer_id").agg(F.min("running_balance").alias("min_balance"),
                                         F.avg("running_balance").alias("avg_balance"),
                                         F.max("running_balance").alias("max_balance"))
