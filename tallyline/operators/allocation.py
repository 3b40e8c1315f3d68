"""Storage-allocation estimates from ledger balances.

Options (monthly totals over customers, negative balances floored at 0 when
``floor_at_zero``):
  1. month_end   -- previous month-end closing balance;
  2. trailing30  -- at each month end, the mean of the 30 daily closing
                    balances ending that day (days before the first
                    transaction hold 0);
  3. realtime    -- the peak balance reached in the month, the balance carried
                    into the month included.
Interest options: daily simple interest on each day's closing balance, and
daily compounding.

Scale notes: no customers x days grid is built.  Between two transaction days
a balance is constant, so each customer's history becomes *segments*
(start, end, balance); a segment is expanded only to the months (or month-end
windows) it overlaps and weighted by the overlap in days.  Sums are kept in
exact integer balance-days and divided once at the end.  Compound interest is
linear in the amounts, so the monthly total needs only per-month sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ledger import closing_balance, month_summary, signed, summary_peaks


def _horizon(txns: DataFrame):
    """Last day of the last month with a transaction (scalar subquery)."""
    return F.last_day(txns.agg(F.max("txn_date")).scalar())


def balance_segments(txns: DataFrame, tasks: int | None = None) -> DataFrame:
    """customer_id, seg_start, seg_end, balance: the end-of-day balance held
    from each transaction day up to the day before the next one (the last
    segment runs to the horizon).  With ``tasks``, customers are dealt to that many
    tasks, which what follows by customer keeps."""
    day = txns.groupBy("customer_id", "txn_date").agg(F.sum(signed(txns)).alias("day_net"))
    if tasks:
        day = day.repartition(tasks, "customer_id")
    w = Window.partitionBy("customer_id").orderBy("txn_date")
    return day.select(
        "customer_id", F.col("txn_date").alias("seg_start"),
        F.coalesce(F.date_sub(F.lead("txn_date").over(w), 1), _horizon(txns)).alias("seg_end"),
        F.sum("day_net").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint").alias("balance"))


def alloc_month_end(txns: DataFrame, floor_at_zero: bool = True) -> DataFrame:
    w = Window.partitionBy("customer_id").orderBy("end_date")
    prev = F.coalesce(F.lag("closing_balance").over(w), F.lit(0))
    alloc = F.greatest(prev, F.lit(0)) if floor_at_zero else prev
    cb = closing_balance(txns).select("end_date", alloc.alias("alloc"))
    return cb.groupBy(F.col("end_date").alias("month")).agg(
        F.sum("alloc").cast("bigint").alias("data_required")).orderBy("month")


def alloc_trailing30(txns: DataFrame, floor_at_zero: bool = True, days: int = 30, tasks: int | None = None) -> DataFrame:
    seg = balance_segments(txns, tasks)
    hz = _horizon(txns)
    last_ms = F.trunc(F.least(F.date_add("seg_end", days - 1), hz), "month")
    ex = seg.select("customer_id", "seg_start", "seg_end", "balance",
                    F.explode(F.sequence(F.trunc("seg_start", "month"), last_ms,
                                         F.expr("INTERVAL 1 MONTH"))).alias("ms"))
    d = F.last_day("ms")
    overlap = F.datediff(F.least("seg_end", d), F.greatest("seg_start", F.date_sub(d, days - 1))) + 1
    bd = ex.select("customer_id", d.alias("month"), overlap.alias("ov"), "balance") \
           .filter(F.col("ov") > 0) \
           .groupBy("customer_id", "month").agg(F.sum(F.col("balance") * F.col("ov")).alias("bd"))
    v = F.greatest("bd", F.lit(0)) if floor_at_zero else F.col("bd")
    return bd.groupBy("month").agg(
        (F.sum(v).cast("double") / F.lit(float(days))).alias("data_required")).orderBy("month")


def month_peaks(txns: DataFrame) -> DataFrame:
    """customer_id, month, peak, balance for the months with transactions: the
    highest balance reached (the one carried in included) and the last one."""
    return summary_peaks(month_summary(txns))


def monthly_total(peaks: DataFrame, floor_at_zero: bool = True) -> DataFrame:
    """month, data_required: the sum over customers of each month's peak, for
    every month from the first to the last; a month without transactions of a
    customer holds the balance carried into it.

    No customer is expanded to its quiet months: a balance is added in the
    month after it was reached and taken off in the customer's next active
    month, and the running sum of those changes over the months (one row each)
    is what quiet customers hold."""
    v = (lambda c: F.greatest(F.col(c), F.lit(0))) if floor_at_zero else F.col
    w = Window.partitionBy("customer_id").orderBy("month")
    rows = peaks.select("month", v("peak").alias("own"), v("balance").alias("held"), F.lead("month").over(w).alias("next"))
    changes = rows.select(F.explode(F.array(
        F.struct("month", F.col("own").cast("decimal(38,0)").alias("own"), F.lit(0).cast("decimal(38,0)").alias("change")),
        F.struct(F.last_day(F.add_months("month", 1)).alias("month"), F.lit(None).cast("decimal(38,0)").alias("own"), F.col("held").cast("decimal(38,0)").alias("change")),
        F.struct(F.col("next").alias("month"), F.lit(None).cast("decimal(38,0)").alias("own"), (-F.col("held")).cast("decimal(38,0)").alias("change")))).alias("c"))
    per = changes.select("c.*").filter("month is not null").groupBy("month").agg(F.sum("own").alias("own"), F.sum("change").alias("change"))
    # From here on one row per calendar month.
    order = Window.orderBy("month")
    months = per.select("month", F.coalesce("own", F.lit(0)).alias("own"), F.sum("change").over(order).alias("quiet"), F.lead("month").over(order).alias("next"),
                        F.max(F.when(F.col("own").isNotNull(), F.col("month"))).over(Window.partitionBy()).alias("last"))
    months = months.filter(F.col("month") <= F.col("last"))
    filled = months.select("month", "own", "quiet", F.explode(F.sequence(
        F.trunc("month", "month"), F.trunc(F.when(F.col("month") < F.col("last"), F.add_months("next", -1)).otherwise(F.col("month")), "month"),
        F.expr("INTERVAL 1 MONTH"))).alias("ms"))
    here = F.last_day("ms")
    return filled.select(here.alias("month"), (F.when(here == F.col("month"), F.col("own")).otherwise(F.lit(0)) + F.col("quiet")).cast("bigint").alias(
        "data_required")).orderBy("month")


def alloc_realtime(txns: DataFrame, floor_at_zero: bool = True) -> DataFrame:
    return monthly_total(month_peaks(txns), floor_at_zero)


def interest_simple(txns: DataFrame, annual_rate: float = 0.06, floor_at_zero: bool = True, scale: int = 2,
                    tasks: int | None = None) -> DataFrame:
    """Monthly total of daily simple interest (rate/365 on each day's closing
    balance), rounded to ``scale`` decimals."""
    seg = balance_segments(txns, tasks)
    ex = seg.select("seg_start", "seg_end", "balance",
                    F.explode(F.sequence(F.trunc("seg_start", "month"), F.trunc("seg_end", "month"),
                                         F.expr("INTERVAL 1 MONTH"))).alias("ms"))
    me = F.last_day("ms")
    overlap = F.datediff(F.least("seg_end", me), F.greatest("seg_start", "ms")) + 1
    b = F.greatest("balance", F.lit(0)) if floor_at_zero else F.col("balance")
    per = ex.groupBy(me.alias("month")).agg(F.sum(b * overlap).alias("balance_days"))
    return per.select("month", F.round(F.col("balance_days").cast("double") * F.lit(annual_rate) / F.lit(365.0), scale)
                      .alias("data_required")).orderBy("month")


def interest_compound(txns: DataFrame, annual_rate: float = 0.06, floor_at_zero: bool = False, scale: int = 2) -> DataFrame:
    """Monthly interest with daily compounding: each day's closing balance
    grows by (1 + rate/365) at the end of the day; with ``floor_at_zero`` only
    a positive one does.

    Balance at day D is sum(a_t * g^(D - t + 1)) with g = 1 + rate/365, so a
    month's total over all customers follows from per-month sums of a_t and
    a_t * g^-(t - t0); exponents are offset from the first date t0.  The floor
    makes each customer's balance depend on its own path, which is followed
    along its days with transactions and month ends.  Rounded to ``scale``
    decimals.
    """
    if floor_at_zero:
        return _compound_floored(txns, annual_rate, scale)
    g = 1.0 + annual_rate / 365.0
    t0 = txns.agg(F.min("txn_date")).scalar()
    amt = signed(txns)
    per = txns.groupBy(F.last_day("txn_date").alias("month")).agg(
        F.sum(amt).alias("a"),
        F.sum(amt.cast("double") * F.pow(F.lit(g), -F.datediff("txn_date", t0).cast("double"))).alias("w"))
    bounds = txns.agg(F.trunc(F.min("txn_date"), "month").alias("lo"), F.trunc(F.max("txn_date"), "month").alias("hi"))
    months = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("ms")) \
                   .select(F.last_day("ms").alias("month"))
    j = months.join(per, "month", "left").select("month", F.coalesce("a", F.lit(0)).alias("a"),
                                                 F.coalesce("w", F.lit(0.0)).alias("w"))
    # one row per calendar month: an unpartitioned window over this table is tiny
    wm = Window.orderBy("month")
    bal = j.select("month", "a", (F.pow(F.lit(g), (F.datediff("month", t0) + 1).cast("double"))
                                  * F.sum("w").over(wm.rowsBetween(Window.unboundedPreceding, 0))).alias("b"))
    interest = F.col("b") - F.coalesce(F.lag("b").over(wm), F.lit(0.0)) - F.col("a")
    return bal.select("month", F.round(interest, scale).alias("data_required")).orderBy("month")


def _compound_floored(txns: DataFrame, annual_rate: float, scale: int) -> DataFrame:
    """Daily compounding of positive balances only.  A customer's path holds at
    most one entry per calendar day (day nets are summed first), so it is
    bounded by the calendar, not by the transactions."""
    g = 1.0 + annual_rate / 365.0
    horizon = F.date_add(_horizon(txns), 1)
    day = txns.groupBy("customer_id", "txn_date").agg(F.sum(signed(txns)).cast("double").alias("net"))
    step = F.struct(F.col("txn_date").alias("d"), "net", F.lit(False).alias("closes"))
    path = day.groupBy("customer_id").agg(F.collect_list(step).alias("days"), F.min("txn_date").alias("first"))
    path = path.withColumn("end", horizon)      # a subquery cannot stand inside a lambda's argument
    # The first of every later month closes the month before; only then a result is added.
    firsts = F.transform(F.sequence(F.add_months(F.trunc("first", "month"), 1), F.col("end"), F.expr("INTERVAL 1 MONTH")),
                         lambda d: F.struct(d.alias("d"), F.lit(0.0).alias("net"), F.lit(True).alias("closes")))
    steps = F.array_sort(F.concat("days", firsts))
    growth = lambda acc, x: F.when((acc["b"] > 0) & acc["d"].isNotNull(),
                                   acc["b"] * (F.pow(F.lit(g), F.datediff(x["d"], acc["d"]).cast("double")) - 1)).otherwise(F.lit(0.0))
    start = F.struct(F.lit(0.0).alias("b"), F.lit(None).cast("date").alias("d"), F.lit(0.0).alias("i"),
                     F.array().cast("array<struct<month:date,i:double>>").alias("out"))
    run = F.aggregate(steps, start, lambda acc, x: F.struct(
        (acc["b"] + growth(acc, x) + x["net"]).alias("b"), x["d"].alias("d"),
        F.when(x["closes"], F.lit(0.0)).otherwise(acc["i"] + growth(acc, x)).alias("i"),
        F.when(x["closes"], F.concat(acc["out"], F.array(F.struct(
            F.last_day(F.date_sub(x["d"], 1)).alias("month"), (acc["i"] + growth(acc, x)).alias("i"))))).otherwise(acc["out"]).alias("out")),
        lambda acc: acc["out"])
    rows = path.select(F.explode(run).alias("r")).select("r.month", "r.i")
    return rows.groupBy("month").agg(F.round(F.sum("i"), scale).alias("data_required")).orderBy("month")


def allocation(txns: DataFrame, option: int, floor_at_zero: bool = True) -> DataFrame:
    """Monthly data required under allocation option 1 (previous month-end
    balance), 2 (trailing 30-day average) or 3 (real-time peak)."""
    fns = {1: alloc_month_end, 2: alloc_trailing30, 3: alloc_realtime}
    if option not in fns:
        raise ValueError(f"option must be 1, 2 or 3, not {option!r}")
    return fns[option](txns, floor_at_zero=floor_at_zero)


def interest(txns: DataFrame, annual_rate: float = 0.06, compound: bool = False, floor_at_zero: bool | None = None,
             scale: int = 2) -> DataFrame:
    """Monthly data growth from daily interest, simple or compounding; the
    floor is that of the chosen kind (simple: on, compounding: off) unless given."""
    if compound:
        return interest_compound(txns, annual_rate, bool(floor_at_zero), scale)
    return interest_simple(txns, annual_rate, floor_at_zero is not False, scale)
