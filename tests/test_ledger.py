from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyline.operators import allocation as AL
from tallyline.operators import ledger as L

from .conftest import d, rows

JAN, FEB, MAR = d("2020-01-31"), d("2020-02-29"), d("2020-03-31")


def test_summary_and_averages(ledger):
    assert rows(L.txn_summary(ledger)) == [("deposit", 5, 161), ("fee", 1, 5), ("purchase", 2, 50),
                                           ("withdrawal", 1, 100)]
    assert tuple(L.deposit_averages(ledger).first()) == (1, 53)


def test_active_customers_readings(ledger):
    assert L.active_customers(ledger).count() == 0
    assert rows(L.active_customers(ledger, as_written=True)) == [(3, 1)]


def test_closing_balance_grid(ledger):
    got = rows(L.closing_balance(ledger))
    assert got == [
        (1, JAN, 70, 70), (1, FEB, 0, 70), (1, MAR, -95, -25),
        (2, JAN, 0, None), (2, FEB, 50, 50), (2, MAR, -20, 30),
        (3, JAN, 10, 10), (3, FEB, 1, 11), (3, MAR, 0, 11),
    ]


def test_closing_balance_fixed_start(ledger):
    got = rows(L.closing_balance(ledger, start="2020-02-01"), "customer_id", "end_date", "closing_balance")
    # January lies before the grid: its transactions are not carried in
    assert got[:2] == [(1, FEB, None), (1, MAR, -95)]


def test_last_closing_equals_ledger_sum(ledger):
    cb = L.closing_balance(ledger).filter(F.col("end_date") == MAR)
    total = ledger.groupBy("customer_id").agg(F.sum(L.signed(ledger)).alias("s"))
    assert rows(cb, "customer_id", "closing_balance") == rows(total, "customer_id", "s")


def test_running_balance_ties_and_month_ends(ledger):
    rb = L.running_balance(ledger)
    assert rows(rb, "txn_id", "running_balance") == [(1, 100), (2, 70), (3, -30), (4, -25), (5, 0), (6, 50),
                                                     (7, 30), (8, 10), (9, 11)]
    stats = rows(L.balance_stats(ledger))
    assert stats[0] == (1, -30, 28.75, 100)


def test_running_balance_matches_single_window(spark):
    """Two-level running sum equals one big window on a skewed ledger (one
    customer holds most rows, many on the same day)."""
    from pyspark.sql import Window
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 10 < 7, F.lit(1)).otherwise(F.col("id") % 5).cast("bigint").alias("customer_id"),
        F.col("id").alias("txn_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("txn_date"),
        F.when(F.col("id") % 3 == 0, "purchase").otherwise("deposit").alias("txn_type"),
        (F.col("id") % 97).alias("txn_amount"))
    w = Window.partitionBy("customer_id").orderBy("txn_date", "txn_id").rowsBetween(Window.unboundedPreceding, 0)
    brute = df.select("txn_id", F.sum(L.signed(df)).over(w).alias("rb"))
    assert rows(L.running_balance(df), "txn_id", "running_balance") == rows(brute, "txn_id", "rb")
    # tiny blocks: many blocks per customer-day
    assert rows(L.running_balance(df, chunk=7), "txn_id", "running_balance") == rows(brute, "txn_id", "rb")


def test_growth(ledger):
    assert abs(L.growth_pct(ledger).first()[0] - 100.0 / 3) < 1e-12
    assert abs(L.growth_pct(ledger, use_abs=True).first()[0] - 100.0 / 3) < 1e-12


# ------------------------------------------------------------- allocation

def _daily(ledger_rows, start, end):
    """Brute-force end-of-day balances per customer (0 before activity)."""
    out = {}
    for c in sorted({r[0] for r in ledger_rows}):
        bal, day, by_day = 0, start, {}
        net = {}
        for r in ledger_rows:
            if r[0] == c:
                s = -r[4] if r[3] in ("withdrawal", "purchase") else r[4]
                net[r[2]] = net.get(r[2], 0) + s
        while day <= end:
            bal += net.get(day, 0)
            by_day[day] = bal
            day += dt.timedelta(days=1)
        out[c] = by_day
    return out


def _month_end(day):
    nxt = (day.replace(day=28) + dt.timedelta(days=4))
    return nxt - dt.timedelta(days=nxt.day)


def test_alloc_month_end_and_realtime(ledger):
    assert rows(AL.alloc_month_end(ledger)) == [(JAN, 0), (FEB, 80), (MAR, 131)]
    assert rows(AL.alloc_realtime(ledger)) == [(JAN, 110), (FEB, 131), (MAR, 131)]


def test_trailing30_and_simple_interest_vs_day_grid(ledger):
    lr = [tuple(r) for r in ledger.collect()]
    daily = _daily(lr, d("2019-12-01"), MAR)
    exp30, expint = {}, {}
    for me in (JAN, FEB, MAR):
        tot = 0
        for c, by_day in daily.items():
            s = sum(by_day[me - dt.timedelta(days=k)] for k in range(30))
            tot += max(s, 0)
        exp30[me] = tot / 30.0
        first = d("2020-01-02")
        bd = sum(max(b, 0) for by_day in daily.values() for day, b in by_day.items()
                 if _month_end(day) == me and day >= first)
        expint[me] = round(bd * 0.06 / 365.0, 2)
    assert dict(rows(AL.alloc_trailing30(ledger))) == exp30
    assert dict(rows(AL.interest_simple(ledger))) == expint


def test_compound_interest_vs_iteration(ledger):
    big = ledger.withColumn("txn_amount", F.col("txn_amount") * 1_000_000)
    lr = [tuple(r) for r in big.collect()]
    g = 1 + 0.06 / 365
    start = min(r[2] for r in lr)
    net = {}
    for r in lr:
        net[r[2]] = net.get(r[2], 0) + (-r[4] if r[3] in ("withdrawal", "purchase") else r[4])
    bal, day, exp, prev_end, added = 0.0, start, {}, 0.0, 0
    while day <= MAR:
        bal = (bal + net.get(day, 0)) * g
        added += net.get(day, 0)
        if day == _month_end(day):
            exp[day] = bal - prev_end - added
            prev_end, added = bal, 0
        day += dt.timedelta(days=1)
    got = dict(rows(AL.interest_compound(big)))
    assert set(got) == set(exp)
    for k in exp:
        assert abs(got[k] - exp[k]) <= 1.0, (k, got[k], exp[k])


def test_dispatchers_and_end_bound(ledger):
    assert rows(AL.allocation(ledger, 1)) == rows(AL.alloc_month_end(ledger))
    assert rows(AL.allocation(ledger, 3)) == rows(AL.alloc_realtime(ledger))
    assert rows(AL.interest(ledger)) == rows(AL.interest_simple(ledger))
    assert rows(AL.interest(ledger, compound=True)) == rows(AL.interest_compound(ledger))
    got = rows(L.closing_balance(ledger, end="2020-02-15"), "end_date")
    assert {r[0] for r in got} == {JAN, FEB}


def test_row_order_does_not_change_results(ledger):
    """SURVEY §5(c): permuting the input rows leaves every result equal."""
    shuffled = ledger.repartition(5).orderBy(F.rand(7)).repartition(3)
    for fn in (L.running_balance, L.closing_balance, L.growth_pct, AL.alloc_trailing30, AL.alloc_realtime):
        assert rows(fn(shuffled)) == rows(fn(ledger)), fn.__name__


def test_compound_interest_with_floor_matches_a_daily_walk(ledger):
    txns = ledger.collect()
    g, want = 1 + 0.06 / 365, {}
    for c in {r["customer_id"] for r in txns}:
        own = [r for r in txns if r["customer_id"] == c]
        b, day = 0.0, min(r["txn_date"] for r in own)
        while day <= dt.date(2020, 3, 31):
            b += sum(-r["txn_amount"] if r["txn_type"] in ("withdrawal", "purchase") else r["txn_amount"] for r in own if r["txn_date"] == day)
            gain = b * (g - 1) if b > 0 else 0.0
            b += gain
            want[day.month] = want.get(day.month, 0.0) + gain
            day += dt.timedelta(days=1)
    got = {r["month"].month: r["data_required"] for r in AL.interest(ledger, compound=True, floor_at_zero=True, scale=6).collect()}
    assert got.keys() == want.keys() and all(abs(got[m] - want[m]) < 1e-5 for m in want)


def test_a_sentinel_date_is_an_error_not_a_huge_grid(spark):
    t = spark.createDataFrame([(1, 1, d("2020-01-01"), "deposit", 1), (1, 2, d("9999-12-31"), "deposit", 1)],
                              "customer_id bigint, txn_id bigint, txn_date date, txn_type string, txn_amount bigint")
    with pytest.raises(Exception, match="give an end date"):
        L.closing_balance(t).collect()
    assert L.closing_balance(t, end="2020-03-31").count() == 3


def test_type_summary_ignores_case(spark):
    t = spark.createDataFrame([(1, " Deposit", 1), (1, "deposit", 2)], "customer_id bigint, txn_type string, txn_amount bigint")
    assert rows(L.txn_summary(t)) == [("deposit", 2, 3)]


def test_realtime_allocation_reads_the_ledger_twice_at_most(spark):
    from tallyline.plans.catalog import QUERIES
    from .conftest import SF_SMALL
    plan = QUERIES["alloc_realtime"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2
