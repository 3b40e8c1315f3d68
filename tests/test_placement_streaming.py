from __future__ import annotations

import datetime as dt
import glob
import random
import uuid

import pytest

from tallyline.operators import allocation as AL
from tallyline.operators import placement as PL
from tallyline.streaming import live_balance as LB
from tallyline.streaming.peak_store import PeakStore

from .conftest import d, rows


@pytest.fixture(scope="module")
def nodes(spark):
    return spark.createDataFrame([
        (1, 1, "A", d("2020-01-01"), 1), (1, 1, "B", d("2020-01-11"), 2), (1, 1, "A", d("2020-01-21"), 3),
        (1, 1, "C", d("2020-02-01"), 4),
        (2, 1, "A", d("2020-01-05"), 5), (2, 1, "A", d("2020-01-09"), 6), (2, 1, "B", d("2020-01-09"), 7),
        (3, 2, "C", d("2020-01-01"), 8), (3, 2, "D", d("2020-01-31"), 9),
    ], "customer_id bigint, region_id int, node_id string, start_date date, stint_id bigint")


@pytest.fixture(scope="module")
def regions(spark):
    return spark.createDataFrame([(1, "North"), (2, "South"), (3, "East")], "region_id int, region_name string")


def test_counts(nodes, regions):
    assert PL.distinct_nodes(nodes).first()[0] == 4
    assert rows(PL.nodes_per_region(nodes, regions)) == [(1, "North", 3), (2, "South", 2)]
    assert rows(PL.nodes_per_region(nodes, regions, distinct=False)) == [(1, "North", 7), (2, "South", 2)]
    assert rows(PL.customers_per_region(nodes, regions)) == [(1, "North", 2), (2, "South", 1)]


def test_gaps(nodes, regions):
    assert PL.realloc_avg(nodes).first()[0] == 16.0
    assert PL.realloc_avg(nodes, per_stint=True).first()[0] == 13.0
    got = rows(PL.realloc_percentiles(nodes, regions))
    assert got[1] == (2, "South", 30.0, 30.0, 30.0)
    r1 = got[0]
    assert r1[:3] == (1, "North", 10.0) and abs(r1[3] - 16.6) < 1e-9 and abs(r1[4] - 19.9) < 1e-9


def test_live_balance_matches_batch(spark, ledger):
    got = rows(LB.replay_live_balance(spark, ledger), "customer_id", "balance", "txn_count")
    assert got == [(1, -25, 4), (2, 30, 3), (3, 11, 2)]


def test_live_month_peaks(spark, ledger):
    got = rows(LB.replay_month_peaks(spark, ledger))
    assert got == [(1, d("2020-01-31"), 100, 70), (1, d("2020-03-31"), 70, -25),
                   (2, d("2020-02-29"), 50, 50), (2, d("2020-03-31"), 50, 30),
                   (3, d("2020-01-31"), 10, 10), (3, d("2020-02-29"), 11, 11)]


def _sink(spark):
    from tallyline.session import ensure_checkpoint_dir
    return PeakStore(spark, f"{ensure_checkpoint_dir(spark)}/peaks-{uuid.uuid4().hex}", buckets=2)


def test_month_peaks_state_carries_across_batches(spark, ledger):
    """January arrives in the first micro-batch, the rest in the second: the
    carried balance (70) must be the March peak of customer 1.  A batch that
    is processed again gives the same result."""
    sink = _sink(spark)
    sink(ledger.filter("txn_date < '2020-02-01'"), 0)
    for _ in range(2):
        sink(ledger.filter("txn_date >= '2020-02-01'"), 1)
    assert rows(sink.peaks(), "customer_id", "month", "peak", "balance") == [
        (1, d("2020-01-31"), 100, 70), (1, d("2020-03-31"), 70, -25), (2, d("2020-02-29"), 50, 50),
        (2, d("2020-03-31"), 50, 30), (3, d("2020-01-31"), 10, 10), (3, d("2020-02-29"), 11, 11)]
    assert sink.corrections().count() == 0 and sink.rejected().count() == 0


def test_late_rows_correct_their_month_and_those_after(spark):
    schema = "customer_id bigint, txn_id bigint, txn_date date, txn_type string, txn_amount bigint"
    sink = _sink(spark)
    sink(spark.createDataFrame([(1, 1, d("2020-01-05"), "deposit", 100), (1, 2, d("2020-03-05"), "deposit", 900)], schema), 0)
    sink(spark.createDataFrame([(1, 3, d("2020-01-20"), "purchase", 50), (1, 4, d("2020-03-06"), "deposit", 1)], schema), 1)
    assert rows(sink.peaks()) == [(1, d("2020-01-31"), 100, 50), (1, d("2020-03-31"), 951, 951)]
    assert sink.corrections().count() == 0                 # both came after what their months held
    late = spark.createDataFrame([(1, 0, d("2020-01-01"), "deposit", 7), (1, 5, None, "deposit", 1), (None, 6, d("2020-01-01"), "deposit", 1),
                                  (2, 7, d("2020-02-01"), "deposit", 5)], schema)
    for _ in range(2):                                     # a batch that is processed again counts once
        sink(late, 2)
        assert rows(sink.peaks()) == [(1, d("2020-01-31"), 107, 57), (1, d("2020-03-31"), 958, 958), (2, d("2020-02-29"), 5, 5)]
    assert rows(sink.corrections()) == [(1, d("2020-01-31"), 2)] and sorted(r["txn_id"] for r in sink.rejected().collect()) == [5, 6]
    sink(spark.createDataFrame([], schema), 3)
    assert sink.last_batch() == 3 and len(rows(sink.peaks())) == 3


@pytest.mark.parametrize("period", ["month", "year"])
def test_any_order_of_arrival_gives_the_batch_result(spark, period):
    """Transactions in random batches, many on one day and of one customer."""
    rnd = random.Random(5)
    txns = [(rnd.choice([1, 1, 1, 2, 3]), k, d(f"202{rnd.randint(0, 1)}-{rnd.randint(1, 3):02d}-{rnd.choice([1, 1, 2, 28]):02d}"),
             rnd.choice(["deposit", "purchase", "withdrawal"]), rnd.randint(1, 90)) for k in range(300)]
    schema = "customer_id bigint, txn_id bigint, txn_date date, txn_type string, txn_amount bigint"
    sink = _sink(spark)
    sink.period = period
    rnd.shuffle(txns)
    for batch in range(4):
        sink(spark.createDataFrame(txns[75 * batch:75 * batch + 75], schema), batch)
        seen = spark.createDataFrame(txns[:75 * batch + 75], schema)
        assert rows(sink.peaks()) == rows(AL.month_peaks(seen)) == _plain_peaks(txns[:75 * batch + 75])
    assert sink.corrections().count() > 0


def _plain_peaks(txns):
    out, balance = {}, {}
    for customer, _, day, kind, amount in sorted(txns, key=lambda t: (t[0], t[2], t[1])):
        month = (day.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
        before = balance.get(customer, 0)
        balance[customer] = before + (amount if kind == "deposit" else -amount)
        peak = out.get((customer, month), (before, 0))[0]
        out[customer, month] = (max(peak, balance[customer]), balance[customer])
    return sorted((c, m, p, b) for (c, m), (p, b) in out.items())


def test_a_batch_writes_the_cells_it_touches(spark):
    """State written follows the batch: one late row writes one cell of many."""
    schema = "customer_id bigint, txn_id bigint, txn_date date, txn_type string, txn_amount bigint"
    sink = _sink(spark)
    sink.buckets = 4
    history = [(c, 100 * c + m, d(f"2020-{m:02d}-10"), "deposit", 10) for c in range(40) for m in range(1, 13)]
    sink(spark.createDataFrame(history, schema), 0)
    sink(spark.createDataFrame([(7, 5, d("2020-02-01"), "deposit", 1)], schema), 1)
    cells = lambda v: sorted(glob.glob(f"{sink.base}/cells/version={v}/period=*/bucket=*"))
    assert len(cells(0)) == 48 and len(cells(1)) == 1 and "period=2020-02-01" in cells(1)[0]
    sink(spark.createDataFrame([(7, 6, d("2020-02-02"), "deposit", 1)], schema), 2)
    assert len(cells(0)) == 47 and len(cells(2)) == 1        # what no retry reads is deleted
    assert [r["peak"] for r in sink.peaks().filter("customer_id = 7").orderBy("month").collect()][:3] == [10, 22, 32]


def test_month_total_of_the_stream_equals_the_batch(spark, ledger):
    want = rows(AL.alloc_realtime(ledger))
    assert rows(LB.replay_month_total(spark, ledger)) == want == [
        (d("2020-01-31"), 110), (d("2020-02-29"), 70 + 50 + 11), (d("2020-03-31"), 70 + 50 + 11)]


def test_approx_percentiles_return_observed_values(nodes, regions):
    got = rows(PL.realloc_percentiles(nodes, regions, exact=False))
    assert got[1] == (2, "South", 30.0, 30.0, 30.0)
    assert all(v in (4.0, 10.0, 21.0) for v in got[0][2:])


def test_stint_gaps_blocks_match_plain_window(spark):
    """Block-split per-stint gaps equal a single window over each customer,
    with many stints on the same day and tiny blocks."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(0, 400).select(
        (F.col("id") % 3).alias("customer_id"), F.lit(1).alias("region_id"),
        F.when(F.col("id") % 7 < 3, "A").when(F.col("id") % 7 < 5, "B").otherwise("C").alias("node_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 25).cast("int")).alias("start_date"),
        F.col("id").alias("stint_id"))
    w = Window.partitionBy("customer_id").orderBy("start_date", "stint_id")
    s = df.withColumn("prev", F.lag("node_id").over(w))
    st = s.filter(F.col("prev").isNull() | (F.col("prev") != F.col("node_id")))
    brute = st.select("stint_id", F.datediff(F.lead("start_date").over(w), F.col("start_date")).alias("g"))
    for chunk in (1_000_000, 4):
        got = PL.stint_gaps(df, chunk=chunk).select("stint_id", "moving_days")
        assert rows(got) == rows(brute)


def test_replay_crosses_batches(spark, ledger):
    """The replay feeds date ranges, so a customer's rows meet several batches."""
    got = rows(LB.replay_monthly_net(spark, ledger), "customer_id", "month", "net", "txn_count")
    assert (1, d("2020-01-31"), 70, 2) in got and (1, d("2020-03-31"), -95, 2) in got and len(got) == 6


def test_percentile_names_are_distinct(nodes, regions):
    assert PL.realloc_percentiles(nodes, regions, ps=(0.29, 0.5, 0.99, 0.995)).columns[2:] == ["p29", "median", "p99", "p99_5"]


def test_checkpoint_folder_is_needed_outside_local_sessions():
    from tallyline.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
