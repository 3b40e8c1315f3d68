from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline.operators import ledger as L
from tallyline.operators.numbering import numbered, with_global_ids
from tallyline.operators.quantiles import exact_quantiles
from tallyline.sources import business as B

from .conftest import SF_SMALL, d, rows


def _csv(text):
    path = tempfile.mkdtemp(prefix="tallyline-csv-")
    with open(f"{path}/t.csv", "w") as f:
        f.write("customer_id,txn_date,txn_type,txn_amount\n" + text)
    return path


GOOD = "429,2020-01-21,deposit,82\n155, 2020-01-10 ,deposit,712\n398,2020-01-01,withdrawal, 0\n"
BIG = "3000000000,2020-01-02,purchase,3000000000\n0000000000012,2020-01-02,purchase,9223372036854775807\n"


def test_csv_load_with_text_numbers(spark):
    t = B.read_business(spark, _csv(GOOD + BIG), "customer_transactions", fmt="csv")
    assert [f.dataType.simpleString() for f in t.schema.fields] == ["bigint", "date", "string", "bigint"]
    got = {r["customer_id"]: r["txn_amount"] for r in t.collect()}
    assert got == {429: 82, 155: 712, 398: 0, 3000000000: 3000000000, 12: 9223372036854775807}


BAD = "x,2020-01-02,purchase,5\n7,2020-13-01,purchase,99999999999999999999\n8,,purchase,\n"


def test_bad_values_fail_or_are_put_aside(spark):
    path = _csv(GOOD + BAD)
    with pytest.raises(Exception, match="customer_transactions"):
        B.read_business(spark, path, "customer_transactions", fmt="csv").collect()
    good, bad = B.read_split(spark, path, "customer_transactions", fmt="csv")
    assert rows(good, "customer_id") == [(8,), (155,), (398,), (429,)]
    assert {r["customer_id"]: r["rejected_columns"] for r in bad.collect()} == {"x": ["customer_id"], "7": ["txn_date", "txn_amount"]}


def test_bigint_parquet_keys_are_kept(spark):
    path = tempfile.mkdtemp(prefix="tallyline-pq-") + "/t"
    spark.createDataFrame([(3000000000, d("2020-01-01"), "deposit", 3000000000)],
                          "customer_id bigint, txn_date date, txn_type string, txn_amount bigint").write.parquet(path)
    assert rows(B.read_business(spark, path, "customer_transactions")) == [(3000000000, d("2020-01-01"), "deposit", 3000000000)]


def _any_order(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("ranges", [1, 5, 40, None])
def test_numbering_follows_the_order_at_any_number_of_ranges(spark, ranges):
    """Keys that span ranges, null keys and rows repeated very often."""
    t = spark.range(0, 3000).selectExpr("IF(id % 10 < 8, 1, IF(id % 10 = 8, NULL, id % 7)) AS customer_id", "DATE'2020-01-01' AS txn_date",
                                        "IF(id % 3 = 0, 'deposit', 'purchase') AS txn_type", "IF(id % 2 = 0, 5, id * 7919 % 501) AS txn_amount")
    got = _any_order(numbered(t, ["customer_id", "txn_date"], ["txn_type", "txn_amount"], "txn_id", ranges))
    w = Window.partitionBy("customer_id", "txn_date").orderBy("txn_type", "txn_amount")
    assert got == _any_order(t.withColumn("txn_id", F.row_number().over(w).cast("bigint")))
    ids = _any_order(with_global_ids(t, ["txn_amount"], "id", ranges))
    everything = Window.orderBy("txn_amount", "customer_id", "txn_date", "txn_type")
    assert ids == _any_order(t.withColumn("id", F.row_number().over(everything).cast("bigint")))


def test_numbering_regenerates_a_row_in_chunks(spark):
    t = spark.range(0, 250_000).selectExpr("1 AS k", "2 AS v")
    got = numbered(t, ["k"], ["v"], "id").agg(F.count("*"), F.min("id"), F.max("id"), F.count_distinct("id")).first()
    assert tuple(got) == (250_000, 1, 250_000, 250_000)
    assert with_global_ids(t.limit(0), ["v"], "id").count() == 0 == numbered(t.limit(0), ["k"], ["v"], "id").count()


def test_global_ids_need_no_window_over_the_table(spark):
    t = spark.range(0, 100).selectExpr("id % 7 AS v")
    plan = with_global_ids(t, ["v"], "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "windowspecdefinition(_range" in plan and "windowspecdefinition(v" not in plan


@pytest.mark.parametrize("buckets", [2, 16, 1024])
def test_rank_selection_equals_the_exact_percentile(spark, buckets):
    t = spark.range(0, 4000).selectExpr("IF(id % 5 = 0, NULL, id % 3) AS g", "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 "
                                        "ELSE id * 2654435761 % 1000003 - 500000 END AS v")
    ps = (0.0, 0.25, 0.5, 0.8, 0.95, 1.0)
    got = _any_order(exact_quantiles(t, ["g"], "v", ps, [f"p{k}" for k in range(len(ps))], buckets))
    want = _any_order(t.filter("v is not null").groupBy("g").agg(*[F.percentile("v", F.lit(p)).alias(f"p{k}") for k, p in enumerate(ps)]))
    assert len(got) == len(want) == 4
    for a, b in zip(got, want):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:])
    assert exact_quantiles(t.filter("v > 1e9"), ["g"], "v", ps, [f"p{k}" for k in range(len(ps))]).count() == 0


def test_typed_tables_and_views(spark):
    from tallyline.sources import sinks
    from tallyline.sources.tables import Tables
    sinks.create_table(spark, "made_regions", B.SCHEMAS["regions"], replace=True)
    spark.sql("INSERT INTO made_regions VALUES (1, 'North')")
    assert rows(spark.table("made_regions")) == [(1, "North")]
    with pytest.raises(Exception, match="already exists"):
        sinks.create_table(spark, "made_regions", B.SCHEMAS["regions"])
    sinks.create_table(spark, "made_regions", B.SCHEMAS["regions"], replace=True)
    assert spark.table("made_regions").count() == 0
    spark.sql("DROP TABLE made_regions")
    Tables(spark, SF_SMALL).register_views(["region"])
    assert spark.sql("SELECT count(*) FROM region").first()[0] == 5


def test_tiebreak_ids_and_running_balance(spark):
    t = spark.createDataFrame([(1, d("2020-01-01"), "deposit", 10), (1, d("2020-01-01"), "purchase", 4),
                               (1, d("2020-01-02"), "deposit", 1)],
                              "customer_id int, txn_date date, txn_type string, txn_amount int")
    rb = L.running_balance(B.with_txn_ids(t))
    assert rows(rb, "txn_date", "txn_id", "running_balance") == [
        (d("2020-01-01"), 1, 10), (d("2020-01-01"), 2, 6), (d("2020-01-02"), 1, 7)]


def test_open_stint(spark):
    n = spark.createDataFrame([(1, d("2020-01-01"), d("9999-12-31")), (1, d("2020-01-01"), d("2020-01-05"))],
                              "customer_id int, start_date date, end_date date")
    assert n.filter(B.open_stint()).count() == 1
