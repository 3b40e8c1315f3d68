"""Tables that grow: month ends by periods, mergeable sketches, widened columns."""

from __future__ import annotations

import glob
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from tallyline.operators import ledger as L
from tallyline.operators import month_end as ME
from tallyline.operators import sketches as SK
from tallyline.session import ensure_checkpoint_dir
from tallyline.sources import sinks

from .conftest import d, rows

SCHEMA = "customer_id bigint, txn_id bigint, txn_date date, txn_type string, txn_amount bigint"


def _table(spark):
    return ME.MonthEndTable(spark, f"{ensure_checkpoint_dir(spark)}/ends-{uuid.uuid4().hex}")


def _key(r):
    return tuple((x is None, str(x)) for x in r)


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


PERIODS = [
    [(1, 1, d("2020-01-05"), "deposit", 100), (2, 2, d("2020-02-05"), "deposit", 30)],
    [(1, 3, d("2020-05-20"), "purchase", 40), (3, 4, d("2020-06-01"), "deposit", 7)],      # March and April are quiet, customer 3 is new
    [(2, 5, d("2020-07-01"), "withdrawal", 31)],
]


def test_appended_periods_equal_the_full_query(spark):
    t, seen = _table(spark), []
    for k, period in enumerate(PERIODS):
        seen += period
        for _ in range(2):                                   # a repeated load counts once
            t.append(spark.createDataFrame(period, SCHEMA), k)
            assert _sorted(t.read()) == _sorted(L.closing_balance(spark.createDataFrame(seen, SCHEMA)))
    t.append(spark.createDataFrame([], SCHEMA), 3)
    with pytest.raises(ValueError, match="2020-07"):
        t.append(spark.createDataFrame([(1, 6, d("2020-07-02"), "deposit", 1)], SCHEMA), 4)


def test_only_the_last_stored_month_is_read(spark):
    t = _table(spark)
    t.append(spark.createDataFrame(PERIODS[0], SCHEMA), 0)
    for part in glob.glob(f"{t.path}/month=2020-01-01/load=0/*.parquet"):
        with open(part, "wb") as f:
            f.write(b"no parquet")
    shutil.rmtree(f"{t.path}/month=2020-01-01/load=0/.crc", ignore_errors=True)
    t.append(spark.createDataFrame(PERIODS[1], SCHEMA), 1)
    later = spark.read.schema(ME.SCHEMA).option("basePath", t.path).parquet(f"{t.path}/month=2020-06-01")
    assert rows(later, "customer_id", "closing_balance") == [(1, 60), (2, 30), (3, 7)]


def test_sketches_merge_in_any_order(spark):
    t = spark.range(0, 60_000).selectExpr("id % 20011 AS c", "date_add(DATE'2020-01-01', CAST(id % 300 AS INT)) AS d")
    stored = SK.monthly_sketches(t, "d", "c")
    whole = SK.estimate(stored).first()["estimate"]
    halves = stored.groupBy(F.month("month") % 2).agg(F.hll_union_agg("sketch", F.lit(False)).alias("sketch"))
    assert SK.estimate(halves).first()["estimate"] == whole
    assert abs(whole - 20011) <= 20011 * SK.error_bound()


def test_widening_rewrites_the_table(spark):
    name = f"made_{uuid.uuid4().hex}"
    sinks.create_table(spark, name, [("k", "int"), ("v", "string")], replace=True)
    spark.sql(f"INSERT INTO {name} VALUES (1, '7'), (NULL, 'x')")
    sinks.widen_column(spark, name, "k", "bigint")
    spark.sql(f"INSERT INTO {name} VALUES (3000000000, 'y')")
    assert _sorted(spark.table(name)) == _sorted(spark.createDataFrame([(1, "7"), (None, "x"), (3000000000, "y")], "k bigint, v string"))
    with pytest.raises(Exception, match="is no int|OVERFLOW|overflow"):
        sinks.widen_column(spark, name, "k", "int")
    assert spark.table(name).count() == 3
    with pytest.raises(ValueError, match="no column"):
        sinks.widen_column(spark, name, "w", "bigint")
    spark.sql(f"DROP TABLE {name}")
