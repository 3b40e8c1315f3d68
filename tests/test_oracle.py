"""Every registered query against its DuckDB oracle on the smallest tables,
plus a shuffle-partition invariance check."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_mod
from tools.compare_oracle import compare, duck, rows_of

from .conftest import SF_SMALL

from tallyline.plans.catalog import QUERIES  # noqa: E402

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, SF_SMALL, name)
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["customer_id", "end_date", "transactions", "closing_balance"]
    assert df.count() > 0


@pytest.mark.parametrize("name", ["closing_balance", "ingredient_list", "running_balance", "realloc_percentiles"])
def test_shuffle_partitions_do_not_change_results(spark, name):
    q = entry_mod.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = q(spark, SF_SMALL)
        ra = rows_of(a.columns, [tuple(r) for r in a.collect()])
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        b = q(spark, SF_SMALL)
        rb = rows_of(b.columns, [tuple(r) for r in b.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert ra == rb
