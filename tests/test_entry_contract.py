"""Driver contract: every query has unique, explicitly named output columns,
the same set of names as its oracle, and the entry query is stable."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry_mod
from tallyline.plans.catalog import QUERIES
from tools.compare_oracle import duck

from .conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_columns_named_and_match_oracle(spark, con, name):
    cols = entry_mod.queries()[name](spark, SF_SMALL).columns
    assert len(cols) == len(set(cols))
    assert not any(re.search(r"[()]", c) for c in cols), cols       # no generated names like sum(x)
    oracle_cols = [d[0] for d in con.execute(f"SELECT * FROM ({entry_mod.oracle_sql()[name]}) LIMIT 0").description]
    assert sorted(cols) == sorted(oracle_cols)


def test_entry_schema_is_stable(spark):
    a = entry_mod.entry(spark).schema
    b = entry_mod.entry(spark).schema
    assert a == b
