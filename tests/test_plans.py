"""Plan regression checks: batch queries stay JVM-side, never cross join,
and scans read only the columns a query needs."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as entry_mod
from tallyline.plans.catalog import QUERIES

from .conftest import SF_SMALL

BATCH = sorted(n for n in QUERIES if not n.startswith("live_"))


def plan_text(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cross_join(spark, name):
    txt = plan_text(entry_mod.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in txt, f"{name}: {bad}"


def test_closing_balance_prunes_columns(spark):
    txt = plan_text(entry_mod.queries()["closing_balance"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", txt)
    assert schemas and all("o_orderpriority" not in s and "o_orderkey" not in s for s in schemas)


def test_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from tallyline.plans.catalog import Ctx
    c = Ctx(spark, SF_SMALL)
    txt = plan_text(c.txns.filter(F.col("customer_id") == 7))
    assert "PushedFilters: [IsNotNull(o_custkey), EqualTo(o_custkey,7)]" in txt
