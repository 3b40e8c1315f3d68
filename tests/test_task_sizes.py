"""Queries over large tables deal their rows to tasks in proportion to the table."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallyline.plans.catalog import QUERIES
from tallyline.sources import tables

from .conftest import SF_SMALL

ROW_QUERIES = ["line_ids", "extra_rows", "exclusion_rows", "item_label", "ingredient_list", "ingredient_list_as_written", "global_ids"]


def _rows(df):
    return sorted(map(str, df.collect()))


def test_tasks_grow_with_the_table(spark, monkeypatch):
    t = tables.Tables(spark, SF_SMALL)
    n = t.lineitem.count()
    assert t.tasks("lineitem") is None
    monkeypatch.setattr(tables, "TASK_ROWS", n // 40)
    small = t.tasks("lineitem")
    monkeypatch.setattr(tables, "TASK_ROWS", n // 80)
    assert 40 <= small <= 41 and 80 <= t.tasks("lineitem") <= 82


@pytest.mark.parametrize("name", ROW_QUERIES)
def test_no_task_holds_much_more_than_its_rows(spark, name, monkeypatch):
    want = _rows(QUERIES[name](spark, SF_SMALL))
    monkeypatch.setattr(tables, "TASK_ROWS", 50)
    got = QUERIES[name](spark, SF_SMALL)
    most = got.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert _rows(got) == want and most <= max(300, len(want) // 20)


@pytest.mark.parametrize("name", ["alloc_trailing30", "interest_simple", "hot_key_ids"])
def test_ledgers_in_many_tasks(spark, name, monkeypatch):
    want = _rows(QUERIES[name](spark, SF_SMALL))
    monkeypatch.setattr(tables, "TASK_ROWS", 50)
    got = QUERIES[name](spark, SF_SMALL)
    tasks = tables.Tables(spark, SF_SMALL).tasks("orders")
    assert "RepartitionByExpression" in (plan := got._jdf.queryExecution().optimizedPlan().toString()) and f"], {tasks}" in plan
    assert _rows(got) == want
