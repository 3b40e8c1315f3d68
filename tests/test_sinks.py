from __future__ import annotations

import io
import tempfile
from contextlib import redirect_stdout

from tallyline.sources import sinks as S

from .conftest import rows


def test_month_partitions_are_pruned(spark, ledger):
    path = tempfile.mkdtemp(prefix="tallyline-sink-") + "/ledger"
    S.write_by_month(ledger, path, "txn_date")
    feb = S.read_months(spark, path, "2020-02-01", "2020-02-29")
    assert rows(feb, "txn_id") == [(5,), (6,), (9,)]
    buf = io.StringIO()
    with redirect_stdout(buf):
        feb.explain("formatted")
    assert "PartitionFilters: [isnotnull(month" in buf.getvalue()


def test_write_table_round_trip(spark, ledger):
    path = S.write_table(ledger, "ledger-copy")
    assert S.read_table(spark, path).count() == ledger.count()


def test_bucketed_tables_join_without_shuffle(spark, pizza):
    import uuid
    sfx = uuid.uuid4().hex[:8]
    S.write_bucketed(pizza["items"], f"items_{sfx}", ["order_id"], 4)
    S.write_bucketed(pizza["deliveries"], f"deliveries_{sfx}", ["order_id"], 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        j = spark.table(f"items_{sfx}").join(spark.table(f"deliveries_{sfx}"), "order_id")
        buf = io.StringIO()
        with redirect_stdout(buf):
            j.explain("formatted")
        assert "SortMergeJoin" in buf.getvalue() and "Exchange" not in buf.getvalue()
        assert j.count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP TABLE IF EXISTS items_{sfx}")
        spark.sql(f"DROP TABLE IF EXISTS deliveries_{sfx}")
