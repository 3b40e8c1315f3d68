"""Property tests on random ledgers: the block-split running balance equals a
plain ordered running sum, and month-end closing balances agree with it."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyline.operators import ledger as L

from .conftest import TXN_SCHEMA

TYPES = ["deposit", "purchase", "withdrawal", "fee"]
txn = st.tuples(st.integers(1, 4), st.integers(0, 70), st.sampled_from(TYPES), st.integers(0, 500))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(txn, min_size=1, max_size=40), st.integers(1, 5))
def test_running_and_closing_balance(spark, txns, chunk):
    base = dt.date(2020, 1, 1)
    data = [(c, i, base + dt.timedelta(days=day), t, a) for i, (c, day, t, a) in enumerate(txns)]
    df = spark.createDataFrame(data, TXN_SCHEMA)
    # brute force in plain Python
    expect, bal = {}, {}
    for c, i, day, t, a in sorted(data, key=lambda r: (r[0], r[2], r[1])):
        bal[c] = bal.get(c, 0) + (-a if t in ("purchase", "withdrawal") else a)
        expect[i] = bal[c]
    got = {r["txn_id"]: r["running_balance"] for r in L.running_balance(df, chunk=chunk).collect()}
    assert got == expect
    last = max(r[2] for r in data)
    last_end = (last.replace(day=28) + dt.timedelta(days=4))
    last_end = last_end - dt.timedelta(days=last_end.day)
    closing = {r["customer_id"]: r["closing_balance"]
               for r in L.closing_balance(df).filter(f"end_date = DATE'{last_end}'").collect()}
    assert closing == bal
