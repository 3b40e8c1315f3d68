"""Run every catalog query on Spark and its oracle SQL on DuckDB, compare.

    python tools/compare_oracle.py [sf_dir] [name ...]

Prints one line per query: status, row counts, and the first difference.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tallyline.plans.catalog import QUERIES  # noqa: E402
from tallyline.plans.oracle import ORACLE  # noqa: E402
from tallyline.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


STRICT = os.environ.get("COMPARE_STRICT") == "1"


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        return True, f"rows={len(s_rows)} (no oracle)"
    res = con.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    d_rows = rows_of(d_cols, res.fetchall())
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    for a, b in zip(s_rows, d_rows):
        if a != b:
            return False, f"rows={len(s_rows)} first diff spark={a} duck={b}"
    return True, f"rows={len(s_rows)}"


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    from tallyline.session import build_session
    extra = {}
    if os.environ.get("COMPARE_NO_BROADCAST") == "1":    # the plan shape of large tables
        extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    spark = build_session("local[8]", 8, extra=extra)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        try:
            ok, msg = compare(spark, con, sf_dir, n)
        except Exception as e:  # report and go on
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:34s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
