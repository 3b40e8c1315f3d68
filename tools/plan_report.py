"""Operator counts of every registered query's *executed* physical plan (the
final adaptive plan after running it), in two shapes: as run on the local
test data, and with broadcasts disabled (the shape of large inputs, where no
side fits a broadcast).  Writes PLANS.md.

    python tools/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyline.plans.catalog import QUERIES  # noqa: E402
from tallyline.session import build_session  # noqa: E402

OPS = {
    "scan": r"^Scan parquet",
    "reused": r"^ReusedExchange\b",
    "shuffle": r"^Exchange\b",
    "bcast": r"^BroadcastExchange\b",
    "smj": r"^SortMergeJoin\b",
    "bhj": r"^BroadcastHashJoin\b",
    "window": r"^Window\b",
    "agg": r"^(HashAggregate|ObjectHashAggregate|SortAggregate)\b",
    "explode": r"^Generate\b",
    "python": r"^(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)",
}


def _final(text: str) -> list[str]:
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    return [re.sub(r"^[\s:|+\-*]*", "", line).strip() for line in text.splitlines()[1:]]


def tree(df) -> list[str]:
    """The operators of the final adaptive plan, those of its scalar subqueries
    included (a reused subquery counts once)."""
    df.collect()                      # run it, so explain shows the final adaptive plan
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    main, _, rest = buf.getvalue().partition("===== Subqueries =====")
    nodes = _final(main.split("\n\n(1)")[0])
    for part in re.split(r"^Subquery:\d+ Hosting operator.*$", rest, flags=re.M)[1:]:
        part = part.split("\n\n(")[0]
        if "ReusedSubquery" not in part:
            nodes += _final(part)
    return nodes


def counts(df) -> dict[str, int]:
    nodes = tree(df)
    return {k: sum(1 for n in nodes if re.match(p, n)) for k, p in OPS.items()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md")
    spark = build_session("local[8]", 16)
    names = [n for n in QUERIES if not n.startswith("live_")]
    local = {n: counts(QUERIES[n](spark, sf_dir)) for n in names}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    large = {n: counts(QUERIES[n](spark, sf_dir)) for n in names}
    lines = [
        "# Physical plan shapes",
        "",
        f"Generated by `tools/plan_report.py`: every query is run on `{sf_dir}` and the final adaptive",
        "plan (`explain('formatted')` after execution) is counted.  *local*: run with default settings,",
        "where dimension sides are small enough to broadcast.  *large*: broadcasts disabled, the shape",
        "when no side fits in memory (every join sort-merges).  Columns: parquet scans, shuffle",
        "exchanges actually run (scalar subqueries included), exchanges reused from another branch, sort-merge joins, window",
        "operators, aggregation operators (partial and final count separately), generators (explode),",
        "Python evaluation nodes.  `live_*` queries are streaming replays and are omitted.",
        "",
        "| query | local scans | local shuffles | local bcast | large scans | large shuffles | large reused | "
        "large smj | window | agg | explode | python |",
        "| --- | ---: | ---: | ---: | ---: | ---: | ---: | ---: | ---: | ---: | ---: | ---: |",
    ]
    for n in names:
        a, b = local[n], large[n]
        lines.append(f"| {n} | {a['scan']} | {a['shuffle']} | {a['bcast']} | {b['scan']} | {b['shuffle']} | "
                     f"{b['reused']} | {b['smj']} | {b['window']} | {b['agg']} | {b['explode']} | {b['python']} |")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
