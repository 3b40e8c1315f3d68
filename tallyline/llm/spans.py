"""Spans of regular-expression matches as native expressions.

Spark's regex functions return the matched strings, not their places.  A text
split at the matches gives the gaps between them, so the running sum of the
lengths of gaps and matches gives every start and end in code points.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<s:int,e:int,v:string>"
BLOCK = 256             # matches whose list grows one by one


def found(text: Column, pattern: str, when: Column | None = None) -> tuple[Column, Column]:
    """(gaps, matches) of the pattern in a non-null text; empty where ``when`` is false.
    ``when`` is a cheap necessary condition, e.g. that the text contains an ``@``."""
    test = text.rlike(pattern) if when is None else when & text.rlike(pattern)
    gaps = F.when(test, F.split(text, pattern, -1))
    hits = F.when(test, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return gaps, hits


def placed(gaps: Column, hits: Column) -> Column:
    """array<struct<s,e,v>>: start, end (exclusive) and text of every match, in order.
    ``gaps`` and ``hits`` must be plain columns."""
    pairs = F.slice(F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("g"), F.coalesce(F.length(h), F.lit(0)).alias("n"), h.alias("v"))),
                    F.lit(1), F.size(hits))
    empty = F.array().cast(f"array<{SPAN}>")

    def within(block: Column) -> Column:
        """Length of a block's gaps and matches, and its matches placed from its begin."""
        return F.aggregate(
            block, F.struct(F.lit(0).alias("at"), empty.alias("out")),
            lambda acc, x: F.struct((acc["at"] + x["g"] + x["n"]).alias("at"), F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["g"]).alias("s"), (acc["at"] + x["g"] + x["n"]).alias("e"), x["v"].alias("v")))).alias("out")))

    def begins(blocks: Column) -> Column:
        return F.aggregate(
            blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    # A list grows by copying, so it grows within blocks and the blocks are joined once.
    blocks = lambda p: F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / BLOCK).cast("int")),
                                   lambda i: within(F.slice(p, i * BLOCK + 1, F.lit(BLOCK))))
    shifted = lambda bs: F.flatten(F.zip_with(bs, begins(bs), lambda x, o: F.transform(x["out"], lambda y: F.struct(
        (y["s"] + o).alias("s"), (y["e"] + o).alias("e"), y["v"].alias("v")))))
    return F.when(F.size(hits) > 0, once(pairs, lambda p: once(blocks(p), shifted))).otherwise(empty)


def once(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def joined(spans: Column) -> Column:
    """kind:start:end of every span (structs with kind, s, e), comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def replaced(text: Column, spans: Column, to=None) -> Column:
    """``text`` with every span (structs s, e, to; ordered by s) replaced by ``to``;
    a span that begins inside an earlier one only extends what is removed.
    ``to(x, at)`` may give another text for span x where all before ``at`` is done.

    Blocks of spans are replaced in their own stretch of the text and joined
    once, so the work does not grow with the square of the spans."""
    if to is None:
        to = lambda x, at: F.when(x["s"] >= at, x["to"]).otherwise(F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<lo:int,hi:int,x:array<int>>>").alias("out"))

    def stretches(xs: Column) -> Column:
        """lo, hi: the text that each block of spans replaces; x: the block's number."""
        def add(acc: Column, i: Column) -> Column:
            hi = F.greatest(acc["at"], F.array_max(F.transform(F.slice(xs, i * BLOCK + 1, F.lit(BLOCK)), lambda x: x["e"])))
            return F.struct(hi.alias("at"), F.concat(acc["out"], F.array(F.struct(
                acc["at"].alias("lo"), hi.alias("hi"), F.array(i).alias("x")))).alias("out"))
        return F.aggregate(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / BLOCK).cast("int")), start, add)

    def block(xs: Column, b: Column) -> Column:
        """The replaced stretch of one block."""
        part = F.substring(text, b["lo"] + 1, b["hi"] - b["lo"])
        return once(part, lambda t: F.aggregate(
            F.slice(xs, b["x"][0] * BLOCK + 1, F.lit(BLOCK)), F.struct(b["lo"].alias("at"), F.lit("").alias("out")),
            lambda a, x: F.struct(F.greatest(a["at"], x["e"]).alias("at"), F.concat(
                a["out"], F.when(x["s"] > a["at"], F.substring(t, a["at"] - b["lo"] + 1, x["s"] - a["at"])).otherwise(F.lit("")),
                to(x, a["at"])).alias("out")),
            lambda a: a["out"]))

    body = lambda xs: once(stretches(xs), lambda st: F.concat(
        F.array_join(F.transform(st["out"], lambda b: block(xs, b)), ""),
        F.substring(text, st["at"] + 1, F.length(text) - st["at"])))
    return F.when(F.size(spans) > 0, once(spans, body)).otherwise(text)


def blanked(text: Column, spans: Column) -> Column:
    """``text`` with line breaks in place of every span (structs s, e; ordered by s): places stay."""
    return replaced(text, spans, lambda x, at: F.repeat(F.lit("\n"), F.greatest(x["e"] - F.greatest(x["s"], at), F.lit(0))))
