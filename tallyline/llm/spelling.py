"""Spelling variants by a trie-node pair dictionary.

The distinct words of a corpus are the leaves of a forward trie (of their
prefixes) and of a reversed trie (of their suffixes).  All nodes are numbered;
leaving one position of a word out gives a pair of integers (node of the prefix
before it, node of the suffix after it), and so does every place between two
positions:

* two words that give the same pair by leaving out position i differ by exactly
  that one replaced letter;
* a word that gives a pair by a left-out position, and one that gives it by a
  place between positions, differ by that one inserted letter.  Of a stretch of
  equal letters only the first counts, so a pair of words meets once.

Pairs are joined by grouping on the two integers.  A group has one member per
letter of the alphabet and one more, whatever the size of the corpus.  Nothing
is emitted per pair of words: a member's number of partners and its best one
follow from the group's counts and its two largest members.

Numbering needs no join on prefixes (the empty one would be on every row): the
words are sorted by ranges, and a node is the offset, in the sorted words of its
range laid end to end, at which its prefix is first completed; the longest
common prefix with the word before tells which nodes are old.  A range's first
word shares nodes with the last word of the range before; this is one short row
per range, and the numbers of these nodes are passed on along the ranges.

Defined results: null, empty and blank texts have no words; a null doc_id counts
as the empty id; repeated rows count each; an empty table gives an empty table;
only ``doc_id`` and ``text`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, reread, sliced, write, written

LEAST_LENGTH, LEAST_COUNT = 6, 5
TIMES = 5                 # a form is so many times as frequent as its variant
RATE = 199                # one in so many (document, word) pairs loses a letter
REMEMBER = 300_000        # counts a task holds before it hands them on
BATCH_CHARS = 4_000_000
RANGE_BITS = 40           # a range's words hold less than 2^40 letters
_runs = re.compile(rb"[a-z\xc0-\xff]+").findall


def counts(docs: DataFrame, least: int = LEAST_LENGTH, rate: int | None = RATE) -> DataFrame:
    """w, n: how often every word of ``least`` letters occurs.  Words are runs of
    Latin letters with A-Z in lower case.  With a ``rate``, a (document, word) pair
    whose checksum it divides loses the letter at the checksum modulo the length."""
    def tally(into: Counter, doc_id: int | None, text: str) -> None:
        prefix = f"{'' if doc_id is None else doc_id}:".encode()
        # Every letter of the class is one byte; what is none becomes a question mark.
        for run, n in Counter(_runs(text.encode("latin-1", "replace").lower())).items():
            if len(run) < least:
                continue
            if rate:
                h = zlib.crc32(prefix + (run if run.isascii() else run.decode("latin-1").encode()))
                if h % rate == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < least:
                        continue
            into[run] += n

    def run(batches):
        def flush():
            out = pa.record_batch({"w": pa.array([w.decode("latin-1") for w in held], pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return out

        held: Counter = Counter()
        for b in batches:
            for part in sliced(b, "text", BATCH_CHARS):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    tally(held, doc_id, text or "")
                    if len(held) > REMEMBER:
                        yield flush()
        yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))


def _number(batches):
    """Rows of a sorted range (key) -> key, part, base, shared, nodes.  ``nodes[d]`` is
    the offset that numbers the prefix of d letters, ``base`` the offset of the word,
    ``shared`` the letters it has in common with the range's first word."""
    part, offset, last, nodes, shared = TaskContext.get().partitionId(), 0, None, [0], 0
    for b in batches:
        out = []
        for key in b.column("key").to_pylist():
            if last is None:
                common, shared = 0, len(key)
            else:
                common = len(os.path.commonprefix((last, key)))
                shared = min(shared, common)
            base, nodes = offset, nodes[:common + 1] + [offset + d for d in range(common + 1, len(key) + 1)]
            out.append((key, base, shared, nodes))
            offset, last = offset + len(key) + 1, key
        yield pa.record_batch({
            "key": pa.array([x[0] for x in out], pa.string()), "part": pa.array([part] * len(out), pa.int64()),
            "base": pa.array([x[1] for x in out], pa.int64()), "shared": pa.array([x[2] for x in out], pa.int64()),
            "nodes": pa.array([x[3] for x in out], pa.list_(pa.int64()))})


def numbered(keys: DataFrame) -> DataFrame:
    """key, place (in the order of the keys), nodes (a number for the prefix of every
    length, from the empty one on) of distinct non-null strings (column key)."""
    spark = keys.sparkSession
    rows = written(keys.select("key").repartitionByRange("key").sortWithinPartitions("key").mapInArrow(
        _number, "key string, part long, base long, shared long, nodes array<long>"), "trie")
    ends = rows.groupBy("part").agg(F.min("key").alias("first"), F.max_by(F.struct("key", "shared", "nodes"), "base").alias("last")).orderBy("part").collect()
    passed, before, handed = [], None, []
    for r in ends:                                           # one row per range
        if before is not None:
            common = len(os.path.commonprefix((before["last"]["key"], r["first"])))
            old = min(before["last"]["shared"], len(handed) - 1)
            handed = [handed[d] if d <= old else (before["part"] << RANGE_BITS) + before["last"]["nodes"][d] for d in range(common + 1)]
            passed.append((r["part"], handed))
        before = r
    of_range = spark.createDataFrame(passed, "part long, handed array<long>")
    # Never a negative length: without a range before, no node is handed on.
    n = F.least(F.col("shared") + 1, F.size("handed")).cast("int")
    high = F.shiftleft("part", RANGE_BITS)
    nodes = F.concat(F.slice("handed", F.lit(1), n), F.transform(F.slice("nodes", n + 1, F.greatest(F.size("nodes") - n, F.lit(0))), lambda x: x + high))
    return rows.join(of_range, "part", "left").withColumn("handed", F.coalesce("handed", F.array().cast("array<long>"))).select(
        "key", (F.col("base") + high).alias("place"), nodes.alias("nodes"))


def _pairs(words: DataFrame) -> DataFrame:
    """p, s, place, n, out (a position is left out), first (the first of its equal letters)."""
    size = F.length("w")
    left_out = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("fore", i).alias("p"), F.get("back", size - 1 - i).alias("s"), F.lit(True).alias("out"),
        ((i == 0) | (F.substring("w", i + 1, 1) != F.substring("w", i, 1))).alias("first")))
    between = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("fore", i).alias("p"), F.get("back", size - i).alias("s"), F.lit(False).alias("out"), F.lit(False).alias("first")))
    return words.select("place", "n", F.inline(F.concat(left_out, between)))


def neighbours(words: DataFrame) -> DataFrame:
    """place, n_near, near_n, near (the place of the most frequent near word, of
    equals the first in order) of the words that have any; ``words``: w, n, place, fore, back."""
    group = Window.partitionBy("p", "s")
    member = F.struct("n", (-F.col("place")).alias("at"))
    rows = _pairs(words).withColumn("member", member).withColumn("_size", F.count("*").over(group)).filter("_size > 1")
    rows = (rows.withColumn("_outs", F.count_if("out").over(group)).withColumn("_firsts", F.count_if("first").over(group))
            .withColumn("_top", F.max(F.when(F.col("out"), F.col("member"))).over(group))
            .withColumn("_top_first", F.max(F.when(F.col("first"), F.col("member"))).over(group))
            .withColumn("_whole", F.max(F.when(~F.col("out"), F.col("member"))).over(group))
            .withColumn("_second", F.max(F.when(F.col("out") & (F.col("member") != F.col("_top")), F.col("member"))).over(group)))
    other = F.when(F.col("member") == F.col("_top"), F.col("_second")).otherwise(F.col("_top"))
    whole = F.when(F.col("first"), F.col("_whole"))
    near = F.when(F.col("out"), F.col("_outs") - 1 + whole.isNotNull().cast("long")).otherwise(F.col("_firsts"))
    best = F.when(F.col("out"), F.greatest(other, whole)).otherwise(F.col("_top_first"))
    return rows.select("place", near.alias("near"), best.alias("best")).filter("near > 0").groupBy("place").agg(
        F.sum("near").alias("n_near"), F.max("best").alias("best")).select(
        "place", "n_near", F.col("best.n").alias("near_n"), (-F.col("best.at")).alias("near"))


def roots(links: DataFrame) -> DataFrame:
    """place, root (the last form that following ``form`` leads to) of rows place,
    form.  Every round doubles the steps; a form is ``TIMES`` as frequent as its
    variant, so chains are short.  Rounds are written, which cuts the lineage."""
    spark = links.sparkSession
    path = write(links.select("place", F.col("form").alias("root")), "forms")
    while True:
        now = reread(spark, path, "place long, root long")
        onward = now.select(F.col("place").alias("_from"), F.col("root").alias("_to"))
        step = now.join(onward, F.col("root") == F.col("_from"), "left")
        new = write(step.select("place", F.coalesce("_to", "root").alias("root"), F.col("_to").isNotNull().alias("moved")), "forms")
        moved = not reread(spark, new, "place long, root long, moved boolean").filter("moved").isEmpty()
        discard(spark, path)
        path = new
        if not moved:
            return reread(spark, path, "place long, root long")


def dictionary(counted: DataFrame) -> DataFrame:
    """w, n, place, fore, back: the words (rows w, n; distinct) with the numbers of
    their nodes in both tries."""
    fore = numbered(counted.select(F.col("w").alias("key")))
    back = numbered(counted.select(F.reverse("w").alias("key")))
    return counted.join(fore.select(F.col("key").alias("w"), "place", F.col("nodes").alias("fore")), "w").join(
        back.select(F.reverse("key").alias("w"), F.col("nodes").alias("back")), "w")


def variants(counted: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every distinct word (rows w, n)."""
    words = written(dictionary(written(counted.select("w", "n"), "words")), "dictionary")
    near = written(neighbours(words), "near")
    per = words.select("w", "n", "place").join(near, "place", "left")
    formed = F.col("near_n") >= times * F.col("n")
    per = per.select("w", "n", "place", "n_near", F.when(formed, F.col("near")).alias("form"), F.when(formed, F.col("near_n")).alias("form_n"))
    of = roots(per.filter("form is not null").select("place", "form"))
    name = words.select(F.col("place").alias("_place"), F.col("w").alias("_w"))
    # Only words that have a form look up names.
    linked = of.withColumnRenamed("place", "_p").join(per.select("place", "form"), F.col("_p") == F.col("place")).select("place", "form", "root")
    linked = linked.join(name, F.col("form") == F.col("_place")).select("place", "root", F.col("_w").alias("form_w"))
    linked = linked.join(name, F.col("root") == F.col("_place")).select("place", "form_w", F.col("_w").alias("root_w"))
    return per.join(linked, "place", "left").select(
        F.col("w").alias("word"), F.col("form_w").alias("form"), F.coalesce("root_w", "w").alias("root"),
        "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def group(docs: DataFrame) -> DataFrame:
    """``variants`` of the words that occur ``LEAST_COUNT`` times in ``docs``."""
    return variants(counts(docs).filter(F.col("n") >= LEAST_COUNT))
