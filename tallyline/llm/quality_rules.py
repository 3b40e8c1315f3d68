"""Quality rules: a threshold table compiled into one Spark projection.

Every rule compares one metric of the text (lengths, symbol ratio, stop-word
ratio, line ratios) with a bound; ``RULES`` is data, ``verdict`` folds it into
one boolean expression and a list of the failed rules.  There is no user
function and no shuffle: the whole operator is a projection over the scan.

Defined results: a null or empty text has no words and fails ``base_words``;
white space alone likewise; repeated rows get one result each; an empty table
gives an empty table.  Only ``doc_id`` and ``text`` are read, so other columns
of any name do not clash.  Repeated 3-word windows are compared by 64-bit
hashes of their three words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, fenced, words

NEITHER = r"[^ \t-\r#*$%&|<>]+"     # neither white space nor a counted symbol
HAS_WORD = r"[^ \t-\r]"

# Common function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is that for it with as was on are be this by from at or an "
    "der die das und zu den von mit nicht ist ein eine auf für als auch im des "
    "le la les de des et un une du que qui dans en pour pas est au sur par ce "
    "el los las y que en un una por con para se del no lo"
).split()

# name, metric, comparison that fails, threshold.  Metrics are the columns of
# ``metrics``.
RULES: list[tuple[str, str, str, float]] = [
    ("base_words", "n_words", "<", 50),
    ("base_repeats", "repeat_ratio", ">", 0.5),
    ("short_words", "mean_word_chars", "<", 2.0),
    ("long_words", "mean_word_chars", ">", 20.0),
    ("symbols", "symbol_ratio", ">", 0.3),
    ("stop_words", "stop_ratio", "<", 0.01),
    ("duplicate_lines", "dup_line_ratio", ">", 0.7),
]
BASE = ("base_words", "base_repeats")


def _stop_hashes() -> list[Column]:
    """Hashes of the stop words, in lower case and capitalised; the optimizer
    folds them into one constant set."""
    return [F.xxhash64(F.lit(v)) for w in STOP_WORDS for v in (w, w.capitalize())]


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Columns ``_row`` (the row of ``df``), ``_c`` (counts of the text) and ``_m``
    (the metrics of the rules).

    Arrays of words are turned into arrays of 64-bit hashes at once, so that
    the later projections copy little."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(HAS_WORD))
    one = df.select(row, F.transform(words(F.col(text)), lambda w: F.xxhash64(w)).alias("_w"), F.length(t).alias("_len"),
                    F.regexp_replace(t, NEITHER, "").alias("_rest"),
                    F.struct(F.size(lines).alias("n"), F.size(F.array_distinct(lines)).alias("d")).alias("_lines"))
    two = one.select("_row", "_len", "_rest", "_lines", F.size("_w").cast("long").alias("_n"),
                     F.size(F.filter("_w", lambda h: h.isin(*_stop_hashes()))).alias("_stop"),
                     F.transform(F.slice("_w", F.lit(1), F.greatest(F.size("_w") - 2, F.lit(0))),
                                 lambda h, i: F.xxhash64(h, F.get("_w", i + 1), F.get("_w", i + 2))).alias("_tri"))
    # Most texts repeat no window; only the others pay for the sort that finds the repeats.
    three = two.select("_row", "_len", "_rest", "_lines", "_n", "_stop", F.when(
        F.size(F.array_distinct("_tri")) < F.size("_tri"),
        F.sort_array(F.transform("_tri", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("_s"))
    four = three.select("_row", "_len", "_rest", "_lines", "_n", "_stop", F.transform(F.filter(
        "_s", lambda x, k: F.get("_s", k - 1)["h"].eqNullSafe(x["h"]) | F.get("_s", k + 1)["h"].eqNullSafe(x["h"])), lambda x: x["i"]).alias("_at"))
    covered = F.size(F.array_distinct(F.concat("_at", F.transform("_at", lambda i: i + 1), F.transform("_at", lambda i: i + 2))))
    spaces = F.length(F.regexp_replace("_rest", WORD, ""))
    five = four.select("_row", F.struct(
        F.col("_n").alias("n_words"), (F.col("_len") - spaces).cast("long").alias("word_chars"),
        (F.length("_rest") - spaces).cast("long").alias("n_symbols"),
        (F.col("_lines.n") - F.col("_lines.d")).cast("long").alias("n_dup_lines"),
        F.when(F.col("_at").isNotNull(), covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.col("_stop").alias("n_stop"), F.col("_lines.n").alias("n_lines")).alias("_c"))
    n = F.greatest(F.col("_c.n_words"), F.lit(1))
    return five.select("_row", "_c", F.struct(
        F.col("_c.n_words").alias("n_words"),
        (F.col("_c.n_repeat_words") / n).alias("repeat_ratio"),
        (F.col("_c.word_chars") / n).alias("mean_word_chars"),
        (F.col("_c.n_symbols") / n).alias("symbol_ratio"),
        (F.col("_c.n_stop") / n).alias("stop_ratio"),
        (F.col("_c.n_dup_lines") / F.greatest(F.col("_c.n_lines"), F.lit(1))).alias("dup_line_ratio"),
    ).alias("_m"))


def _fails(metric: str, op: str, bound: float) -> Column:
    m = F.col(f"_m.{metric}")
    return m < bound if op == "<" else m > bound


def verdict(rules=RULES) -> tuple[Column, Column, Column]:
    """(base_failed, kept, names of the failed rules) compiled from the table."""
    base = reduce(Column.__or__, [_fails(m, op, b) for n, m, op, b in rules if n in BASE], F.lit(False))
    any_ = reduce(Column.__or__, [_fails(m, op, b) for _, m, op, b in rules], F.lit(False))
    names = F.filter(F.array(*[F.when(_fails(m, op, b), F.lit(n)) for n, m, op, b in rules]), lambda x: x.isNotNull())
    return base, ~any_, names


def score(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, counts, base_failed, kept and the failed rules of every row."""
    base, kept, names = verdict(rules)
    c = counts(docs.select("doc_id", "text"))
    return c.select(F.col("_row.doc_id").alias("doc_id"), *[F.col(f"_c.{x}").alias(x) for x in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base.alias("base_failed"), kept.alias("kept"), F.array_join(names, ",").alias("failed_rules"))


def keep(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass every rule, with their own columns."""
    _, kept, _ = verdict(rules)
    return fenced(counts(docs), kept).select("_row.*")
