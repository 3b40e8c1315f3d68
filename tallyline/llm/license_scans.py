"""License scans: Dice coefficient over word bigrams against licence texts.

The unit of comparison is a sentence, a line, a paragraph or the whole text of
a document, normalised to lower-case words.  Dice(A, B) = 2 |A & B| / (|A| +
|B|) over the sets of word bigrams, so a template of n bigrams can only match
units of n * t / (2 - t) to n * (2 - t) / t bigrams at the threshold t: other
templates are pruned by size before any comparison.

A unit that matches a template shares at least n * t / (2 - t) of its bigrams,
so it holds one of any n - ceil(n t / (2 - t)) + 1 of them.  Per template the
bigrams with the longest words are taken; texts without any of those words
cannot match and are not cut into units (this loses nothing).

Everything is one projection of native expressions; the templates are a
constant of the plan (a fixed table of a few dozen texts), so there is no join
and no shuffle.

Defined results: null and empty texts have no licence; of several licences of
equal similarity the first by name is reported; repeated rows get one result
each; an empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .license_texts import TEMPLATES

DICE = 0.8
NOT_WORD = r"[^\p{L}\p{N}]+"
CUTS = (r"\n", r"[.!?]+\s+|\n", r"\n[ \t]*\n")       # lines, sentences, paragraphs


def template_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def needed(n: int, dice: float = DICE) -> int:
    """Bigrams that a unit shares at least with a template of n bigrams that it matches."""
    return math.ceil(n * dice / (2 - dice) - 1e-9)


def anchors(dice: float = DICE, templates=TEMPLATES) -> list[str]:
    """Words of which every matching unit holds at least one."""
    out = set()
    for _, text in templates:
        grams = template_bigrams(text)
        longest = sorted(grams, key=lambda g: (-max(map(len, g.split())), g))
        out.update(max(g.split(), key=lambda w: (len(w), w)) for g in longest[:len(grams) - needed(len(grams), dice) + 1])
    return sorted(out)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), NOT_WORD, " "))


def _bigrams(unit: Column) -> Column:
    w = F.split(unit, " ")
    return F.array_distinct(F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))),
                                       lambda a, b: F.concat(a, F.lit(" "), b)))


def scan(docs: DataFrame, dice: float = DICE, templates=TEMPLATES) -> DataFrame:
    """doc_id, license (the best match), dice (its coefficient), n_units (units
    that match), licenses (all that match, sorted, comma-joined)."""
    t = F.coalesce(F.col("text"), F.lit(""))
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.array(*map(F.lit, template_bigrams(text))).alias("grams")) for name, text in templates])
    maybe = F.arrays_overlap(F.split(normalised(t), " "), F.array(*map(F.lit, anchors(dice, templates))))
    rows = docs.select("doc_id", F.when(maybe, t).alias("_t"))
    cut = F.array_distinct(F.transform(F.concat(*[F.split("_t", c) for c in CUTS], F.array("_t")), normalised))
    rows = rows.select("doc_id", F.filter(cut, lambda u: F.contains(u, F.lit(" "))).alias("_u"))
    sizes = [len(template_bigrams(text)) for _, text in templates]
    low, high = min(sizes) * dice / (2 - dice), max(sizes) * (2 - dice) / dice
    # Words minus one bounds the distinct bigrams from above; repeats can only lower them.
    rows = rows.select("doc_id", F.filter(F.transform("_u", _bigrams), lambda g: F.size(g).between(low, high)).alias("_g"))

    def matches(g: Column) -> Column:
        fit = F.filter(table, lambda x: F.size(g).between(F.size(x["grams"]) * dice / (2 - dice), F.size(x["grams"]) * (2 - dice) / dice))
        scored = F.transform(fit, lambda x: F.struct(
            (F.lit(2.0) * F.size(F.array_intersect(g, x["grams"])) / (F.size(g) + F.size(x["grams"]))).alias("dice"), x["name"].alias("name")))
        return F.filter(scored, lambda x: x["dice"] >= dice)

    rows = rows.select("doc_id", F.filter(F.transform("_g", matches), lambda m: F.size(m) > 0).alias("_m"))
    every = F.flatten("_m")
    best = F.array_max(F.transform(every, lambda x: x["dice"]))
    rows = rows.select("doc_id", F.size("_m").alias("_n"), every.alias("_all"), best.alias("_best"))
    first = F.array_min(F.transform(F.filter("_all", lambda x: x["dice"] == F.col("_best")), lambda x: x["name"]))
    names = F.array_sort(F.array_distinct(F.transform("_all", lambda x: x["name"])))
    return rows.select("doc_id", first.alias("license"), F.coalesce("_best", F.lit(0.0)).alias("dice"),
                       F.greatest(F.col("_n"), F.lit(0)).cast("long").alias("n_units"), F.coalesce(F.array_join(names, ","), F.lit("")).alias("licenses"))
