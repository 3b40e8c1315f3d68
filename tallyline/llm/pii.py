"""Personal data with information-theoretic sanitisation.

Base entities (e-mail, IP address, card, phone) are found as spans.  The words
of a text can reveal an entity even when it is masked; the corpus tells how
strongly: with N documents, n(e) that hold entity e, n(t) that hold term t and
n(e, t) that hold e and, outside all entities, t,

    disclosure(e, t) = log(N n(e, t) / (n(e) n(t))) / log(N / n(e))

is the share of e's information content that t gives away (pointwise mutual
information over information content).  A term that reaches ``GENERALISE`` for
any entity is reported as a span of kind ``term`` wherever the corpus holds it
outside entities, and replaced by a placeholder; one that reaches ``REMOVE``
is removed.

Counting pairs.  As n(e, t) <= n(e), a pair can only reach the threshold G if
n(t) <= N (n(e) / N) ** G; more frequent terms are left out before entities and
terms meet, which changes no result.  Entities that occur in the same texts
have the same counts, and so have terms: both meet as classes (128 bits of the
set of texts), so a text with many entities of its own and many words of its
own adds one pair for them, not all pairs.

Texts are scanned in projections and never shuffled for their entities.  Only
the words of texts with entities travel, once per distinct text with the number
of its copies; term counts over the corpus combine map-side; a filter of a
fixed number of bits leaves words that are no flagged terms, and another one
texts without such words, out of the search of the corpus, which joins then make
exact; spans of terms come back by the
hash of the text, and empty texts get keys of their own, so no
key gathers them.

Defined results: null or empty texts have no spans; repeated rows get the same
result each and count as documents; an empty table gives an empty table;
further columns are ignored by ``scan`` and kept by ``sanitise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .spans import blanked, found, joined, placed, replaced

KINDS = ("email", "ip", "card", "phone")
# A run of digits with single separators is matched only where it begins and
# ends, which leaves out runs of other lengths at once.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": ".", "phone": "+"}
OCTETS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.|$)){4}$"
TERM = r"\p{L}{4,}"
GENERALISE, REMOVE = 0.9, 0.98
BITS = 1 << 24             # of a filter of terms or texts, two per value
SPANS = "array<struct<k:int,s:int,e:int,kind:string,key:string>>"


def luhn(digits: Column) -> Column:
    ds = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, F.lit(9)).otherwise(F.lit(0))))
    return F.aggregate(ds, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return v.rlike(OCTETS)
    if kind == "card":
        return luhn(_digits(v))
    if kind == "phone":
        return F.length(_digits(v)).between(9, 15)
    return F.lit(True)


def _entities(k: int, kind: str) -> Column:
    """Valid matches of one kind: k, s, e, kind, key (the normalised value)."""
    def row(x: Column) -> Column:
        value = _digits(x["v"]) if kind in ("card", "phone") else F.lower(x["v"])
        return F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"),
                        F.concat(F.lit(f"{kind}:"), value).alias("key"))

    hits = placed(F.col(f"_g_{kind}"), F.col(f"_h_{kind}"))
    return F.transform(F.filter(hits, lambda x: _valid(kind, x["v"])), row)


def _key(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def entities(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep``, spans (by kind, then start), tk (key of the text) and, of texts with spans, t (the text)."""
    t = F.coalesce(F.col("text"), F.lit(""))
    cols = []
    for kind in KINDS:
        gaps, hits = found(t, PATTERNS[kind], F.contains(t, F.lit(HINTS[kind])) if kind in HINTS else None)
        cols += [gaps.alias(f"_g_{kind}"), hits.alias(f"_h_{kind}")]
    step = docs.select(*keep, t.alias("_t"), *cols)
    names = step.columns[:len(keep)]
    step = step.select(*names, "_t", F.concat(*[_entities(k, kind) for k, kind in enumerate(KINDS)]).cast(SPANS).alias("spans"))
    own = F.concat(F.lit("no "), F.xxhash64(*names[:1]).cast("string")).cast("binary")
    return step.select(*names, "spans", F.when(F.col("_t") == "", own).otherwise(_key(F.col("_t"))).alias("tk"),
                       F.when(F.size("spans") > 0, F.col("_t")).alias("t"))


def _words(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0)))


def _rest() -> Column:
    """The text ``t`` with its entities blanked."""
    return blanked(F.col("t"), F.array_sort(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e")))))


def term_counts(docs: DataFrame) -> DataFrame:
    """term, n_t: the number of documents that hold each term."""
    return docs.select(F.explode(_words(F.coalesce(F.col("text"), F.lit("")))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))


def _classed(pairs: DataFrame, item: str, n: str) -> DataFrame:
    """item, n (its documents), x, y: the 128 bits that items of the same texts share."""
    return pairs.groupBy(item).agg(F.sum("m").alias(n), F.bit_xor(F.xxhash64("tk")).alias("x"), F.bit_xor(F.xxhash64("tk", F.lit(1))).alias("y"))


def disclosing(docs: DataFrame, found_: DataFrame) -> DataFrame:
    """tk, terms: array<struct<s,e,drop>> of every text with terms to sanitise, from the rows of ``entities``."""
    n = float(max(1, found_.count()))
    per = written(found_.filter("t is not null").groupBy("tk").agg(
        F.count("*").alias("m"), F.first("t").alias("t"), F.first("spans").alias("spans")), "pii-texts")
    held = per.select("tk", "m", F.explode(F.array_distinct("spans.key")).alias("key"))
    keys = _classed(held, "key", "n_e").filter(F.col("n_e") < n)
    e = written(held.join(keys, "key").select("tk", "m", "x", "y", "n_e").distinct(), "pii-entity-classes")
    words = written(per.select("tk", "m", _rest().alias("t")).select("tk", "m", F.explode(_words(F.col("t"))).alias("term")), "pii-words")
    # An inner join: a semi join would be pushed below the counting, where it
    # meets every word of the corpus instead of one row per term and task.
    terms = _classed(words, "term", "n_in").join(term_counts(docs), "term")
    largest = e.agg(F.max("n_e")).first()[0] or 0
    bound = lambda n_e: n * F.pow(n_e / n, F.lit(GENERALISE)) * 1.000001 + 1e-6
    terms = written(terms.filter(F.col("n_t") <= bound(F.lit(float(largest)))).select(
        "term", "n_t", "n_in", F.col("x").alias("u"), F.col("y").alias("v")), "pii-term-counts")
    t = words.join(terms, "term").select("tk", "u", "v", "n_t").distinct()
    n_et = e.join(t, "tk").filter(F.col("n_t") <= bound(F.col("n_e"))).groupBy("x", "y", "n_e", "u", "v", "n_t").agg(F.sum("m").alias("n_et"))
    info = F.log(F.lit(n) / F.col("n_e"))
    share = F.log(F.lit(n) * F.col("n_et") / (F.col("n_e") * F.col("n_t"))) / info
    best = n_et.withColumn("share", share).filter(F.col("share") >= GENERALISE).groupBy("u", "v", "n_t").agg(F.max("share").alias("share"))
    flagged = written(terms.join(best, ["u", "v", "n_t"]).select(
        "term", (F.col("share") >= REMOVE).alias("drop"), (F.col("n_t") > F.col("n_in")).alias("elsewhere")), "pii-flagged")
    inside = _placed_terms(per.select("tk", _rest().alias("t")), words.join(flagged, "term").select("tk", "term"))
    wide = flagged.filter("elsewhere")
    bits = _bits(wide, "term")
    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("t")).select(_key(F.col("t")).alias("tk"), "t")
    # Words are tested in rows, not inside a lambda, which Spark interprets.
    found_words = texts.select("tk", F.explode(F.regexp_extract_all(F.lower("t"), F.lit(TERM), F.lit(0))).alias("term")).filter(_in(bits, F.col("term")))
    # Texts with entities have theirs from the blanked text.
    holding = written(found_words.distinct().join(wide, "term").select("tk", "term").join(per.select("tk"), "tk", "left_anti"), "pii-holding")
    others = _placed_terms(texts.filter(_in(_bits(holding, "tk"), F.col("tk"))), holding)
    every = inside.unionByName(others).join(flagged, "term").select("tk", "s", "e", "drop")
    return written(every.groupBy("tk").agg(F.sort_array(F.collect_list(F.struct("s", "e", "drop"))).alias("terms")), "pii-spans")


def _bit(w: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(w, F.lit(seed)), F.lit(BITS))


def _bits(terms: DataFrame, column: str) -> Column:
    """A Bloom filter of a column's values as one constant: ``BITS`` bits as array<long>, whatever their number.
    It keeps rows that no join can match out of the shuffles."""
    bit = terms.select(F.explode(F.array(_bit(F.col(column), 0), _bit(F.col(column), 1))).alias("b"))
    set_ = bit.groupBy(F.shiftright("b", 6).alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(b % 64 as int)))").alias("bits"))
    every = terms.sparkSession.range(BITS // 64).withColumnRenamed("id", "i").join(set_, "i", "left")
    return every.agg(F.sort_array(F.collect_list(F.struct("i", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("x")).select("x.bits").scalar()


def _in(bits: Column, w: Column) -> Column:
    at = lambda b: F.getbit(F.get(bits, F.shiftright(b, 6).cast("int")), (b % 64).cast("int")) == 1
    return at(_bit(w, 0)) & at(_bit(w, 1))


def _placed_terms(texts: DataFrame, held: DataFrame) -> DataFrame:
    """tk, s, e, term: where the texts (tk, t) hold the terms that ``held`` (tk, term) names for them.
    One pattern per text finds its own terms, so its other words are never placed."""
    terms = F.array_join(F.sort_array(F.collect_set("term")), "|")
    patterns = held.groupBy("tk").agg(F.concat(F.lit(r"(?<!\p{L})(?iu:"), terms, F.lit(r")(?!\p{L})")).alias("p"))
    at = texts.join(patterns, "tk").select("tk", F.split("t", F.col("p"), -1).alias("g"), F.regexp_extract_all("t", F.col("p"), F.lit(0)).alias("h"))
    return at.select("tk", F.explode(placed(F.col("g"), F.col("h"))).alias("w")).select("tk", "w.s", "w.e", F.lower("w.v").alias("term")).distinct()


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts and digest of the base spans, all spans (base, then
    ``term``) and the number of terms."""
    rows = written(entities(docs, [F.col("doc_id")]), "pii-entities")
    terms = disclosing(docs, rows)
    out = rows.drop("t").join(terms, "tk", "left")
    term = F.transform(F.coalesce("terms", F.array().cast("array<struct<s:int,e:int,drop:boolean>>")), lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.lit("term").alias("kind")))
    base = F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))
    return out.select("doc_id", *[_count(k).alias(f"n_{k}") for k in KINDS], F.sha2(joined(F.col("spans")), 256).alias("base_sha256"),
                      joined(F.concat(base, term)).alias("spans"), F.size(term).cast("long").alias("n_terms"))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with their own columns; in the text, entities become ``<kind>``,
    disclosing terms ``<term>`` or nothing."""
    found_ = written(entities(docs, [F.col("doc_id")]), "pii-entities")
    terms = disclosing(docs, found_)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = entities(docs, [own]).drop("t").join(terms, "tk", "left")
    base = F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.concat(F.lit("<"), x["kind"], F.lit(">")).alias("to")))
    term = F.transform(F.coalesce("terms", F.array().cast("array<struct<s:int,e:int,drop:boolean>>")), lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), F.when(x["drop"], F.lit("")).otherwise(F.lit("<term>")).alias("to")))
    rows = rows.select("own", F.sort_array(F.concat(base, term)).alias("all"))
    text = replaced(F.col("own.text"), F.col("all"))
    return rows.select(*[(text if c == "text" else F.col(f"own.`{c}`")).alias(c) for c in docs.columns])
