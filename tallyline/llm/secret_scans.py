"""Secret scans with corpus-wide ownership frequency.

Candidates are found by regular expressions as spans.  The SHA-256 of every
candidate's value is aggregated over the whole corpus by distinct owners and
distinct repositories: a value that a larger share of the owners, or of the
repositories, carries is a widely copied example (documentation, fixtures), a
value that stays with few and looks random is a live-looking credential.  Base kinds (assign, access, hex)
are always reported; the wider kinds (private-key blocks, prefixed tokens,
JSON web tokens, passwords in URLs) are reported only when live-looking.

The owner is the ``source`` of a document, the repository its source and
language.  Texts are scanned in one projection and never shuffled: only the
candidates' hashes travel, first reduced to distinct (hash, owner, repository)
map-side, and verdicts come back by hash.  A value that a third of all
documents carry is therefore a few rows after the first aggregation, and the
join back to its documents is one that adaptive execution can split.

Defined results: null or empty texts have no spans; a null source is an owner
of its own; repeated rows get the same result each; an empty table gives an
empty table; further columns are ignored by ``scan`` and kept by ``mask``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fenced, written
from .spans import found, joined, placed, replaced

# Up to such a share of the owners and of the repositories that hold candidates at
# all (but one owner and two repositories) a value counts as owner-specific.
OWNER_SHARE, REPO_SHARE, MIN_REPOS = 0.05, 0.05, 2
MIN_ENTROPY = 2.5       # bits per character of a live-looking value
ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# kind, pattern, pattern of the value inside the match (group 1), characters the value needs
BASE = [
    ("assign", ASSIGN, ASSIGN, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", r"(.+)", 16),       # whole runs: the same as all runs of 16 and more
    ("hex", r"[0-9a-f]{32,}", r"(.+)", 32),
]
WIDER = [
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----", r"KEY-----([A-Za-z0-9+/=\s]+)-----", 40),
    ("prefixed", r"\b(?:gh[pousr]_|github_pat_|xox[abprs]-|sk_live_|sk-|glpat-|AIza)[A-Za-z0-9_-]{16,}", r"(.+)", 16),
    ("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"(.+)", 26),
    ("url", r"[a-z][a-z0-9+.-]*://[^\s:/@]+:[^\s:/@]{6,}@", r"://[^\s:/@]+:([^\s:/@]+)@", 6),
]
KINDS = [k for k, *_ in BASE + WIDER]
# A cheap necessary condition of each pattern.
HINTS = {"access": "AKIA", "pem": "PRIVATE KEY-----", "jwt": "eyJ", "url": "://"}
CANDIDATE = "array<struct<s:int,k:int,e:int,kind:string,h:string,looks:boolean>>"


def entropy(v: Column) -> Column:
    """Bits per character of a string."""
    chars = F.split(v, "")
    n = F.length(v).cast("double")
    each = F.transform(F.array_distinct(chars), lambda c: (F.length(v) - F.length(F.replace(v, c, F.lit("")))).cast("double") / n)
    return F.aggregate(each, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p)).otherwise(F.lit(0.0)))


def _valued(k: int, kind: str, pattern: str, value: str, least: int) -> Column:
    """The matches of one kind whose value has ``least`` characters: s, k, e, kind, v."""
    def row(x: Column) -> Column:
        v = x["v"] if value == r"(.+)" else F.regexp_extract(x["v"], value, 1)
        return F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), F.lit(kind).alias("kind"), v.alias("v"))

    return F.filter(F.transform(placed(F.col(f"_g_{kind}"), F.col(f"_h_{kind}")), row), lambda x: F.length(x["v"]) >= least)


def candidates(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """``keep`` and ``c``: the candidates of every text ordered by start, kind."""
    t = F.coalesce(F.col("text"), F.lit(""))
    rules = BASE + WIDER
    cols = []
    for kind, pattern, _, _ in rules:
        gaps, hits = found(t, pattern, F.contains(t, F.lit(HINTS[kind])) if kind in HINTS else None)
        cols += [gaps.alias(f"_g_{kind}"), hits.alias(f"_h_{kind}")]
    step = docs.select(*keep, *cols)
    names = step.columns[:len(keep)]
    lists = [_valued(k, *rule) for k, rule in enumerate(rules)]
    step = step.select(*names, F.sort_array(F.concat(*lists)).alias("_c"))
    return step.select(*names, F.transform("_c", lambda x: F.struct(
        x["s"], x["k"], x["e"], x["kind"], F.sha2(x["v"], 256).alias("h"),
        ((entropy(x["v"]) >= MIN_ENTROPY) & x["v"].rlike("[0-9]") & x["v"].rlike("[A-Za-z]")).alias("looks"))).cast(CANDIDATE).alias("c"))


def owners(cands: DataFrame) -> DataFrame:
    """h, n_owners, n_repos of every candidate value in the corpus (columns source, lang, c)."""
    one = cands.filter(F.size("c") > 0).select("source", "lang", F.explode("c.h").alias("h"))
    distinct = one.groupBy("h", "source", "lang").agg(F.lit(1).alias("_"))
    return distinct.groupBy("h").agg(
        (F.count_distinct("source") + F.max(F.col("source").isNull().cast("int"))).cast("long").alias("n_owners"), F.count("*").alias("n_repos"))


def judged(rows: DataFrame, corpus: DataFrame) -> DataFrame:
    """``rows`` (with c) plus ``spans``: array<struct<s,k,e,kind,live>>; the
    frequencies come from ``corpus`` (source, lang, c).

    Verdicts are made per distinct list of values, one row per value, and come
    back as a list in the same order, so a text's copies share one and no list is
    carried beside its values.  Rows without candidates get keys of their own,
    which spreads them."""
    listed = F.sha2(F.array_join("c.h", ","), 256)
    held = corpus.filter(F.size("c") > 0)
    lists = held.groupBy(listed.alias("_key")).agg(F.first("c.h").alias("hs"))
    total = held.agg(F.struct((F.count_distinct("source") + F.max(F.col("source").isNull().cast("int"))).alias("owners"),
                              F.count_distinct(F.struct("source", "lang")).alias("repos")).alias("t")).scalar()
    few = ((F.col("n_owners") <= F.greatest(F.lit(1), F.floor(total["owners"] * OWNER_SHARE)))
           & (F.col("n_repos") <= F.greatest(F.lit(MIN_REPOS), F.floor(total["repos"] * REPO_SHARE))))
    verdict = (lists.select("_key", F.posexplode("hs").alias("pos", "h")).join(owners(corpus).select("h", few.alias("few")), "h").groupBy("_key")
               .agg(F.sort_array(F.collect_list(F.struct("pos", "few"))).alias("few")))
    key = F.when(F.size("c") > 0, listed).otherwise(F.concat(F.lit("no "), F.xxhash64(*rows.columns[:1]).cast("string")))
    live = F.filter(F.zip_with("c", F.coalesce("few", F.array().cast("array<struct<pos:int,few:boolean>>")), lambda x, y: F.struct(
        x["s"], x["k"], x["e"], x["kind"], (x["looks"] & y["few"]).alias("live"))), lambda x: (x["k"] < len(BASE)) | x["live"])
    return rows.withColumn("_key", key).join(verdict, "_key", "left").withColumn("spans", live).drop("_key", "few")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, all spans,
    and the numbers of live-looking and widely copied ones."""
    cands = written(candidates(docs, [F.col("doc_id"), F.col("source"), F.col("lang")]), "secret-candidates")
    base = F.filter("spans", lambda x: x["k"] < len(BASE))
    count = [_count(k).alias(f"n_{k}") for k, *_ in BASE]
    return judged(cands, cands).select(
        "doc_id", *count, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda x: x["live"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda x: ~x["live"])).cast("long").alias("n_copied"))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with their own columns; in the text, live-looking secrets become
    ``<secret:kind>`` and the other base spans ``<example:kind>``."""
    corpus = written(fenced(candidates(docs, [F.col("source"), F.col("lang")]), F.size("c") > 0), "secret-candidates")
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")
    rows = judged(candidates(docs, [own]), corpus)
    to = F.transform("spans", lambda x: F.struct(x["s"], x["e"], F.concat(
        F.when(x["live"], F.lit("<secret:")).otherwise(F.lit("<example:")), x["kind"], F.lit(">")).alias("to")))
    text = replaced(F.col("own.text"), to)
    return rows.select(*[(text if c == "text" else F.col(f"own.`{c}`")).alias(c) for c in docs.columns])
