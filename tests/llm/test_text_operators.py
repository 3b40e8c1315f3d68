"""Quality rules, secret scans, personal data, licences and BPE against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tallyline.llm import bpe, license_scans, pii, quality_rules, secret_scans, spans

from . import brute
from .conftest import by_id

VOCAB = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def fuzz(spark):
    rnd = random.Random(4)
    digits = "0123456789" * 3 + "   ---..++()@ab_%é😀\n"
    words = "the of and token secret password = : \" ' AKIA 0af 9bc de # $ a b c x1 \n".split(" ") + ["\n", "\t", "0123456789abcdef" * 2]
    rows = [(k, "".join(rnd.choice(digits) for _ in range(rnd.randrange(300)))) for k in range(150)]
    rows += [(1000 + k, rnd.choice(["", " ", "  "]).join(rnd.choice(words) for _ in range(rnd.randrange(200)))) for k in range(150)]
    return spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id bigint, text string, lang string, source string")


@pytest.fixture(params=["edge", "fuzz", "sf"])
def docs(request, edge_docs, fuzz, documents):
    return {"edge": edge_docs, "fuzz": fuzz, "sf": documents}[request.param]


def check(docs, got, expect, value):
    """Every row of ``docs`` has its row in ``got`` with the brute-force value."""
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert value(r) == expect(texts[r["doc_id"]]), (r["doc_id"], texts[r["doc_id"]])


def test_quality_counts(docs):
    check(docs, quality_rules.score(docs), brute.quality,
          lambda r: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed))


def test_quality_keeps_clean_and_drops_junk(spark, edge_docs):
    words = [f"w{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"]
    clean = " of the ".join(words)
    junk = " ### ".join(words)
    d = spark.createDataFrame([(1, clean), (2, junk), (3, "one two"), (4, None)], "doc_id bigint, text string")
    got = by_id(quality_rules.score(d))
    assert [got[k].kept for k in (1, 2, 3, 4)] == [True, False, False, False]
    assert "symbols" in got[2].failed_rules and got[4].failed_rules.startswith("base_words")
    assert [r.doc_id for r in quality_rules.keep(d).collect()] == [1]
    kept = quality_rules.keep(edge_docs)
    assert kept.columns == edge_docs.columns


def test_secrets(docs):
    check(docs, secret_scans.scan(docs), lambda t: (brute.digest(brute.secrets(t)), len(brute.secrets(t))),
          lambda r: (r.base_sha256, r.n_assign + r.n_access + r.n_hex))


def test_text_of_very_many_secrets(spark):
    """A checksum list: work and memory follow the number of its values."""
    digests = [hashlib.sha256(str(k).encode()).hexdigest() for k in range(20_000)]
    d = spark.createDataFrame([(1, "\n".join(digests), "s", "en"), (2, digests[7], "s", "en"), (3, "é " + digests[7] + " x", "t", "de")],
                              "doc_id long, text string, source string, lang string")
    got = by_id(secret_scans.scan(d))
    assert got[1].n_hex == 20_000 and got[1].base_sha256 == brute.digest([("hex", 65 * k, 65 * k + 64) for k in range(20_000)])
    assert (got[1].n_live, got[1].n_copied) == (19_999, 1) and got[2].n_copied == got[3].n_copied == 1 and got[3].spans == "hex:2:66"


def test_values_of_many_repositories_of_one_owner_are_examples(spark):
    value = hashlib.sha256(b"x").hexdigest()
    d = spark.createDataFrame([(k, value, "s", f"l{k}") for k in range(3)] + [(10, hashlib.sha256(b"y").hexdigest(), "s", None)],
                              "doc_id long, text string, source string, lang string")
    assert {r.doc_id: (r.n_live, r.n_copied) for r in secret_scans.scan(d).collect()} == {0: (0, 1), 1: (0, 1), 2: (0, 1), 10: (1, 0)}


def test_widely_copied_values_are_examples(spark):
    rows = [(k, "my token: widelycopied12345", f"s{k}", "en") for k in range(6)] + [
        (10, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ghp_abcdefghijABCDEFGHIJ0123456789', "s1", "en"), (11, "nothing", "s1", "en"),
        (12, None, None, None)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string")
    got = by_id(secret_scans.scan(d))
    assert (got[0].n_live, got[0].n_copied) == (0, 1) and (got[10].n_live, got[10].n_copied) == (3, 0)
    assert got[10].spans == "assign:0:49,hex:9:49,prefixed:51:85"
    masked = by_id(secret_scans.mask(d))
    assert masked[0].text == "my <example:assign>" and masked[10].text == '<secret:assign>" <secret:prefixed>'
    assert masked[11].text == "nothing" and masked[12].text is None and secret_scans.mask(d).columns == d.columns


def test_personal_data(docs):
    def expect(t):
        spans = brute.pii(t)
        return brute.digest(spans), [sum(k == x for k, _, _ in spans) for x in brute.PII]

    check(docs, pii.scan(docs), expect, lambda r: (r.base_sha256, [r.n_email, r.n_ip, r.n_card, r.n_phone]))


def test_terms_that_disclose_are_removed(spark):
    rows = [(k, "some words here zanzibarian john.doe@corp.example.com quixotically and the rest of words") for k in range(3)]
    rows += [(100 + k, "some words here and the rest of words") for k in range(50)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = by_id(pii.scan(d))
    assert got[0].spans == "email:28:53,term:16:27,term:54:66" and got[100].spans == ""
    clean = by_id(pii.sanitise(d))
    assert clean[0].text == "some words here  <email>  and the rest of words" and clean[100].text == rows[-1][1]


def licences(text):
    t = text or ""
    norm = lambda x: " ".join(re.findall(r"[^\W_]+", x.lower()))
    units = {norm(x) for c in license_scans.CUTS for x in re.split(c, t, flags=re.A)} | {norm(t)}
    best, n = [], 0
    for u in units:
        w = u.split(" ")
        g = {f"{a} {b}" for a, b in zip(w, w[1:])}
        hits = []
        for name, template in license_scans.TEMPLATES:
            b = set(license_scans.template_bigrams(template))
            dice = 2 * len(g & b) / (len(g) + len(b))
            if dice >= license_scans.DICE:
                hits.append((dice, name))
        n += bool(hits)
        best += hits
    if not best:
        return None, 0.0, 0, ""
    top = max(x for x, _ in best)
    return min(n for x, n in best if x == top), top, n, ",".join(sorted({n for _, n in best}))


def test_licenses(docs):
    check(docs, license_scans.scan(docs), licences, lambda r: (r.license, r.dice, r.n_units, r.licenses))


def test_license_full_text_with_an_edit(spark):
    text = license_scans.TEMPLATES[3][1].replace("Software", "Program", 1)
    d = spark.createDataFrame([(1, f"intro\n\n{text}\n\noutro"), (2, "the license of the version")], "doc_id bigint, text string")
    got = by_id(license_scans.scan(d))
    assert got[1].license == "MIT" and 0.8 <= got[1].dice < 1 and got[2].license is None


def test_bpe_equals_tiktoken(docs):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(VOCAB), special_tokens={})

    def expect(t):
        ids = enc.encode_ordinary(t or "")
        return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()

    check(docs, bpe.digests(docs, VOCAB, public_tokenizers.PATTERN), expect, lambda r: (r.n_tokens, r.ids_sha256, r.decoded_sha256))


def test_bpe_round_trip(edge_docs):
    ids = bpe.encode(edge_docs, VOCAB, public_tokenizers.PATTERN)
    texts = {r["doc_id"]: r["text"] or "" for r in edge_docs.collect()}
    assert {r["doc_id"]: r["text"] for r in bpe.decode(ids, VOCAB).collect()} == texts


def test_bpe_long_pieces_and_forgetting(monkeypatch):
    codec = bpe.Codec(bpe.load_ranks(VOCAB), public_tokenizers.PATTERN)
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(VOCAB), special_tokens={})
    texts = ["ab" * 3000, "thing" * 500, " " * 3000, "中文" * 800, "\x1c\x85​\xa0 ٣ \U0001F600", "a1b2" * 300]
    monkeypatch.setattr(bpe, "REMEMBER", 2)
    for _ in range(2):
        assert codec.encode_batch(texts) == [enc.encode_ordinary(t) for t in texts] and not codec.known


@pytest.mark.parametrize("op", [quality_rules.score, secret_scans.scan, pii.scan, license_scans.scan, quality_rules.keep, secret_scans.mask, pii.sanitise,
                                lambda d: bpe.digests(d, VOCAB, public_tokenizers.PATTERN)])
def test_empty_tables(edge_docs, op):
    assert op(edge_docs.limit(0)).count() == 0


def disclosing_terms(texts):
    """Terms that give away an entity, by all pairs of plain sets."""
    term = re.compile(r"[^\W\d_]{4,}")
    spans = [[(s, e, k) for k, s, e in brute.pii(t)] for t in texts]
    rest = [list(t) for t in texts]
    keys = []
    for t, xs, chars in zip(texts, spans, rest):
        held = set()
        for s, e, k in xs:
            chars[s:e] = "\n" * (e - s)
            held.add((k, re.sub("[^0-9]", "", t[s:e]) if k in ("card", "phone") else t[s:e].lower()))
        keys.append(held)
    rest = ["".join(c) for c in rest]
    outside = [set(term.findall(r.lower())) for r in rest]
    whole = [set(term.findall(t.lower())) for t in texts]
    n, out = len(texts), set()
    for key in set().union(*keys):
        with_key = [k for k in range(n) if key in keys[k]]
        if len(with_key) < n:
            for t in set().union(*[outside[k] for k in with_key]):
                n_et, n_t = sum(t in outside[k] for k in with_key), sum(t in w for w in whole)
                if math.log(n * n_et / (len(with_key) * n_t)) / math.log(n / len(with_key)) >= pii.GENERALISE:
                    out.add(t)
    return [sorted((m.start(), m.end()) for m in term.finditer(r) if m.group().lower() in out) for r in rest]


def test_terms_of_whole_texts_against_all_pairs(spark):
    rnd = random.Random(8)
    names = ["anna@example.org", "+49 30 1234567", "10.0.0.7", "bob@example.org", "éabcd@x.de"]
    vocabulary = [f"{a}{b}" for a in ("plain", "shore", "Water", "lamp") for b in ("ish", "man", "ed", "")] + ["anna", "example", "the"]
    rows = []
    for k in range(160):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(120))]
        if k % 4 == 0:
            who = rnd.randrange(len(names))
            words[rnd.randrange(len(words) + 1):0] = [names[who]] + ([names[(who + 1) % 5]] if k % 8 == 0 else [])
            words += ["filler"] * 60 + [f"Secretly{'abcde'[who]}"] + ([f"lonely{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}"] if k % 3 == 0 else [])
        if k % 23 == 1:
            words.append("secretlyb")                       # outside the texts of its entity
        rows.append((k, " ".join(words)))
    rows += [(500, rows[0][1]), (501, None), (502, "")]
    got = by_id(pii.scan(spark.createDataFrame(rows, "doc_id bigint, text string")))
    expect = disclosing_terms([t or "" for _, t in rows])
    assert sum(map(len, expect)) > 20
    for (k, _), places in zip(rows, expect):
        marked = [tuple(map(int, x.split(":")[1:])) for x in got[k].spans.split(",") if x.startswith("term:")]
        assert marked == places and got[k].n_terms == len(places), k


def test_many_entities_and_words_in_one_text(spark):
    name = lambda k: "".join("abcdefghij"[int(c)] for c in f"{k:06d}")
    rows = [(0, " ".join(f"u{k}@site.org {name(k)}" for k in range(8000)))] + [(k, "nothing of note here") for k in range(1, 40)]
    got = by_id(pii.scan(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert got[0].n_email == 8000 and got[0].n_terms == 8000 and got[1].n_terms == 0


def test_replaced_by_blocks(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(60):
        text = "".join(rnd.choice("abcé😀 \n") for _ in range(rnd.randrange(1, 3000)))
        xs = sorted({(s, min(len(text), s + rnd.randrange(1, 9)), rnd.choice(["", "<x>", "é"])) for s in
                     (rnd.randrange(len(text)) for _ in range(rnd.choice([0, 1, 5, 256, 257, 700])))})
        rows.append((k, text, xs))
    df = spark.createDataFrame(rows, "id int, t string, xs array<struct<s:int,e:int,to:string>>")
    got = df.select("id", spans.replaced(F.col("t"), F.col("xs")).alias("r"), spans.blanked(F.col("t"), F.col("xs")).alias("b")).collect()
    for r in got:
        _, text, xs = rows[r.id]
        at, out, chars = 0, "", list(text)
        for s, e, to in xs:
            if s >= at:
                out += text[at:s] + to
            at = max(at, e)
            chars[s:e] = "\n" * (e - s)
        assert r.r == out + text[at:] and r.b == "".join(chars)
