"""Packing, spelling variants and periodic runs against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyline.llm import packing, periodic_runs, spelling

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --- packing ---------------------------------------------------------------

def _whole_ids(texts, path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [e.ids + [1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def _check_packing(rows, expected, capacity):
    """``expected``: doc_id -> lists of ids (one per row with that id)."""
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert by_doc.keys() == expected.keys()
    for doc_id, lists in expected.items():
        pieces = by_doc[doc_id]
        assert sum(r["length"] for r in pieces) == sum(map(len, lists))
        assert {r["doc_tokens"] for r in pieces} == set(map(len, lists))
        if len(lists) == 1:
            at = 0
            for r in sorted(pieces, key=lambda r: r["start"]):
                ids = np.array(lists[0][at:at + r["length"]], "<u4").tobytes()
                assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids)
                at += r["length"]
    return padding, len(by_seq)


def test_packing_of_the_documents(spark, documents, tokenizer):
    docs = documents.collect()
    expected = {r["doc_id"]: [ids] for r, ids in zip(docs, _whole_ids([r["text"] for r in docs], tokenizer))}
    rows = packing.digests(documents, tokenizer).collect()
    padding, n = _check_packing(rows, expected, 2048)
    assert padding == 0 and n <= sum(len(x[0]) for x in expected.values()) / 2048 + 11 * documents.rdd.getNumPartitions()


def test_packing_of_edge_texts(spark, edge_docs, tokenizer):
    odd = [(100, "a\x1cb c̈́ ́x İstanbul ΣΑΣ <|endoftext|>"), (101, "x<|startoftext|>y don't I'LL 'S \x01 a\x01b \x01"), (102, " a　b\x85c \xa0 ﬁ é 각"),
           (103, "é日本語テキスト 😀😀 ½ ² word " * 50)]
    docs = edge_docs.select("doc_id", "text", "size").unionByName(spark.createDataFrame([(*o, "x") for o in odd], "doc_id long, text string, size string"))
    got = docs.collect()
    expected = defaultdict(list)
    for r, ids in zip(got, _whole_ids([r["text"] for r in got], tokenizer)):
        expected[r["doc_id"]].append(ids)
    padding, _ = _check_packing(packing.digests(docs, tokenizer).collect(), expected, 2048)
    assert padding == 0
    empty = packing.digests(docs.limit(0), tokenizer)
    assert empty.count() == 0


def test_sequences_hold_the_ids_of_their_pieces(spark, documents, tokenizer):
    pieces = packing.pack(documents.limit(40).coalesce(1), tokenizer, capacity=64, pool=500)
    got = {r["sequence_id"]: r for r in packing.sequences(pieces).collect()}
    want = defaultdict(list)
    for r in sorted(pieces.collect(), key=lambda r: r["offset"]):
        want[r["sequence_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    assert {k: (r["length"], r["ids"]) for k, r in got.items()} == {k: (len(v), v) for k, v in want.items()}


def test_closest_sum_equals_brute_force():
    rnd = random.Random(3)
    for _ in range(300):
        items, capacity = [rnd.randint(1, 60) for _ in range(rnd.randint(0, 9))], rnd.randint(0, 150)
        best, used = packing.closest(dict(Counter(items)), capacity)
        assert best == max(sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if sum(c) <= capacity)
        assert sum(k * n for k, n in used.items()) == best and not Counter(used) - Counter(items)


@pytest.mark.parametrize("lengths", [[1500] * 300, [33] * 200, [64, 128, 1] * 9, [], [1], [2047, 2, 2047, 2], [5000, 1, 4096]])
@pytest.mark.parametrize("pool", [300, 3000, 10**6])
def test_packer_keeps_every_id_once_without_padding(lengths, pool):
    packer, out = packing.Packer(64, pool), []
    texts = [np.arange(n, dtype="<u4").tobytes() for n in lengths]
    for k, ids in enumerate(texts):
        out += packer.add(k, ids)
    out += packer.finish()
    size = Counter()
    for seq, offset, _, _, ids in sorted(out, key=lambda x: x[:2]):
        assert offset == size[seq]
        size[seq] += len(ids) // 4
    assert all(n == 64 or n & (n - 1) == 0 for n in size.values()) and sum(n < 64 for n in size.values()) <= 6
    for k, ids in enumerate(texts):
        mine = sorted((x[3], x[4]) for x in out if x[2] == k)
        assert b"".join(x[1] for x in mine) == ids


# --- spelling variants -----------------------------------------------------

def _counted(rows, rate=199):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if rate and h % rate == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                out[w] += 1
    return out


def _near(words):
    letters = sorted({c for w in words for c in w})
    near = {}
    for w in words:
        c = {w[:i] + w[i + 1:] for i in range(len(w))}
        c |= {w[:i] + x + w[i + 1:] for i in range(len(w)) for x in letters}
        c |= {w[:i] + x + w[i:] for i in range(len(w) + 1) for x in letters}
        near[w] = (c & words.keys()) - {w}
    return near


def _variants(words, times=5):
    form = {}
    near = _near(words)
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * words[w] else None
    out = {}
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None)
    return out


def _collected(df):
    rows = df.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_spelling_variants_of_the_documents(spark, documents):
    want = {w: n for w, n in _counted([(r["doc_id"], r["text"]) for r in documents.collect()]).items() if n >= 5}
    got = _collected(spelling.group(documents))
    assert got == _variants(want) and any(v[0] for v in got.values())


def test_word_counts_of_edge_texts(spark, edge_docs):
    odd = spark.createDataFrame([(7, "Straße ÀÉÎ×÷ABC ΩabcdefgĀhijklmn naïveté NAÏVETÉ x" * 3, "s")], "doc_id long, text string, w string")
    docs = edge_docs.select("doc_id", "text", F_lit("w")).unionByName(odd)
    want = _counted([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert {r["w"]: r["n"] for r in spelling.counts(docs).collect()} == want
    assert spelling.group(docs.limit(0)).count() == 0


def F_lit(name):
    from pyspark.sql import functions as F

    return F.lit("x").alias(name)


@pytest.mark.parametrize("seed", range(3))
def test_variants_of_dense_dictionaries(spark, seed):
    rnd = random.Random(seed)
    words = {}
    for _ in range(400):                       # few letters, so nearly every word has many partners
        w = "".join(rnd.choice("abé") for _ in range(rnd.randint(1, 7)))
        words[w] = 5 ** rnd.randint(0, 6) + rnd.randint(0, 2)
    words |= {"a" * 300: 5, "a" * 301: 5, "a" * 299: 25, "b" + "a" * 299: 125}
    df = spark.createDataFrame(list(words.items()), "w string, n long").repartition(5)
    want = _variants(words)
    assert any(v[0] and v[1] != v[0] for v in want.values())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _collected(spelling.variants(df)) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_nodes_are_numbered_like_prefixes(spark):
    words = ["".join(p) for n in range(1, 6) for p in itertools.product("ab", repeat=n)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spelling.numbered(spark.createDataFrame([(w,) for w in words], "key string").repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    number = {}
    for r in rows:
        for d, node in enumerate(r["nodes"]):
            assert number.setdefault(r["key"][:d], node) == node
    assert len(set(number.values())) == len(number) == len(words) + 1
    assert [r["key"] for r in sorted(rows, key=lambda r: r["place"])] == sorted(words)


# --- periodic runs ---------------------------------------------------------

def _runs(ws):
    found = {}
    for q in range(1, len(ws) // 3 + 1):
        i = 0
        while i + q < len(ws):
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(ws) and ws[j] == ws[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def _periodic_digest(doc_id, text):
    ws, h = WORD.findall(text or ""), zlib.crc32(str(doc_id).encode())
    n, g = len(ws), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    found = _runs(ws)
    best = None
    for s, length, q in found:
        if best is None or length * best[2] > best[1] * q or (length * best[2] == best[1] * q and (s, q) < (best[0], best[2])):
            best = (s, length, q)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in found)), sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))


PERIODIC = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_periodic_runs_of_the_documents(documents):
    got = {r["doc_id"]: tuple(r[c] for c in PERIODIC) for r in periodic_runs.digests(periodic_runs.with_periods(documents)).collect()}
    want = {r["doc_id"]: _periodic_digest(r["doc_id"], r["text"]) for r in documents.collect()}
    assert got == want and sum(v[0] > 0 for v in want.values()) > 15


def test_periodic_runs_of_edge_texts(spark, edge_docs):
    rows = edge_docs.filter("doc_id is not null").select("doc_id", "text", F_lit("runs"))
    more = [(k, t, "x") for k in range(200, 320) for t in ["a b c " * (k // 3), "x\x1fy z\xa0w " * 20]]
    docs = rows.unionByName(spark.createDataFrame(more, "doc_id long, text string, runs string"))
    got = Counter((r["doc_id"], *(r[c] for c in PERIODIC)) for r in periodic_runs.digests(periodic_runs.with_periods(docs)).collect())
    assert got == Counter((r["doc_id"], *_periodic_digest(r["doc_id"], r["text"])) for r in docs.collect())
    null = spark.createDataFrame([(None, None), (None, "a b " * 30)], "doc_id long, text string")
    assert [(r["doc_id"], r["n_runs"]) for r in periodic_runs.digests(null).collect()] == [(None, 0), (None, 1)]
    assert periodic_runs.digests(periodic_runs.with_periods(docs.limit(0))).count() == 0


def test_runs_of_random_texts_equal_brute_force():
    rnd = random.Random(1)
    for _ in range(150):
        texts = []
        for _ in range(rnd.randint(1, 6)):
            ws = []
            for _ in range(rnd.randint(0, 6)):
                alphabet = "abc" if rnd.random() < .5 else [f"w{i}" for i in range(40)]
                p = rnd.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 20, 31, 40])
                ws += ([rnd.choice(alphabet) for _ in range(p)] * 8)[:rnd.randint(0, 5 * p + 10)] + [rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))]
            texts.append(" ".join(ws))
        for text, (n, found, _) in zip(texts, periodic_runs.search(texts)):
            assert n == len(text.split()) and found == _runs(text.split())


def test_transform_counts_mismatches_exactly():
    rng = np.random.default_rng(0)
    blocks, windows = rng.integers(0, 2**31 - 1, (5, 16)).astype(np.uint64), rng.integers(0, 2**31 - 1, (5, 31)).astype(np.uint64)
    got = periodic_runs.mismatches(blocks % periodic_runs.P, windows % periodic_runs.P, periodic_runs.Transform(32))
    want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(b, w[k:k + 16])) % periodic_runs.PRIME for k in range(16)] for b, w in zip(blocks, windows)]
    assert got.tolist() == want


def test_long_texts_of_one_word_and_of_two(spark):
    one, two = periodic_runs.search(["a " * 50_000, "a b " * 50_000])
    assert one[1] == [(0, 50_000, 1)] and one[2] == "a" and two[1] == [(0, 100_000, 2)] and two[2] == "a b"
