"""Near-duplicates, embeddings, mixing, toxicity and pages against plain Python."""

from __future__ import annotations

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from tallyline.llm import components, embedding_dedup, html_extraction, minhash_dedup, mixing, toxicity

from . import brute
from .conftest import SF, by_id


# ------------------------------------------------------------ components

def test_components_of_chains_and_stars(spark):
    rnd = random.Random(1)
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [
        (rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    got = dict(components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    want = brute.components({x for p in links for x in p}, links)
    assert got == {k: v for k, v in want.items() if any(k in p and p[0] != p[1] for p in links)}


def test_components_without_links(spark):
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ------------------------------------------------------------ near-duplicates

def near_duplicates(rows):
    """doc_id -> class by exact weighted Jaccard over all pairs."""
    words = minhash_dedup._Words()
    sets = {i: minhash_dedup.shingles_of(t or "", words) for i, t in rows}
    sets = {i: s[2] for i, s in sets.items() if s}
    df = collections.Counter(x for h in sets.values() for x in np.unique(h).tolist())
    n = len(sets)
    bag = {}
    for i, h in sets.items():
        u, tf = np.unique(h, return_counts=True)
        bag[i] = dict(zip(u.tolist(), (tf * np.log1p(1 / np.maximum(np.array([df[x] for x in u.tolist()]) / n, minhash_dedup.PHI))).tolist()))
    links = []
    ids = sorted(bag)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = bag[a].keys() & bag[b].keys()
            low = sum(min(bag[a][x], bag[b][x]) for x in common)
            if common and low / (sum(bag[a].values()) + sum(bag[b].values()) - low) >= minhash_dedup.SIMILARITY:
                links.append((a, b))
    return brute.components([i for i, _ in rows], links)


@pytest.fixture(scope="module")
def copies(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    rows, base = [], [word() for _ in range(150)]
    for k in range(60):                       # a group of near copies with edits
        t = list(base)
        for _ in range(rnd.randrange(0, 4)):
            t[rnd.randrange(len(t))] = word()
        rows.append((k, " ".join(t)))
    passage = " ".join(word() for _ in range(40))
    rows += [(100 + k, passage + " " + " ".join(word() for _ in range(120))) for k in range(30)]
    rows += [(200 + k, rows[105 - 60][1]) for k in range(5)] + [(300, ""), (301, None), (302, "few words"), (303, "few  words"), (304, "Few")]
    return rows


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates(spark, copies, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    d = spark.createDataFrame(copies, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in minhash_dedup.classes(d).collect()}
    assert got == near_duplicates(copies)
    kept = minhash_dedup.keep_one(d)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, v in got.items() if k == v) and kept.columns == d.columns


def test_near_duplicates_on_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert {r.doc_id: r.class_id for r in minhash_dedup.classes(documents).collect()} == near_duplicates(rows)


def test_near_duplicates_edge_cases(edge_docs):
    got = minhash_dedup.classes(edge_docs)
    assert got.count() == edge_docs.count()
    c = {r.doc_id: r.class_id for r in got.collect()}
    assert c[5] == c[6] == 5 and [c[k] for k in (0, 1, 2)] == [0, 1, 2]
    kept = minhash_dedup.keep_one(edge_docs.filter("doc_id is not null"))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == edge_docs.columns and len(ids) == len(set(ids)) and 6 not in ids
    assert minhash_dedup.classes(edge_docs.limit(0)).count() == 0


def test_block_similarities_equal_the_pairwise_ones(copies):
    words = minhash_dedup._Words()
    blobs = [minhash_dedup.pack(minhash_dedup.shingles_of(t, words)[2]) for _, t in copies[:20] if t]
    w = minhash_dedup.Weights(np.zeros(0, np.uint64), np.zeros(0), 20)
    got = minhash_dedup.similarities(blobs[:8], blobs[8:], w)
    want = [[minhash_dedup.weighted_jaccard(w(a), w(b)) for b in blobs[8:]] for a in blobs[:8]]
    assert np.allclose(got, want)


def test_frequent_shingles_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK_HASHES", 50)
    rows = [(k, "one two three four five six seven" if k % 3 == 0 else f"own words {k} a b c d {k}") for k in range(90)]
    table = minhash_dedup.shingle_table(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    shingles, df = minhash_dedup.frequent(table, 90)
    assert df.tolist() == [30.0] * 3 and len(shingles) == 3


def test_a_passage_in_few_texts_weighs_less_than_their_own_words(spark):
    """A passage that 5% of the texts hold was weighed like words of one text, so
    that its texts, 0.82 alike by tf, were near-duplicates; by tf-idf they are not."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(7))
    passage = " ".join(word() for _ in range(200))
    rows = [(k, passage + " " + " ".join(word() for _ in range(20))) for k in range(10)]
    rows += [(10 + k, " ".join(word() for _ in range(30))) for k in range(190)]
    got = {r.doc_id: r.class_id for r in minhash_dedup.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: i for i, _ in rows}


@pytest.mark.parametrize("block, hashes", [(40, 10), (500_000, 2_000_000)])
def test_every_document_frequency_is_counted(spark, copies, monkeypatch, block, hashes):
    monkeypatch.setattr(minhash_dedup, "BLOCK_HASHES", block)
    monkeypatch.setattr(minhash_dedup, "RANGE_HASHES", hashes)
    table = minhash_dedup.shingle_table(spark.createDataFrame(copies, "doc_id bigint, text string").repartition(3)).cache()
    rows = [r.hashes for r in table.collect() if r.hashes]
    want = collections.Counter(x for b in rows for x in np.unique(minhash_dedup.unpack(b)).tolist())
    shingles, df = minhash_dedup.frequent(table, len(rows))
    assert dict(zip(shingles.tolist(), df.tolist())) == {x: n for x, n in want.items() if n > 1}
    answers, own = minhash_dedup.document_frequencies(table), table.selectExpr("block", "doc_id AS rep", "s1", "s2")
    got = minhash_dedup.with_frequencies(table, answers, own).collect()
    assert len(got) == len(rows)
    for r in got:
        u = np.unique(minhash_dedup.unpack(r.hashes)).tolist()
        assert np.frombuffer(r.df, "<u4").tolist() == [want[x] for x in u]
    # A block that several tasks read reports more than once.
    split = minhash_dedup._answers(minhash_dedup._reports(table.repartition(7), 2).repartition(3))
    whole = minhash_dedup._answers(minhash_dedup._reports(table, 2))
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
    table.unpersist()


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    h = np.sort(rng.choice(1 << 40, 400, replace=False).astype(np.uint64))
    w = rng.uniform(0.5, 3, 400)
    a, b = (h[:330], w[:330]), (h[60:], w[60:])
    s = minhash_dedup.Sampler(2000)
    assert abs((s(*a) == s(*b)).mean() - minhash_dedup.weighted_jaccard(a, b)) < 0.05


# ------------------------------------------------------------ embeddings

def vectors():
    rng = np.random.default_rng(7)
    base = rng.standard_normal((40, 16))
    rows = [(k, base[k % 40] + rng.standard_normal(16) * (0.15 if k > 40 else 0)) for k in range(200)]
    rows += [(500 + k, base[1]) for k in range(4)]
    rows = [(i, [float(np.float32(x)) for x in v], i % 3) for i, v in rows]
    return rows + [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] * 16, 1), (903, [], None), (904, [None, 1.0], 1),
                   (905, [float("inf")] * 16, 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (10, rows[10][1], 1)]


@pytest.mark.parametrize("block,kind", [(512, "float"), (4, "float"), (512, "double")])
def test_embedding_links(spark, monkeypatch, block, kind):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rows = vectors()
    got = embedding_dedup.links(spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int")).collect()
    ok = [(k, np.array(v)) for k, (_, v, _) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and any(v)]
    n, links = collections.Counter(), []
    for x, (i, a) in enumerate(ok):
        for j, b in ok[:x]:
            if len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.9:
                n[i] += 1
                n[j] += 1
                links.append((rows[i][0], rows[j][0]))
    want = brute.components([r[0] for r in rows], links)
    assert sorted((r.vec_id, r.n_links) for r in got) == sorted((r[0], n[k]) for k, r in enumerate(rows))
    assert all(r.component_id == want[r.vec_id] and r.kept == (r.vec_id == r.component_id) for r in got)


def test_embedding_recall(spark):
    """Pairs near the threshold, where the hashing is weakest."""
    rng = np.random.default_rng(8)
    rows, pairs = [], []
    for k in range(300):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        o = rng.standard_normal(64)
        o -= (o @ a) * a
        o /= np.linalg.norm(o)
        c = rng.uniform(0.901, 0.93)
        rows += [(2 * k, a.tolist()), (2 * k + 1, (c * a + math.sqrt(1 - c * c) * o).tolist())]
        pairs.append((2 * k, 2 * k + 1))
    got = {r.vec_id: r for r in embedding_dedup.links(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert sum(got[a].component_id == got[b].component_id for a, b in pairs) >= 0.97 * len(pairs)


def test_embeddings_of_any_magnitude(spark):
    rows = [(1, [1e-200, 2e-200]), (2, [1.0, 2.0]), (3, [3e200, 1e200]), (4, [3.0, 1.0]), (5, [5e-324, 1e-323]), (6, [1e308, -1e308])]
    got = {r.vec_id: r for r in embedding_dedup.links(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert [got[k].component_id for k in range(1, 7)] == [1, 1, 3, 3, 1, 6] and got[1].n_links == 2 and got[3].n_links == 1


def test_embeddings_empty(spark):
    assert embedding_dedup.links(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


# ------------------------------------------------------------ mixing

def water_levels(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing the excess until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    target, open_, rest = {}, set(order), sum(sizes.values())
    while open_:
        share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > most * sizes[s]}
        target.update(share)
        if not full:
            break
        for s in full:
            target[s] = most * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def test_mixing(spark, documents, edge_docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    skewed = documents.selectExpr("doc_id", "text", "lang", "CASE WHEN doc_id % 3 = 0 THEN 'hot' WHEN doc_id < 8 THEN NULL ELSE source END AS source")
    for d in (documents, skewed, edge_docs):
        rows = mixing.mix(d).collect()
        assert len(rows) == d.count()
        sizes = collections.Counter()
        for r in rows:
            sizes[r.source] += r.size
        want = water_levels(sizes)
        taken = collections.Counter()
        for r in rows:
            assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
            assert 0 <= r.taken <= 3 * r.size
            taken[r.source] += r.taken
        assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
        assert sorted(map(str, mixing.mix(d.repartition(5)).collect())) == sorted(map(str, rows))


def test_mixing_takes_copies_and_cuts_at_the_budget(spark):
    rows = [(1, "a b c d", "big"), (2, "e f g h", "big"), (3, " x  y\tz ", "small"), (4, None, "none"), (5, "", None)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    taken = {r.doc_id: r.taken for r in mixing.mix(d).collect()}
    out = mixing.apply(d).collect()
    words = collections.Counter()
    for r in out:
        words[r.doc_id] += len(brute.WORD.findall(r.text))
    assert words == {k: v for k, v in taken.items() if v}
    texts = {r[0]: r[1] for r in rows}
    assert all(texts[r.doc_id].startswith(r.text) for r in out) and mixing.apply(d).columns == d.columns


def test_mixing_empty(edge_docs):
    assert mixing.mix(edge_docs.limit(0)).count() == 0 and mixing.apply(edge_docs.limit(0)).count() == 0


# ------------------------------------------------------------ toxicity

def toxic_corpus():
    rnd = random.Random(5)
    syllables = "an er in on st re nd ti at ou".split()
    word = lambda n=3: "".join(rnd.choice(syllables) for _ in range(n))
    rows = []
    for k in range(900):
        ws = ["the", "of"] + [word() for _ in range(rnd.randrange(5, 120))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(rnd.randrange(1, 5)):
                ws.insert(rnd.randrange(len(ws)), "vequ" + word(2))
        rows.append((k, " ".join(ws), int(toxic)))
    return rows


def test_toxicity_held_out_accuracy(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id bigint, quality int, toxic int")
    got = by_id(toxicity.score(docs, toxicity.train(docs, labels)))
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert 200 < len(held) < 400
    assert sum(p == y for p, y in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_toxicity_forward_pass_and_rows_used(monkeypatch):
    rng = random.Random(2)
    vocabulary = ["vile", "idiot", "hello", "garden", "the", "and", "läuft", "x"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 30))) for _ in range(60)] + [""]
    labels = [int("vile" in t) for t in texts]
    used = []
    real = toxicity._train
    monkeypatch.setattr(toxicity, "_train", lambda m, c, rows, y, r: (used.append(len(rows)), real(m, c, rows, y, r)))
    odds = toxicity._log_odds
    monkeypatch.setattr(toxicity, "_log_odds", lambda c, rows, y: (used.append(len(rows)), odds(c, rows, y))[1])
    m = toxicity.fit(texts, labels)
    assert m.fitted and sum(used) == len(texts)
    scored = toxicity.Scorer(m)(texts)
    for text, (logit, _) in zip(texts, scored):
        x = [m.embedding[toxicity.features(w)].sum(axis=0) for w in toxicity.tokens(text)]
        x += [np.zeros(toxicity.DIM)] * (max(toxicity.WIDTHS) - len(x))
        pooled = [max(sum(float(x[i + k] @ f[k][:, j]) for k in range(len(f))) for i in range(len(x) - len(f) + 1))
                  for f in m.filters for j in range(toxicity.FILTERS)]
        plain = sum(max(0.0, p + b) * o for p, b, o in zip(pooled, m.bias, m.out)) + m.out_bias
        assert abs(plain - logit) < 1e-3 * max(1, abs(plain)), text


def test_toxicity_edge_cases(spark, edge_docs, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    m = toxicity.train(documents, labels)
    rows = toxicity.score(edge_docs, m).collect()
    assert len(rows) == edge_docs.count() and len({r.score for r in rows if r.doc_id in (0, 1, 2)}) == 1
    assert toxicity.score(edge_docs.limit(0), m).count() == 0
    nothing = toxicity.train(documents, labels.limit(0))
    assert {r.score for r in toxicity.score(edge_docs, nothing).collect()} == {0.0}


def test_toxicity_thresholds_cover_all_labelled_rows(spark, monkeypatch):
    """The sample is smaller than the labelled rows and has its own toxic rate."""
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 60)
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 90)
    rows = toxic_corpus()
    docs = spark.createDataFrame([r[:2] for r in rows] + [rows[0][:2]], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    m = toxicity.train(docs, labels)
    used = by_id(toxicity.logits(docs.filter(~toxicity.held_out()), m))
    y = {r[0]: r[2] for r in rows}
    assert len(used) > 500

    def f1(cut):
        hit = sum(y[i] for i, r in used.items() if r.logit >= cut)
        return 2 * hit / (sum(r.logit >= cut for r in used.values()) + sum(y[i] for i in used))

    assert f1(m.cuts["*"]) >= max(f1(k / toxicity.STEPS) for k in range(-20 * toxicity.STEPS, 20 * toxicity.STEPS)) - 0.01
    got = toxicity.classify(docs, labels).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, toxicity.score(docs, m).collect())) and len(got) == len(rows) + 1


# ------------------------------------------------------------ pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href=x>menu</a></ul></nav><div class="cookie-notice">We use</div><div id=wrap><article><header><h1>Title &amp; x</h1></header>
<p>One <b>two<br><p>thr&eacute;e\n four&nbsp;five</p><div class="ad">buy</div><p>six<!-- c --><i>seven</i>
<section class="comments"><p>nice</p></section><form><input name=q><p>f</p></form></article><aside>side</aside></div>
<script>var a="</p>";</script><footer>f</footer></body></html>"""


def test_main_text():
    text = lambda h: html_extraction.main_text(html_extraction.tree(h))
    assert text(PAGE) == "Title & x\nOne two\nthrée four five\nsixseven"
    assert text("<div><div class=menu>m</div><div id=content><h1>A</h1>one<p>b<p>c</div><div class=comments>x</div></div>") == "A\none\nb\nc"
    assert text("") == "" and text("plain <b>text</b> &lt;x&gt;") == "plain text <x>"
    assert text("<body><main><p>a<table><tr><td>1<td>2</table></main><footer>z</footer>") == "a\n1\n2"


def test_repeated_branches_of_a_host_are_removed(spark):
    page = lambda k: f"<body><div class=top>Our shop since 1990</div><div class=text><p>page {k} says {k * 7} things</div></body>"
    rows = [(k, f"http://shop.example/{k}", page(k)) for k in range(20)] + [(100, None, page(1)), (101, "http://solo.example", page(2)),
                                                                         (102, "u", None), (103, "http://x.example", "")]
    got = {r.page_id: r for r in html_extraction.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3].text == "page 3 says 21 things" and got[3].n_chars == 21
    assert got[100].text == got[100].text and got[101].text.startswith("Our shop") and got[102].text == got[103].text == ""
    same = [(k, "http://copy.example/", "<body><article><p>a copied article</article></body>") for k in range(10)]
    copied = html_extraction.extract(spark.createDataFrame(same + same[:1], "page_id bigint, url string, html string").selectExpr("*", "'x' AS text", "1 AS host"))
    assert {r.text for r in copied.collect()} == {"a copied article"} and copied.count() == 11


def test_copied_articles_keep_their_branches(spark):
    """Copies of a whole page, and of an article in differing surroundings."""
    article = "<article><h1>T</h1><div>body</div><section class=text>more</section><p class=lead>lead</article>"
    rows = [(k, "http://copy.example/", f"<body>{article}</body>") for k in range(8)]
    rows += [(100 + k, "http://mixed.example/", f"<body>{article}</body>") for k in range(30)]
    rows += [(200 + k, "http://mixed.example/", f"<body><article><h1>T{k}</h1><div>body {k}</div></article></body>") for k in range(6)]
    rows += [(300 + k, "http://near.example/", f"<body><div class=x>visit {k}</div>{article}</body>") for k in range(8)]
    got = {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    want = "T\nbody\nmore\nlead"
    assert {k: v for k, v in got.items() if v != want} == {200 + k: f"T{k}\nbody {k}" for k in range(6)}


def test_repeated_branches_do_not_depend_on_the_hosts_size(spark):
    """A notice on 6 of 6 and on 6 of 506 pages of a host (under 2%)."""
    page = lambda k, note: f"<body>{note}<div class=text{k % 9}><p>page {k} says {k * 7} things</div></body>"
    note = "<div class=rare>Our shop since 1990</div>"
    rows = [(k, "http://small.example/", page(k, note)) for k in range(6)]
    rows += [(100 + k, "http://large.example/", page(k, note if k < 6 else "")) for k in range(506)]
    got = {r.page_id: r.text for r in html_extraction.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert len(got) == 512 and all(t == f"page {k % 100 if k < 100 else k - 100} says {(k if k < 100 else k - 100) * 7} things" for k, t in got.items())


def test_class_words_leave_article_text():
    text = lambda h: html_extraction.main_text(html_extraction.tree(h))
    assert text("<div class='post-form'><p>long story text</p></div>") == "long story text"
    assert text("<div class='left side column'><p>story</p></div>") == "story"
    assert text("<article><h2 class='related'>Related work</h2><p>a</article>") == "Related work\na"


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<div><p>" * 30_000 + "x", "<article>" + "<section>" * 60_000 + "x" + "</section>" * 60_000,
                                  "<ul><li>" * 30_000 + "x", "<table><tr><td>" * 20_000 + "x", "<span>" * 100_000 + "x"])
def test_deeply_nested_pages(page):
    root = html_extraction.tree(page)
    assert html_extraction.main_text(root) == "x"
    html_extraction.paths(root), html_extraction.asked(root)


def test_malformed_pages():
    text = lambda h: html_extraction.main_text(html_extraction.tree(h))
    assert text("<p>a</p><![foo[bar]]><p>b</p>") == "a\nb" and text("<p>a</p><![ x") == "a" and text("<p>a<![CDATA[c]]>b") == "ab"
    bits = ["<", "<!", "<![", "<!-", "<!--", "-->", "--!>", "]]>", "<?", "?>", "</", "/>", ">", "p", "div", "article", " class=", "'nav'", '"x', "=", "&", "&amp",
            "&#x;", "&#1234567890;", "&#xD800;", "\0", "<script>", "</script>", "<style>", "<title>", "<textarea>", "<![CDATA[", "<!DOCTYPE", "[", "]", "text ",
            "<p>", "</p>", "<li>", "<td>", "<a href=x>", "\ud800", "<br/>", "<svg/>", "<plaintext>", "<!ENTITY", "<!ELEMENT x"]
    rnd = random.Random(0)
    for _ in range(2000):
        root = html_extraction.tree("".join(rnd.choice(bits) for _ in range(rnd.randint(1, 60))))
        html_extraction.main_text(root), html_extraction.paths(root), html_extraction.asked(root)


def test_low_paths_equal_plain_entropies(spark):
    """The style tree of every host by loops over its pages."""
    rnd = random.Random(2)
    some = lambda share, text: text if rnd.random() < share else ""
    page = lambda: ("<body>" + some(.9, f"<div class=top>{rnd.choice(['same', 'same', 'same', 'other'])}</div>") + f"<div class=text>{rnd.random()}</div>"
                    + some(.5, f"<section id=s><p>{rnd.randint(0, 3)}</p></section>") + some(.1, "<article><p>copy</p></article>")
                    + some(.4, "<ul class=links><li>one<li>two</ul>") + "</body>")
    pages = [(k, f"http://h{k % 3}.example/{k}", page()) for k in range(90)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr(
        "regexp_extract(url, '//([^/]+)', 1) AS host", "substring(unhex(sha2(html, 256)), 1, 16) AS page", "html")
    want = {}
    for host in range(3):
        seen = collections.defaultdict(set)
        for html in {h for k, _, h in pages if k % 3 == host}:
            for path, variant in html_extraction.paths(html_extraction.tree(html)).items():
                seen[path].add(variant)
        low = set()
        for path, variants in seen.items():
            n, h = len(variants), []
            for at in (0, 1):
                counts = collections.Counter(v[at] for v in variants).values()
                h.append(-sum(c / n * math.log(c / n, n) for c in counts) if n > 1 else 1.0)
            if n >= html_extraction.MIN_PAGES and 0.1 * h[0] + 0.9 * h[1] < html_extraction.LOW:
                low.add(path)
        for html in {h for k, _, h in pages if k % 3 == host}:
            root = html_extraction.tree(html)
            if mine := low & html_extraction.paths(root).keys() & html_extraction.asked(root):
                want[f"h{host}.example", hashlib.sha256(html.encode()).digest()[:16]] = sorted(mine)
    got = {(r["host"], bytes(r["page"])): list(r["low"]) for r in html_extraction.low_paths(df).collect()}
    assert got == want and len(want) > 20


def test_pages_empty(spark):
    assert html_extraction.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
