"""The pipeline against the operators' plain versions, and the SQL oracles."""

from __future__ import annotations

import hashlib

import pytest
import public_tokenizers
import tiktoken

import __spark_entry__ as entry_mod
import corpus_pipeline
from tallyline.llm import bpe, mixing, quality_rules, secret_scans
from tallyline.llm.catalog import ORACLE, QUERIES
from tools.compare_oracle import duck, rows_of

from . import brute
from .conftest import SF
from .test_corpus_operators import near_duplicates


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, name):
    df = QUERIES[name](spark, SF)
    cur = duck(SF).execute(ORACLE[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


def test_all_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_mod.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, documents):
    rows = {r.doc_id: r for r in documents.collect()}
    verdicts = {r.doc_id: r.kept for r in quality_rules.score(documents).collect()}
    assert all(not verdicts[i] for i, r in rows.items() if brute.quality(r.text)[5])
    left = [(i, rows[i].text) for i in rows if verdicts[i]]
    group = near_duplicates(left)
    left = [(i, t) for i, t in left if group[i] == i]
    kept = documents.filter(documents.doc_id.isin([i for i, _ in left]))
    masked = {r.doc_id: r for r in secret_scans.mask(kept).collect()}
    for i, t in left:
        if not brute.secrets(t):
            assert masked[i].text == t
        else:
            assert not brute.secrets(masked[i].text)
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(spark.createDataFrame(list(masked.values()), documents.schema)).collect()}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(
        public_tokenizers.path(corpus_pipeline.VOCABULARY)), special_tokens={})
    got = corpus_pipeline.run(spark, SF).collect()
    copies = {}
    for r in got:
        copies.setdefault(r.doc_id, []).append(r)
    assert {i: len(x) for i, x in copies.items()} == {i: -(-n // size) for i, (n, size) in taken.items() if n}
    for i, found in copies.items():
        for r in found:
            text = enc.decode(r.ids)
            assert masked[i].text.startswith(text) and enc.encode_ordinary(text) == r.ids and r.n_tokens == len(r.ids)
            assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert sum(len(brute.WORD.findall(enc.decode(r.ids))) for r in found) == taken[i][0]


def test_stages_keep_columns(spark, documents):
    docs = documents.limit(60)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == documents.columns
    empty = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
