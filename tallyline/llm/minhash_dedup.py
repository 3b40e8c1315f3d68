"""Near-dedup by improved consistent weighted sampling over TF-IDF shingles.

1. Every text becomes the sorted 40-bit hashes of its 5-word shingles (with
   repeats, so term frequencies are kept) and a 128-bit hash of its word
   sequence; this table is written once.
2. Document frequencies: a shingle's weight is tf * ln(1 + N / df), with the df
   of every shingle counted exactly over all N documents.  Blocks of documents
   report their distinct shingles and how many of the block's documents hold
   them, cut into ranges of the hash; a range adds up the reports of all blocks
   and answers every block with the df of its shingles, in their order.  The
   table of step 1 is bucketed by block, so that the answers come to the texts
   and no text is shuffled.  Ranges and blocks hold about as many shingles at any
   corpus size: no table of df is ever in one place.
3. Copies of the same word sequence are one class, represented by the smallest
   doc_id.  Every representative gets ``BANDS * ROWS`` weighted samples; a
   band's samples are hashed to a bucket key.  Buckets of equal members (a
   pair usually meets in most bands) are kept once.
4. All members of a bucket are compared by weighted Jaccard similarity on
   their full shingle lists, as one matrix product per block of members.  A
   bucket of more than ``BLOCK`` members is cut into chunks by a hash of the
   id and every pair of chunks is a unit of its own, on any task.  A unit gives
   back a spanning forest of its links, never its pairs; components of the
   links are the groups.

Shingles of different texts are told apart by 40-bit hashes: two texts of 500
shingles share one by accident with probability 2e-7.  The random numbers of a
sample come from tables of 65,536 entries, indexed by a hash that differs from
sample to sample.

Defined results: texts without words (null, empty, white space) link with
nothing and are kept; a text of one to four words has its word sequence as its
only shingle; of repeated rows with one doc_id all carry the same class and
``keep_one`` keeps one; an empty table gives an empty table; further columns
are ignored by ``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shared_dir, sliced, written
from .components import components

WIDTH = 5                 # words of a shingle
SIMILARITY = 0.8
BANDS, ROWS = 9, 3        # a pair of similarity 0.8 meets in a band with probability 0.998
PHI = 0.0                 # least share df/N that counts: every document frequency does
BLOCK = 256
COLUMNS = 4096              # shingles of one matrix product
BLOCK_HASHES = 500_000      # shingles of a block of documents
RANGE_HASHES = 2_000_000    # reported shingles of a range of hashes
COMPARED = 400_000          # shingles of the texts on one side of a comparison
ELEMENTS = 16_384           # shingles sampled at once
BATCH_CHARS = 2_000_000
BATCH_BYTES = 4_000_000
REMEMBER = 150_000
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SHINGLES = "block long, doc_id long, s1 long, s2 long, hashes binary"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def pack(hashes: np.ndarray) -> bytes:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def unpack(blob: bytes) -> np.ndarray:
    out = np.zeros((len(blob) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(blob, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


class _Words(dict):
    """word -> 64-bit hash, computed on first use."""

    def __missing__(self, word: str) -> int:
        h = self[word] = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        return h


def shingles_of(text: str, words: _Words) -> tuple[int, int, np.ndarray] | None:
    """128-bit hash of the word sequence and the sorted shingle hashes; None without words."""
    tokens = text.lower().split()
    if not tokens:
        return None
    w = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    s1, s2 = struct.unpack("<qq", hashlib.blake2b(w.tobytes(), digest_size=16).digest())
    n = max(1, len(w) - WIDTH + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(WIDTH, len(w))):
        h = mixed(h + w[k:k + n] + np.uint64(k + 1))
    h >>= np.uint64(24)
    h.sort()
    return s1, s2, h


def shingle_table(docs: DataFrame) -> DataFrame:
    """block, doc_id, s1, s2, hashes of every row; ``block`` numbers runs of rows
    with about ``BLOCK_HASHES`` shingles, otherwise in every run: write the table
    before it is used twice."""
    most = BLOCK_HASHES

    def run(batches):
        words = _Words()
        block, size = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            for part in sliced(b, "text", BATCH_CHARS, 500):
                got = [shingles_of(t or "", words) for t in part.column("text").to_pylist()]
                blocks = []
                for g in got:
                    blocks.append(block)
                    size += len(g[2]) if g else 0
                    if size >= most:
                        block, size = block + 1, 0
                yield pa.record_batch({
                    "block": pa.array(blocks, pa.int64()),
                    "doc_id": part.column("doc_id"), "s1": pa.array([g and g[0] for g in got], pa.int64()),
                    "s2": pa.array([g and g[1] for g in got], pa.int64()), "hashes": pa.array([g and pack(g[2]) for g in got], pa.binary())})
                if len(words) > REMEMBER:
                    words.clear()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SHINGLES)


def _uniques(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and counts of a sorted array."""
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
    return hashes[first], np.diff(np.r_[first, len(hashes)])


def _planes(x: np.ndarray, width: int) -> bytes:
    """Numbers below 256 ** ``width`` byte by byte, all lowest bytes first: compresses well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(blob: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(blob) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, -1).T
    return out.view("<u8").ravel()


def _reports(table: DataFrame, bits: int) -> DataFrame:
    """part, block, gaps, n: the distinct shingles of a block's documents whose first
    ``bits`` bits are ``part`` (each as its distance from the one before) and how many
    documents hold each."""
    def run(batches):
        held, at = [], None

        def flush():
            if held:
                h, n = _uniques(np.sort(np.concatenate(held)))
                parts = (h >> np.uint64(40 - bits)).astype(np.int64)
                cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(h)]
                gaps = np.diff(h, prepend=np.uint64(0))
                gaps[cuts[:-1]] = h[cuts[:-1]]
                yield pa.record_batch({
                    "part": pa.array(parts[cuts[:-1]]), "block": pa.array([at] * (len(cuts) - 1), pa.int64()),
                    "gaps": pa.array([_planes(gaps[i:j], 5) for i, j in zip(cuts, cuts[1:])], pa.binary()),
                    "n": pa.array([_planes(n[i:j], 4) for i, j in zip(cuts, cuts[1:])], pa.binary())})

        for b in (part for whole in batches for part in sliced(whole, "hashes", BATCH_BYTES)):
            for block, blob in zip(b.column("block").to_pylist(), b.column("hashes").to_pylist()):
                if block != at:
                    yield from flush()
                    held, at = [], block
                held.append(_uniques(unpack(blob))[0])
        yield from flush()

    return table.filter("hashes is not null").select("block", "hashes").mapInArrow(run, "part long, block long, gaps binary, n binary")


def _answers(reports: DataFrame) -> DataFrame:
    """block, part, df: how many of all documents hold each of the shingles that the
    block reported to the part, in the order of the shingles."""
    def run(batches):
        held, at = [], None

        def finish():
            if not held:
                return
            h = [np.cumsum(_numbers(gaps, 5), dtype=np.uint64) for _, gaps, _ in held]
            ends = np.cumsum([len(x) for x in h]).tolist()
            h = np.concatenate(h)
            _, inverse = np.unique(h, return_inverse=True)
            df = np.bincount(inverse, np.concatenate([_numbers(n, 4) for _, _, n in held]))[inverse]
            blocks = [r[0] for r in held]
            out = []
            for k, (i, j) in enumerate(zip([0, *ends], ends)):
                if k and blocks[k] == blocks[k - 1]:
                    continue
                one = df[i:j]
                if k + 1 < len(blocks) and blocks[k + 1] == blocks[k]:      # a block that several tasks read
                    j = ends[max(x for x in range(k, len(blocks)) if blocks[x] == blocks[k])]
                    one = df[i:j][np.unique(h[i:j], return_index=True)[1]]
                out.append((blocks[k], _planes(one, 4)))
            yield pa.record_batch({"block": pa.array([k for k, _ in out], pa.int64()), "part": pa.array([at] * len(out), pa.int64()),
                                   "df": pa.array([x for _, x in out], pa.binary())})

        for b in (part for whole in batches for part in sliced(whole, "gaps", BATCH_BYTES)):
            for part, block, gaps, n in zip(*[b.column(k).to_pylist() for k in ("part", "block", "gaps", "n")]):
                if part != at:
                    yield from finish()
                    held, at = [], part
                held.append((block, gaps, n))
        yield from finish()

    return reports.repartition("part").sortWithinPartitions("part", "block").mapInArrow(run, "block long, part long, df binary")


def document_frequencies(table: DataFrame) -> DataFrame:
    """``_answers`` for all blocks of a shingle table."""
    shingles = (table.agg(F.sum(F.octet_length("hashes"))).first()[0] or 0) // 5
    return _answers(_reports(table, min(39, max(1, (shingles // RANGE_HASHES).bit_length()))))


def _block_frequencies(texts: list[bytes], answers: pa.Table) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The distinct shingles of each of a block's texts, their tf and their df; takes
    all texts of the block and its answers."""
    answers = answers.filter(pc.is_valid(answers.column("part"))).sort_by("part")
    h = unpack(b"".join(texts))
    shingles, inverse = np.unique(h, return_inverse=True)
    df = np.concatenate([_numbers(x, 4) for x in answers.column("df").to_pylist()])
    if len(df) != len(shingles):
        raise ValueError(f"{len(df)} document frequencies for {len(shingles)} shingles of a block")
    df = df[inverse]
    ends = np.cumsum([len(t) // 5 for t in texts]).tolist()
    out = []
    for i, j in zip([0, *ends], ends):
        first = np.flatnonzero(np.r_[True, h[i + 1:j] != h[i:j - 1]])
        out.append((h[i:j][first], np.diff(np.r_[first, j - i]), df[i:j][first]))
    return out


def _texts(table: DataFrame):
    return table.filter("hashes is not null").groupBy("block")


def band_table(table: DataFrame, answers: DataFrame, n_docs: int) -> DataFrame:
    """block, doc_id, s1, s2, keys (one per band) of every text with words."""
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        sample = Sampler(BANDS * ROWS)
        blobs = texts.column("hashes").to_pylist()
        keys = []
        for h, tf, df in _block_frequencies(blobs, answers) if blobs else ():
            s = sample(h, tf * np.log1p(n_docs / df)).reshape(BANDS, ROWS)
            k = np.zeros(BANDS, np.uint64)
            for c in range(ROWS):
                k = mixed(k + s[:, c] + np.uint64(c + 1))
            keys.append(k.view(np.int64).tolist())
        return pa.table({**{c: texts.column(c) for c in ("block", "doc_id", "s1", "s2")}, "keys": pa.array(keys, pa.list_(pa.int64()))})

    return _texts(table).cogroup(answers.groupBy("block")).applyInArrow(run, "block long, doc_id long, s1 long, s2 long, keys array<long>")


def with_frequencies(table: DataFrame, answers: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, hashes and df (of the distinct hashes) of the texts ``wanted`` (block, rep, s1, s2)."""
    def run(texts: pa.Table, others: pa.Table) -> pa.Table:
        asked = others.filter(pc.is_null(others.column("part")))
        asked = set(zip(*[asked.column(c).to_pylist() for c in ("rep", "s1", "s2")]))
        out = []
        if asked:
            blobs = texts.column("hashes").to_pylist()
            found = _block_frequencies(blobs, others)
            for *key, blob, (_, _, df) in zip(*[texts.column(c).to_pylist() for c in ("doc_id", "s1", "s2")], blobs, found):
                if tuple(key) in asked:
                    asked.remove(tuple(key))             # of rows that repeat a doc_id and text one
                    out.append((key[0], blob, df.astype("<u4").tobytes()))
        return pa.table({"rep": pa.array([x[0] for x in out], pa.int64()), "hashes": pa.array([x[1] for x in out], pa.binary()),
                         "df": pa.array([x[2] for x in out], pa.binary())})

    others = answers.unionByName(wanted, allowMissingColumns=True)
    return _texts(table).cogroup(others.groupBy("block")).applyInArrow(run, "rep long, hashes binary, df binary")


def frequent(table: DataFrame, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted shingles of two documents or more (and more than the share PHI of
    them) and their exact df, on the driver: for tests and looks at small corpora."""
    table = written(table, "shingles")             # block numbers hold for one run only
    wanted = table.filter("hashes is not null").select("block", F.col("doc_id").alias("rep"), "s1", "s2")
    rows = with_frequencies(table, document_frequencies(table), wanted).collect()
    h, first = np.unique(np.concatenate([_uniques(unpack(r["hashes"]))[0] for r in rows]), return_index=True)
    df = np.concatenate([np.frombuffer(r["df"], "<u4") for r in rows])[first].astype(float)
    held = df > max(1, PHI * n_docs)
    return h[held], df[held]


class Weights:
    """tf-idf weights of a text's shingles by a table of df (as of ``frequent``);
    those not in ``shingles`` have df 1."""

    def __init__(self, shingles: np.ndarray, df: np.ndarray, n_docs: int):
        self.shingles = shingles
        self.idf = np.log1p(max(1, n_docs) / df) if len(df) else df
        self.rare = float(np.log1p(max(1, n_docs)))

    def __call__(self, blob: bytes) -> tuple[np.ndarray, np.ndarray]:
        h, tf = _uniques(unpack(blob))
        idf = np.full(len(h), self.rare)
        if len(self.shingles):
            at = np.minimum(np.searchsorted(self.shingles, h), len(self.shingles) - 1)
            hit = self.shingles[at] == h
            idf[hit] = self.idf[at[hit]]
        return h, tf * idf


def _own_weights(rows: list[tuple], n_docs: int):
    """The weights of texts that carry their df: rows (.., packed shingles, packed df)."""
    known = {r[2]: r[3] for r in rows}

    def weights(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
        h, tf = _uniques(unpack(blob))
        return h, tf * np.log1p(n_docs / np.frombuffer(known[blob], "<u4"))

    return weights


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum()
    return float(low / (a[1].sum() + b[1].sum() - low))


class Sampler:
    """Improved consistent weighted sampling: sample k of a weighted set is the
    element (and its quantised level) that minimises ln a = ln c - r (t - beta) - r."""

    def __init__(self, n: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.r, c = rng.gamma(2, 1, 1 << 16), rng.gamma(2, 1, 1 << 16)
        self.beta, self.ln_c = rng.random(1 << 16), np.log(c)
        self.odd = rng.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        least = np.full(len(self.odd), np.inf)
        chosen, level = np.zeros(len(self.odd), np.uint64), np.zeros(len(self.odd))
        samples = np.arange(len(self.odd))
        for lo in range(0, len(h), ELEMENTS):                # the matrices of a long text stay small
            part = h[lo:lo + ELEMENTS]
            at = ((mixed(part)[None, :] * self.odd[:, None]) >> np.uint64(48)).astype(np.int64)
            r, beta = self.r[at], self.beta[at]
            t = np.floor(np.log(w[lo:lo + ELEMENTS])[None, :] / r + beta)
            a = self.ln_c[at] - r * (t - beta) - r
            best = a.argmin(axis=1)
            low = a[samples, best]
            less = low < least
            least[less], chosen[less], level[less] = low[less], part[best[less]], t[samples, best][less]
        return mixed(chosen * MIX2 + mixed(level.astype(np.int64).view(np.uint64)))


def _levels(blob: bytes, weights: Weights) -> tuple[np.ndarray, np.ndarray, float]:
    """Features (shingle, occurrence) of a text, each with its idf, and the text's
    whole weight: the weight that two texts share is the sum over common
    features, as min(tf_a, tf_b) counts the occurrences both reach."""
    h = unpack(blob)
    u, w = weights(blob)
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    tf = np.diff(np.r_[first, len(h)])
    level = (np.arange(len(h)) - np.repeat(first, tf)).astype(np.uint64)
    return mixed(h + (level << np.uint64(40))), np.repeat(w / tf, tf), float(w.sum())


def similarities(left: list[bytes], right: list[bytes], weights: Weights) -> np.ndarray:
    """Weighted Jaccard similarity of every text of ``left`` with every one of ``right``."""
    texts = [_levels(b, weights) for b in (left if left is right else [*left, *right])]
    n, m = len(left), len(right)
    feats = np.concatenate([t[0] for t in texts])
    idf = np.concatenate([t[1] for t in texts])
    row = np.repeat(np.arange(len(texts)), [len(t[0]) for t in texts])
    order = np.argsort(feats, kind="stable")
    feats, idf, row = feats[order], idf[order], row[order]
    first = np.flatnonzero(np.r_[True, feats[1:] != feats[:-1]])
    size = np.diff(np.r_[first, len(feats)])
    shared = np.repeat(size > 1, size)         # a feature of one text adds nothing
    row, root = row[shared], np.sqrt(idf[shared])
    col = np.repeat(np.arange((size > 1).sum()), size[size > 1])
    common = np.zeros((n, m))
    for at in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
        lo, hi = np.searchsorted(col, [at, at + COLUMNS])
        x = np.zeros((len(texts), min(COLUMNS, int(col[-1]) + 1 - at)))
        x[row[lo:hi], col[lo:hi] - at] = root[lo:hi]
        common += x[:n] @ (x if left is right else x[n:]).T
    total = np.array([t[2] for t in texts])
    return common / (total[:n, None] + total[len(texts) - m:][None, :] - common)


def _forest(links: np.ndarray, ids_left: list[int], ids_right: list[int]) -> list[tuple[int, int]]:
    """Edges that connect what the links (index pairs) connect, one less than the texts at most."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    edges = []
    for i, j in links.tolist():
        a, b = top(ids_left[i]), top(ids_right[j])
        if a != b:
            root[max(a, b)] = min(a, b)
            edges.append((max(a, b), min(a, b)))
    return edges


def _portions(rows: list[tuple]):
    """Rows (.., packed shingles, df) in portions of ``COMPARED`` shingles, or one longer text."""
    at, size = 0, 0
    for k, r in enumerate(rows):
        if k > at and size + len(r[2]) // 5 > COMPARED:
            yield rows[at:k]
            at, size = k, 0
        size += len(r[2]) // 5
    yield rows[at:]


def _compare(n_docs: int, similarity: float):
    """Rows sorted by unit (band, key, c1, c2) -> edges a, b of the units' links."""
    def run(batches):
        unit, rows = None, []

        def finish():
            if len(rows) < 2:
                return []
            left = [r for r in rows if r[0] == unit[2]]
            right = left if unit[2] == unit[3] else [r for r in rows if r[0] == unit[3]]
            if not left or not right:
                return []
            edges = []
            halves = list(_portions(left))
            for i, one in enumerate(halves):
                for other in halves[i:] if left is right else _portions(right):
                    texts = [r[2] for r in one]
                    weights = _own_weights(one if one is other else [*one, *other], n_docs)
                    sim = similarities(texts, texts if one is other else [r[2] for r in other], weights)
                    if one is other:
                        sim = np.triu(sim, 1)
                    edges += _forest(np.argwhere(sim >= similarity - 1e-12), [r[1] for r in one], [r[1] for r in other])
            return edges

        for b in (part for whole in batches for part in sliced(whole, "hashes", BATCH_BYTES)):
            edges = []
            for band, key, c1, c2, c, rep, hashes, df in zip(*[b.column(k).to_pylist() for k in ("band", "key", "c1", "c2", "c", "rep", "hashes", "df")]):
                if (band, key, c1, c2) != unit:
                    edges += finish()
                    unit, rows = (band, key, c1, c2), []
                rows.append((c, rep, hashes, df))
            yield pa.record_batch({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})
        edges = finish()
        yield pa.record_batch({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return run


def _buckets(members: DataFrame) -> DataFrame:
    """band, key, n of the buckets with two members or more, one of those with equal members."""
    found = members.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y")).filter("n > 1")
    return found.groupBy("n", "x", "y").agg(F.min(F.struct("band", "key")).alias("b")).select("b.band", "b.key", "n")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its near-duplicate group) and
    kept (doc_id = class_id) of every row."""
    spark = docs.sparkSession
    name = f"shingles_{uuid.uuid4().hex}"
    table_at = f"{shared_dir(spark)}/{name}"
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shingle_table(docs).write.bucketBy(n_buckets, "block").sortBy("block").option("path", table_at).saveAsTable(name, format="parquet")
    table = spark.table(name)
    n_docs = table.filter("hashes is not null").count()
    answers = written(document_frequencies(table), "frequencies")
    # rep is the smallest doc_id of a class of equal word sequences
    reps = written(band_table(table, answers, n_docs).groupBy("s1", "s2").agg(
        F.min("doc_id").alias("rep"), F.min_by("block", "doc_id").alias("block"), F.first("keys").alias("keys")), "bands")
    members = reps.select("rep", F.posexplode("keys").alias("band", "key"))
    inside = written(members.join(written(_buckets(members), "buckets"), ["band", "key"]), "members")
    # A doc_id can occur more than once; the representative's own word sequence counts.
    own = reps.select("block", "rep", "s1", "s2").join(inside.select("rep").distinct(), "rep", "left_semi")
    shingles = written(with_frequencies(table, answers, own).dropDuplicates(["rep"]), "compared")
    digests = written(table.select("doc_id", "s1", "s2"), "digests")
    spark.sql(f"DROP TABLE {name}")
    discard(spark, table_at)
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    units = inside.withColumn("c", F.pmod(F.xxhash64("rep", F.lit(2)), chunks).cast("int")).withColumn(
        "o", F.explode(F.sequence(F.lit(0), chunks - 1))).select(
        "band", "key", F.least("c", "o").alias("c1"), F.greatest("c", "o").alias("c2"), "c", "rep")
    unit = ["band", "key", "c1", "c2"]
    rows = units.join(shingles, "rep").repartition(*[F.col(k) for k in unit]).sortWithinPartitions(*unit, "rep")
    links = rows.select(*unit, "c", "rep", "hashes", "df").mapInArrow(_compare(n_docs, similarity), "a long, b long")
    label = written(components(links), "labels")
    of_class = reps.select("s1", "s2", "rep").join(label, F.col("rep") == F.col("node"), "left").select(
        F.col("s1").alias("t1"), F.col("s2").alias("t2"), F.coalesce("component", "rep").alias("class_id"))
    wordy = digests.filter("s1 is not null").join(of_class, (F.col("s1") == F.col("t1")) & (F.col("s2") == F.col("t2"))).select("doc_id", "class_id")
    out = wordy.unionByName(digests.filter("s1 is null").select("doc_id", F.col("doc_id").alias("class_id")))
    return out.withColumn("kept", F.col("doc_id") == F.col("class_id"))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of every near-duplicate group (the smallest
    doc_id; of rows that repeat a doc_id one)."""
    found = written(classes(docs, similarity), "classes")
    per = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    dropped = written(per.filter("not kept or n > 1").select(F.col("doc_id").alias("_id"), "kept"), "dropped")
    out = docs.join(dropped, F.col("doc_id") == F.col("_id"), "left_anti")
    repeated = dropped.filter("kept").select("_id")
    if repeated.isEmpty():
        return out
    return out.unionByName(docs.join(repeated, F.col("doc_id") == F.col("_id"), "left_semi").dropDuplicates(["doc_id"]))
