"""Periodic runs of words by block convolution.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) of at least ``LEAST`` words and ``EXPONENT`` periods.  Many texts are laid
end to end in one array of word numbers and searched at once, at the dyadic
scales B = 8, 16, 32, ...:

1. The array is cut into blocks of B words.  A run of period q with
   B <= q < 2B (at the scale 8: any q < 16) has at least 3q words, so one whole
   block lies in it together with its copy q words on.
2. For every block, the sums of squared differences to all windows that begin B
   to 2B-1 words on (1 to 15 at the scale 8) come from one number-theoretic
   transform modulo 15 * 2^27 + 1: exact integers, so an occurrence without a
   mismatch is a zero.  (A zero that is only one modulo the prime is told apart
   by comparing the words.)
3. Block and distance d seed an extension: the stretch of positions equal to the
   one d on, left and right of the block, gives the run's ends.  Inside a run of
   period q the multiples of q need no extension.

A block is only transformed when each of its words occurs again in its text at
less than 2B words' distance (15 at the scale 8), which every block of a run
fulfils.  Texts are searched whole; a chunk is closed at ``CHUNK`` words, a longer
text is a chunk of its own.  No row is shuffled.

Defined results: a null, empty or blank text has no runs and an empty collapsed
text; repeated rows get equal results; runs may overlap, each is reported; an
empty table gives an empty table; only ``doc_id`` and ``text`` are read, so
further columns cannot clash; a null doc_id stays null.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, sliced, words

LEAST, EXPONENT = 24, 3
BASE_SCALE = 8                        # 2 * 8 - 1 + q <= 24 for every q that the scale answers for
CHUNK = 200_000                       # words searched at once
BATCH_CHARS = 4_000_000               # characters cut into words at once, or one longer text
MATRIX = 1 << 21                      # numbers of one transformed matrix
PRIME, ROOT = 15 * 2**27 + 1, 31      # transforms of up to 2^27 numbers
P = np.uint64(PRIME)
RUNS = "array<struct<start:long,length:long,period:long>>"
_find = re.compile(WORD).findall


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % P])
    return out[:n]


class Transform:
    """Number-theoretic transform of every row of a matrix of ``size`` columns."""

    def __init__(self, size: int):
        self.size = size
        root = pow(ROOT, (PRIME - 1) // size, PRIME)
        self.forth, self.back = _powers(root, size // 2), _powers(pow(root, -1, PRIME), size // 2)
        self.scale = np.uint64(pow(size, -1, PRIME))

    def forward(self, x: np.ndarray) -> np.ndarray:
        """Values in bit-reversed order (decimation in frequency)."""
        x, half = x.copy(), self.size // 2
        while half:
            v = x.reshape(len(x), -1, 2, half)
            a, b = v[:, :, 0].copy(), v[:, :, 1]
            v[:, :, 0] = (a + b) % P
            v[:, :, 1] = (a + P - b) * self.forth[::self.size // 2 // half] % P
            half //= 2
        return x

    def inverse(self, x: np.ndarray) -> np.ndarray:
        """From bit-reversed order back (decimation in time)."""
        x, half = x.copy(), 1
        while half < self.size:
            v = x.reshape(len(x), -1, 2, half)
            a, b = v[:, :, 0].copy(), v[:, :, 1] * self.back[::self.size // 2 // half] % P
            v[:, :, 0] = (a + b) % P
            v[:, :, 1] = (a + P - b) % P
            half *= 2
        return x * self.scale % P


def mismatches(blocks: np.ndarray, windows: np.ndarray, transform: Transform) -> np.ndarray:
    """Sum over j of (block[j] - window[k + j])^2 modulo the prime, for every row
    and every k at which the block lies within the window."""
    n, b = blocks.shape
    shifts = windows.shape[1] - b + 1
    left = np.zeros((n, transform.size), np.uint64)
    left[:, 0], left[:, transform.size - b + 1:] = blocks[:, 0], blocks[:, :0:-1]      # block[-j]
    right = np.zeros((n, transform.size), np.uint64)
    right[:, :windows.shape[1]] = windows
    product = transform.inverse(transform.forward(left) * transform.forward(right) % P)[:, :shifts]
    squares = np.cumsum(np.pad(windows * windows % P, ((0, 0), (1, 0))), axis=1)
    own = (blocks * blocks % P).sum(axis=1, keepdims=True)
    return (own + squares[:, b:] - squares[:, :shifts] + np.uint64(2) * (P - product)) % P


class _Extender:
    """Maximal stretches of one distance around blocks that recur at it."""

    def __init__(self, code: np.ndarray):
        self.code = code

    def __call__(self, at: int, d: int, block: int) -> tuple[int, int]:
        """Begin and end (exclusive) of the stretch of period d around [at, at + block + d)."""
        code, lo, hi, step = self.code, at, at + block, max(64, block)
        while lo > 0:
            n = min(step, lo)
            miss = np.flatnonzero(code[lo - n:lo] != code[lo - n + d:lo + d])
            if len(miss):
                lo += int(miss[-1]) + 1 - n
                break
            lo, step = lo - n, 2 * step
        step, end = max(64, block), len(code) - d
        while hi < end:
            n = min(step, end - hi)
            miss = np.flatnonzero(code[hi:hi + n] != code[hi + d:hi + d + n])
            if len(miss):
                hi += int(miss[0])
                break
            hi, step = hi + n, 2 * step
        return lo, hi + d


def _next_distance(code: np.ndarray) -> np.ndarray:
    """Distance from every position to the next equal number."""
    order = np.argsort(code, kind="stable")
    out = np.full(len(code), len(code) + 1, np.int64)
    same = code[order[1:]] == code[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def find_runs(code: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``code``, ordered.  ``longest`` bounds
    the length of a run (the longest of the texts laid end to end)."""
    code = code.astype(np.uint64)
    n, extend, later = len(code), _Extender(code), _next_distance(code)
    found: dict[tuple[int, int], int] = {}
    scale = BASE_SCALE
    while EXPONENT * (scale if scale > BASE_SCALE else 1) <= longest and scale <= n:
        first = 1 if scale == BASE_SCALE else scale          # smallest distance of this scale
        reach = 2 * scale - first                            # distances first .. 2 * scale - 1
        whole = n // scale
        starts = np.flatnonzero(later[:whole * scale].reshape(whole, scale).max(axis=1) < 2 * scale) * scale
        transform = Transform(1 << (scale + reach - 2).bit_length())
        # Stretches known at this point, by period: what lies inside needs no second look.
        known: dict[int, list[tuple[int, int]]] = {}
        for (s, e), q in found.items():
            known.setdefault(q, []).append((s, e))
        for stretches in known.values():
            stretches.sort()
        inside = _Inside(known)
        rows = max(1, MATRIX // transform.size)
        padded = np.concatenate([code, np.full(3 * scale, P - np.uint64(1))])
        for lo in range(0, len(starts), rows):
            part = starts[lo:lo + rows]
            blocks = padded[part[:, None] + np.arange(scale)]
            windows = padded[part[:, None] + first + np.arange(reach + scale - 1)]
            zero = mismatches(blocks, windows, transform) == 0
            for k in np.flatnonzero(zero.any(axis=0)).tolist():
                d, ats, j = k + first, part[zero[:, k]], 0
                while j < len(ats):
                    at = int(ats[j])
                    end = inside(at, at + d + scale, d)
                    if not end and at + d + scale <= n and (code[at:at + scale] == code[at + d:at + d + scale]).all():
                        begin, end = extend(at, d, scale)
                        inside.add(d, begin, end)
                        if end - begin >= max(LEAST, EXPONENT * d):
                            found[begin, end] = min(d, found.get((begin, end), d))
                    # The blocks up to the stretch's end are answered with it.
                    j = max(j + 1, int(np.searchsorted(ats, end - d - scale, "right")))
        scale *= 2
    return sorted((s, e - s, q) for (s, e), q in found.items())


class _Inside:
    """Known stretches by period, to find one that holds another and whose period divides d."""

    def __init__(self, known: dict[int, list[tuple[int, int]]]):
        self.known = known

    def add(self, d: int, s: int, e: int) -> None:
        spans = self.known.setdefault(d, [])
        spans.insert(bisect_left(spans, (s, e)), (s, e))

    def __call__(self, s: int, e: int, d: int) -> int:
        """The end of the stretch that holds this one, else 0."""
        for q, spans in self.known.items():
            if d % q == 0:
                k = bisect_left(spans, (s + 1,)) - 1         # stretches of one period overlap by less than it
                if k >= 0 and spans[k][1] >= e:
                    return spans[k][1]
        return 0


def _dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    step = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        step[s + q] += 1
        step[s + length] -= 1
    return np.cumsum(step[:n]) > 0


def search(texts: list[str | None]) -> list[tuple[int, list[tuple[int, int, int]], str]]:
    """(number of words, runs, collapsed text) of every text."""
    cut = [_find(t) if t else [] for t in texts]
    out, lo = [], 0
    while lo < len(cut):
        hi, size = lo, 0
        while hi < len(cut) and (hi == lo or size + len(cut[hi]) <= CHUNK):
            size, hi = size + len(cut[hi]) + 1, hi + 1
        out += _search_chunk(cut[lo:hi])
        lo = hi
    return out


def _search_chunk(cut: list[list[str]]) -> list[tuple[int, list[tuple[int, int, int]], str]]:
    number: dict[str, int] = {}
    code, begin = [], []
    for k, ws in enumerate(cut):
        begin.append(len(code))
        code.extend([number.setdefault(w, len(number)) for w in ws])
        code.append(-1 - k)                                  # an end that equals nothing
    flat = np.array(code, np.int64)
    ends = flat < 0
    flat[ends] = len(number) - 1 - flat[ends]
    per: list[list[tuple[int, int, int]]] = [[] for _ in cut]
    edges = np.array(begin)
    for s, length, q in find_runs(flat, max(map(len, cut), default=0)):
        k = int(np.searchsorted(edges, s, "right")) - 1
        per[k].append((s - begin[k], length, q))
    out = []
    for ws, runs in zip(cut, per):
        kept = [w for w, gone in zip(ws, _dropped(len(ws), runs).tolist()) if not gone] if runs else ws
        out.append((len(ws), runs, " ".join(kept)))
    return out


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, ``runs`` (start, length, period; ordered) and ``collapsed``
    (the text without the repetitions) of every row."""
    def run(batches):
        for b in batches:
            for part in sliced(b, "text", BATCH_CHARS):
                got = search(part.column("text").to_pylist())
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "n_words": pa.array([g[0] for g in got], pa.int64()),
                    "runs": pa.array([[{"start": s, "length": n, "period": q} for s, n, q in g[1]] for g in got],
                                     pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                    "collapsed": pa.array([g[2] for g in got], pa.string())})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text (by the checksum h of its id) runs
    periodically from a word on: that of number a = g mod n, with the period
    1 + (n - a) div (3 + g mod 8), where g = h div 10."""
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    g = F.expr("div(_h, 10)")

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        def from_(v: Column) -> Column:
            a, p = v["a"].cast("int"), v["p"].cast("int")
            rest = F.size(w) - a
            copies = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil(rest / p).cast("int")))
            return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(copies, F.lit(1), rest)), " ")
        first = g % n
        period = F.lit(1) + F.floor((n - first) / (F.lit(3) + g % 8))
        return F.when(F.size(w) > 0, _bound(F.struct(first.alias("a"), period.alias("p")), from_)).otherwise(F.lit(""))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("_h", h)
    return rows.select("doc_id", F.when(F.col("_h") % 10 == 0, _bound(words(F.col("text")), repeated)).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of the greatest exponent and digests of all runs
    and of the collapsed text."""
    # The greatest exponent exactly: lengths and periods as 64-bit cross products.
    better = lambda a, b: (a["length"] * b["period"] > b["length"] * a["period"]) | (
        (a["length"] * b["period"] == b["length"] * a["period"]) & (F.struct(a["start"], a["period"]) <= F.struct(b["start"], b["period"])))
    best = F.aggregate("runs", F.element_at("runs", 1), lambda a, b: F.when(better(a, b), a).otherwise(b))
    rows = runs(docs)
    lines = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    picked = rows.withColumn("_best", F.when(F.size("runs") > 0, best))
    return picked.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"), F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
        F.expr("div(1000 * _best.length, _best.period)").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
