"""Byte-level BPE encoding and decoding.

A text is cut by the tokenizer's pattern; the distinct pieces are encoded in
numpy.  Pieces are padded into matrices of token ids, one matrix per length
bucket.  In each round every row merges its leftmost pair of minimum rank:
pair ranks come from an open-addressing hash table of all mergeable pairs, the
merged column is dropped from every row (compaction by column), and rows
without a mergeable pair leave the matrix (compaction by row).  Pieces longer
than ``LONGEST`` bytes run the same rule on a heap, since a matrix round costs
their whole width.

The vocabulary (bounded, about 1 MB) is read on the driver and travels with
the tasks; the encoded pieces are remembered per task up to
``REMEMBER`` pieces, which bounds memory and changes no result.

Defined results: a null or empty text has no tokens; repeated rows are encoded
each; an empty table gives an empty table; only ``doc_id`` and ``text`` are
read, so further columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import sliced

LONGEST = 512
REMEMBER = 150_000
CHUNK_CHARS = 1_000_000
NONE = np.int32(2**31 - 1)


def load_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank of a rank file (base64 token, space, rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PairTable:
    """(left id, right id) -> merged id in an open-addressing numpy hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        pairs = {(ranks[t[:i]] << 32) | ranks[t[i:]]: r for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks}
        keys = np.fromiter(pairs.keys(), np.uint64, len(pairs))
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        self.bits = max(4, int(4 * max(1, len(pairs)) - 1).bit_length())
        self.mask = np.uint64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max, np.uint64)
        self.values = np.full(1 << self.bits, NONE, np.int32)
        slot = self._slot(keys)
        while len(keys):                       # every round places the first claimant of each free slot
            free = self.keys[slot] == np.iinfo(np.uint64).max
            _, first = np.unique(slot[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.keys[slot[placed]], self.values[slot[placed]] = keys[placed], values[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + np.uint64(1)) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids (= ranks) of the pairs; NONE where they do not merge or one is padding (-1)."""
        out = np.full(left.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left.ravel()[todo].astype(np.uint64) << np.uint64(32)) | right.ravel()[todo].astype(np.uint64)
        slot, flat = self._slot(keys), out.reshape(-1)
        while len(todo):
            there = self.keys[slot]
            hit = there == keys
            flat[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (there != np.iinfo(np.uint64).max)
            todo, keys, slot = todo[on], keys[on], (slot[on] + np.uint64(1)) & self.mask
        return out


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.pairs = PairTable(ranks)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.token = {r: t for t, r in ranks.items()}
        self.decimal = {r: str(r) for r in ranks.values()}
        self.known: dict[str, tuple[int, ...]] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Token ids of every piece."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            whole = self.ranks.get(p)
            if whole is not None:
                out[k] = (whole,)
            elif len(p) > LONGEST:
                out[k] = self._merge_long(p)
            else:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(k)
        for bits, rows in buckets.items():
            self._merge_matrix([pieces[k] for k in rows], 1 << bits, rows, out)
        return out

    def _merge_matrix(self, pieces: list[bytes], width: int, where: list[int], out: list) -> None:
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        ids = np.where(np.arange(width) < lengths[:, None], self.byte_id[raw], np.int32(-1))
        ranks = self.pairs(ids[:, :-1], ids[:, 1:])
        row = np.array(where)
        while len(row):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), np.int64)
            best = ranks[np.arange(len(row)), at] if ranks.shape[1] else np.full(len(row), NONE)
            on = best != NONE
            if not on.all():
                for k, line, size in zip(row[~on], ids[~on].tolist(), lengths[~on].tolist()):
                    out[k] = tuple(line[:size])
                ids, ranks, row, lengths, at, best = ids[on], ranks[on], row[on], lengths[on], at[on], best[on]
                if not len(row):
                    return
            m = np.arange(len(row))
            ids[m, at] = best
            keep = np.ones(ids.shape, bool)
            keep[m, at + 1] = False
            ids = ids[keep].reshape(len(row), -1)
            keep = np.ones(ranks.shape, bool)
            keep[m, at] = False
            ranks = ranks[keep].reshape(len(row), -1)
            lengths = lengths - 1
            for left in (at - 1, at):          # the two pairs that the merged token is part of
                ok = (left >= 0) & (left < ranks.shape[1])
                ranks[m[ok], left[ok]] = self.pairs(ids[m[ok], left[ok]], ids[m[ok], left[ok] + 1])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        n = len(piece)
        ids = self.byte_id[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks, token = self.ranks, self.token
        heap = [(int(r), k) for k, r in enumerate(self.pairs(np.array(ids[:-1]), np.array(ids[1:]))) if r != NONE]
        heapq.heapify(heap)
        while heap:
            r, k = heapq.heappop(heap)
            j = after[k] if ids[k] >= 0 else n
            if j >= n or token[ids[k]] + token[ids[j]] != token[r]:
                continue                       # one of the two has merged since
            ids[k], ids[j], after[k] = r, -1, after[j]
            if after[k] < n:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (m := ranks.get(token[ids[a]] + token[ids[b]])) is not None:
                    heapq.heappush(heap, (m, a))
        return tuple(x for x in ids if x >= 0)

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        cut = [self.find(t) for t in texts]
        new = list(set().union(*cut) - self.known.keys())
        self.known.update(zip(new, self.encode_pieces([p.encode() for p in new])))
        ids = [list(chain.from_iterable(map(self.known.__getitem__, pieces))) for pieces in cut]
        if len(self.known) > REMEMBER:
            self.known.clear()
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _codec(ranks_file: bytes, pattern: str) -> Codec:
    """A codec of one task: what it remembers goes with the task."""
    return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}, pattern)


def _vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ``ids`` (array of token ids) and the SHA-256 of the bytes
    that the ids decode to, of every row."""
    return _apply(docs, path, pattern, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string", lambda codec, ids: {
        "n_tokens": pa.array(list(map(len, ids)), pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32())),
        "decoded_sha256": pa.array([hashlib.sha256(codec.decode(i)).hexdigest() for i in ids], pa.string())})


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and ``text`` (the decoded bytes as a string) of rows doc_id, ids."""
    ranks_file = _vocabulary(path)

    def run(batches):
        codec = _codec(ranks_file, ".")
        for b in batches:
            for part in sliced(b, "ids", CHUNK_CHARS):
                yield pa.record_batch({"doc_id": part.column("doc_id"), "text": pa.array(
                    [codec.decode(i or []).decode("utf-8", "replace") for i in part.column("ids").to_pylist()], pa.string())})

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids (decimal, comma-joined) and of the decoded bytes."""
    def columns(codec, ids):
        sha = [hashlib.sha256(",".join(map(codec.decimal.__getitem__, i)).encode()).hexdigest() for i in ids]
        back = [hashlib.sha256(codec.decode(i)).hexdigest() for i in ids]
        return {"n_tokens": pa.array(list(map(len, ids)), pa.int64()), "ids_sha256": pa.array(sha, pa.string()),
                "decoded_sha256": pa.array(back, pa.string())}

    return _apply(docs, path, pattern, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def _apply(docs: DataFrame, path: str, pattern: str, schema: str, columns) -> DataFrame:
    ranks_file = _vocabulary(path)

    def run(batches):
        codec = _codec(ranks_file, pattern)
        for b in batches:
            for part in sliced(b, "text", CHUNK_CHARS):
                out = columns(codec, codec.encode_batch([t or "" for t in part.column("text").to_pylist()]))
                yield pa.record_batch({"doc_id": part.column("doc_id")} | out)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, schema)
