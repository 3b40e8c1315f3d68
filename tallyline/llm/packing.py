"""Packing token sequences by minimum bin slack.

Every text becomes its token ids and one end id.  Full windows are cut off its
front; what remains (less than a window) waits in a pool.  The pool is packed
window by window, by the multiset of its remaining lengths:

* The longest remaining length opens a window.  A subset-sum dynamic programme
  over the other lengths finds the sum closest to the capacity: bit s of an
  integer says that s can be reached, one shift-and-or per item, no more than
  the pool's count of a length.  The sets before each length are kept, so that
  walking back through them gives how many items of each length are in the sum.
* The multiset found fills as many windows as the pool's counts allow.
* A longest length that no multiset completes waits for the next items.  When
  the pool is closed (at the end of a task, or when ``POOL`` tokens still wait),
  the closest multiset is taken and its slack is filled with a piece cut off a
  waiting remainder.  The last tokens of a task, less than a window, become
  sequences of the powers of two that they are the sum of: these need no padding.

Nothing is shuffled: a task packs what it reads, holds ``POOL`` tokens plus its
longest text, and numbers its sequences by its partition.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; an empty table gives an empty table; only ``doc_id`` and ``text``
are read, so further columns cannot clash; a null doc_id stays null.  Special
tokens' names in a text are ordinary text.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced

CAPACITY = 2048
END = 1
POOL = 2_000_000            # tokens that wait before they are packed
REMEMBER = 400_000          # chunks, and pieces, a worker remembers
BATCH_CHARS = 10_000_000    # characters encoded at once, or one longer text
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
MARK = "\x01"
_latin = re.compile("[\x00-\xff]*").fullmatch


class Encoder:
    """Ids of texts.

    The tokenizer cuts at white space, so the text between (a chunk) stands by
    itself; every distinct chunk is encoded once and remembered.  A Latin-1 chunk,
    which normalisation only lowers, is first cut by the tokenizer's own pattern,
    and its pieces go to the tokenizer's merges alone and are remembered too.  Other
    chunks are encoded as one text with a control character between, whose id none
    without it can have."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        pattern = json.loads(tokenizer_json)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.find = regex.compile(rf"\n|{pattern}").findall
        self.mark = self._ids(MARK)[:1]
        # The tokenizer's characters for bytes: printable ones stand for themselves, the others follow 255 in order.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        self.bytes = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _cut(self, ids: np.ndarray) -> list[bytes]:
        """The ids before every mark."""
        packed, ends = ids.tobytes(), (4 * np.flatnonzero(ids == self.mark)).tolist()
        return [packed[at:end] for at, end in zip([0, *(e + 4 for e in ends)], ends)]

    def _together(self, parts: list[str]) -> list[bytes]:
        return self._cut(self._ids(f" {MARK} ".join([*parts, ""])))

    def _learn(self, new: list[str]) -> None:
        latin, other = [], []
        for c in new:
            if MARK in c:
                self.chunks[c] = self._ids(c).tobytes()
            else:
                (latin if c.isascii() or _latin(c) else other).append(c)
        self.chunks.update(zip(other, self._together(other), strict=True))
        flat = self.find("\n".join([*latin, ""]).lower())
        self._merge(set(flat) - self.pieces.keys() - {"\n"})
        self.pieces["\n"] = self.mark.tobytes()
        packed = b"".join(map(self.pieces.__getitem__, flat))
        self.chunks.update(zip(latin, self._cut(np.frombuffer(packed, "<u4")), strict=True))

    def _merge(self, fresh: set[str]) -> None:
        """Ids of Latin-1 pieces; the model merges the characters that stand for their bytes."""
        merge, ids = self.tokenizer.model.tokenize, []
        for piece in fresh:
            plain = piece.isascii() and piece.isprintable()
            at = len(ids)
            ids += [t.id for t in merge(piece if plain else piece.encode().decode("latin-1").translate(self.bytes))]
            self.pieces[piece] = (at, len(ids))
        packed = np.array(ids, "<u4").tobytes()
        for piece in fresh:
            at, end = self.pieces[piece]
            self.pieces[piece] = packed[4 * at:4 * end]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and where every text's begin (with the end as a last one)."""
        for known in (self.chunks, self.pieces):
            if len(known) > REMEMBER:
                known.clear()
        cut = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        self._learn([c for c in distinct if c not in self.chunks])
        ids_of = list(map(self.chunks.__getitem__, distinct))
        size = np.fromiter(map(len, ids_of), np.int64, len(ids_of)) // 4
        begin, flat = np.cumsum(size) - size, np.frombuffer(b"".join(ids_of), "<u4")
        chunk = coded.indices.to_numpy()
        n = size[chunk]
        end = np.cumsum(n)
        ids = flat[np.repeat(begin[chunk] - (end - n), n) + np.arange(int(n.sum()))]
        return ids, np.r_[0, end][np.r_[0, np.cumsum(pc.list_value_length(cut).to_numpy())]]


def closest(counts: dict[int, int], capacity: int) -> tuple[int, dict[int, int]]:
    """The sum of items closest to the capacity from below, and how many items of
    each length reach it (``counts``: length -> items there are)."""
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= capacity and counts[x]), reverse=True):
        steps.append((length, reach))
        for _ in range(min(counts[length], capacity // length)):
            more = (reach | reach << length) & full
            if more == reach:
                break
            reach = more
        if reach >> capacity & 1:
            break
    best = at = reach.bit_length() - 1
    used = {}
    for length, before in reversed(steps):
        n = 0
        while not before >> at & 1:            # the fewest items of this length
            at, n = at - length, n + 1
        if n:
            used[length] = n
    return best, used


class Packer:
    """Packs (document, start, ids) remainders; emits (sequence, offset, document, start, ids)."""

    def __init__(self, capacity: int = CAPACITY, pool: int = POOL, first_sequence: int = 0):
        self.capacity, self.pool, self.next = capacity, pool, first_sequence
        self.items: dict[int, list[tuple[int, int, bytes]]] = defaultdict(list)     # by length
        self.tokens, self.full_at = 0, pool

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        whole = len(ids) // 4 // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            yield self.next, 0, doc, start, ids[4 * start:4 * (start + self.capacity)]
            self.next += 1
        if len(ids) > 4 * whole:
            self._wait(doc, whole, ids[4 * whole:])
            if self.tokens >= self.full_at:
                yield from self._pack()
                if self.tokens >= self.pool // 2:
                    yield from self._close()
                self.full_at = self.tokens + self.pool // 2

    def finish(self) -> Iterator[tuple]:
        yield from self._pack()
        yield from self._close()
        rest = [x for length in sorted(self.items, reverse=True) for x in self.items[length]]
        self.items.clear()
        for bit in reversed(range(self.tokens.bit_length())):
            if self.tokens >> bit & 1:
                yield from self._fill(rest, 1 << bit, 0)
                self.next += 1
        self.tokens = 0

    def _wait(self, doc, start: int, ids: bytes) -> None:
        self.items[len(ids) // 4].append((doc, start, ids))
        self.tokens += len(ids) // 4

    def _take(self, length: int) -> tuple:
        item = self.items[length].pop()
        if not self.items[length]:
            del self.items[length]
        self.tokens -= length
        return item

    def _fill(self, rest: list[tuple], size: int, offset: int) -> Iterator[tuple]:
        """``size`` tokens off the end of ``rest``, the last of them cut where needed."""
        while size:
            doc, start, ids = rest.pop()
            if len(ids) > 4 * size:
                rest.append((doc, start + size, ids[4 * size:]))
                ids = ids[:4 * size]
            yield self.next, offset, doc, start, ids
            offset, size = offset + len(ids) // 4, size - len(ids) // 4

    def _window(self, used: dict[int, int]) -> Iterator[tuple]:
        offset = 0
        for length, n in used.items():
            for _ in range(n):
                yield self.next, offset, *self._take(length)
                offset += length

    def _pack(self) -> Iterator[tuple]:
        """Every window that a multiset of the pool's lengths completes."""
        counts = {length: len(items) for length, items in self.items.items()}
        for longest in sorted(counts, reverse=True):
            while counts[longest]:
                counts[longest] -= 1
                total, used = closest(counts, self.capacity - longest)
                counts[longest] += 1
                if longest + total < self.capacity:
                    break
                used[longest] = used.get(longest, 0) + 1
                for _ in range(min(counts[x] // n for x, n in used.items())):
                    yield from self._window(used)
                    self.next += 1
                    for x, n in used.items():
                        counts[x] -= n

    def _close(self) -> Iterator[tuple]:
        """Windows of the closest multisets, their slack filled by cutting, until less than a window waits."""
        while self.tokens >= self.capacity:
            counts = {length: len(items) for length, items in self.items.items()}
            longest = max(counts)
            counts[longest] -= 1
            total, used = closest(counts, self.capacity - longest)
            used[longest] = used.get(longest, 0) + 1
            yield from self._window(used)
            slack = self.capacity - longest - total
            if slack:                          # every other item is longer than the slack
                doc, start, ids = self._take(max(self.items))
                yield self.next, longest + total, doc, start, ids[:4 * slack]
                self._wait(doc, start + slack, ids[4 * slack:])
            self.next += 1


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, pool: int = POOL) -> DataFrame:
    """The pieces of every text: doc_id, start (tokens of the text before it),
    length, doc_tokens (with the end id), sequence_id, offset in the sequence and
    ``ids`` (little-endian, 32 bit)."""
    with open(tokenizer, encoding="utf-8") as f:
        tokenizer_json = f.read()
    last = int(end).to_bytes(4, "little")

    def run(batches):
        encode = Encoder(tokenizer_json)
        packer = Packer(capacity, pool, TaskContext.get().partitionId() << 33)

        def batch(pieces: list[tuple]) -> pa.RecordBatch:
            ids = [p[4] for p in pieces]
            return pa.record_batch({
                "doc_id": pa.array([p[2][0] for p in pieces], pa.int64()), "start": pa.array([p[3] for p in pieces], pa.int64()),
                "length": pa.array([len(x) // 4 for x in ids], pa.int64()), "doc_tokens": pa.array([p[2][1] for p in pieces], pa.int64()),
                "sequence_id": pa.array([p[0] for p in pieces], pa.int64()), "offset": pa.array([p[1] for p in pieces], pa.int64()),
                "ids": pa.array(ids, pa.binary())})

        pieces: list[tuple] = []
        for b in batches:
            for part in sliced(b, "text", BATCH_CHARS):
                flat, at = encode(part.column("text"))
                for k, doc_id in enumerate(part.column("doc_id").to_pylist()):
                    ids = flat[at[k]:at[k + 1]].tobytes() + last
                    for piece in packer.add((doc_id, len(ids) // 4), ids):
                        pieces.append(piece)
                        if len(pieces) == 2000:
                            yield batch(pieces)
                            pieces = []
        for piece in packer.finish():
            pieces.append(piece)
            if len(pieces) == 2000:
                yield batch(pieces)
                pieces = []
        yield batch(pieces)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, length and ``ids`` (array) of every sequence of ``pack``."""
    whole = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))       # at most a window's pieces
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.array_join(whole["ids"], "").alias("_hex"))
    id_at = lambda k: F.conv(F.concat(*[F.substring("_hex", 8 * k + 7 - 2 * j, 2) for j in range(4)]), 16, 10).cast("int")
    return rows.select("sequence_id", "length", F.transform(F.sequence(F.lit(0), F.col("length").cast("int") - 1), id_at).alias("ids"))


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces with the checksum of their ids instead of the ids."""
    return pack(docs, tokenizer).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
