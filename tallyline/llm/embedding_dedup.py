"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised; table t hashes a vector to the quantised values
floor((a . v + b) / W) of ``PROJECTIONS`` random Gaussian directions, folded to
32 bits.  Vectors that share a bucket of any table are compared exactly by
cosine in double precision.  At cosine 0.9 (distance 0.447) a table finds a
pair with probability 0.14, all tables together with 0.992; at 0.95 with
0.9999.

Equal vectors are one class first, so copies never meet each other.  Buckets
are compared inside tasks block by block and give back, per vector, the number
of links and one edge into its group, never the pairs.  A pair that shares
several buckets counts in the first table where it does; every row carries its
bucket keys of all tables for that.  A bucket of more than ``BLOCK`` rows is
cut into chunks by a hash of the id, and each pair of chunks is a task unit of
its own, so no bucket has to fit one task.

Only ids are grouped by bucket.  Buckets of one vector end there, and of
buckets with equal members the first table's one stays, which is where its
pairs count; the vectors then join the buckets that are left.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths link with nothing
of another length; repeated rows count as copies (each other's links); an
empty table gives an empty table; other columns (labels) are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

SIMILARITY = 0.9
TABLES, PROJECTIONS, W = 32, 10, 2.0
BLOCK = 512
SEED = 5
FOUND = "id long, links long, other long"


def _unit(v: np.ndarray) -> np.ndarray:
    """Unit vectors; rows are first scaled by a power of two, so that no square over- or underflows."""
    _, e = np.frexp(np.abs(v).max(axis=1, keepdims=True))
    v = np.ldexp(v, -e)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _keys(unit: np.ndarray) -> np.ndarray:
    """int32 bucket keys (rows x TABLES) of unit vectors."""
    rng = np.random.default_rng(SEED)
    a = rng.standard_normal((unit.shape[1], TABLES * PROJECTIONS))
    cells = np.floor((unit @ a + rng.random(TABLES * PROJECTIONS) * W) / W).astype(np.int64).reshape(len(unit), TABLES, PROJECTIONS)
    h = np.zeros((len(unit), TABLES), np.uint64)
    for k in range(PROJECTIONS):
        h = (h ^ cells[:, :, k].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _hashed(batches, stored: str):
    """(id, size, v) -> the same with v packed, its length and its bucket keys of all tables."""
    for b in batches:
        vectors = b.column("v")
        dims = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            same = np.flatnonzero(dims == dim)
            for at in range(0, len(same), BLOCK):
                rows = pa.array(same[at:at + BLOCK])
                part = vectors.take(rows)
                v = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
                keys = _keys(_unit(v))
                yield pa.record_batch({
                    "id": b.column("id").take(rows), "size": b.column("size").take(rows), "dim": pa.array(np.full(len(rows), dim, np.int32)),
                    "v": pa.array([x.tobytes() for x in v.astype(stored)], pa.binary()),
                    "keys": pa.array([x.tobytes() for x in keys], pa.binary()),
                    "buckets": pa.ListArray.from_arrays(np.arange(0, keys.size + 1, TABLES, dtype=np.int32), keys.ravel())})


class _Block:
    """Vectors of one bucket (or chunk of it) as arrays."""

    def __init__(self, rows: list[tuple], stored: str):
        self.id = np.array([r[0] for r in rows], np.int64)
        self.size = np.array([r[1] for r in rows], np.int64)
        self.unit = _unit(np.stack([np.frombuffer(r[2], stored) for r in rows]).astype(np.float64))
        self.keys = np.stack([np.frombuffer(r[3], np.int32) for r in rows])


def _compare(t: int, x: _Block, y: _Block, same: bool, similarity: float, links: dict, edges: list) -> None:
    """Count the links between two blocks whose first shared table is ``t``."""
    for at in range(0, len(x.id), BLOCK):
        i, j = np.nonzero(x.unit[at:at + BLOCK] @ y.unit.T >= similarity)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for cut in range(0, len(i), 100_000):
            a, b = i[cut:cut + 100_000], j[cut:cut + 100_000]
            new = ~(x.keys[a, :t] == y.keys[b, :t]).any(axis=1) if t else np.ones(len(a), bool)
            a, b = a[new], b[new]
            for ids, sizes in ((x.id[a], y.size[b]), (y.id[b], x.size[a])):
                u, inv = np.unique(ids, return_inverse=True)
                for k, n in zip(u.tolist(), np.bincount(inv, sizes).astype(np.int64).tolist()):
                    links[k] = links.get(k, 0) + n
            edges.append(np.stack([x.id[a], y.id[b]]))


def _forest(edges: list[np.ndarray]) -> dict[int, int]:
    """A spanning forest of the edges: node -> another node of its group."""
    root: dict[int, int] = {}

    def top(n: int) -> int:
        while root.get(n, n) != n:
            root[n] = root.get(root[n], root[n])
            n = root[n]
        return n

    out = {}
    for pair in edges:
        for a, b in pair.T.tolist():
            p, q = top(a), top(b)
            if p != q:
                hi, lo = max(p, q), min(p, q)
                root[hi] = lo
                out[hi] = lo
    return out


def _search(similarity: float, stored: str):
    def run(batches):
        unit, rows = None, []

        def finish():
            if len(rows) < 2:
                return
            t, _, _, c1, c2 = unit
            links, edges = {}, []
            if c1 == c2:
                block = _Block([r[1:] for r in rows], stored)
                _compare(t, block, block, True, similarity, links, edges)
            else:
                left, right = [r[1:] for r in rows if r[0] == c1], [r[1:] for r in rows if r[0] == c2]
                if left and right:
                    _compare(t, _Block(left, stored), _Block(right, stored), False, similarity, links, edges)
            if links:
                to = _forest(edges)
                ids = list(links)
                yield pa.record_batch({"id": pa.array(ids, pa.int64()), "links": pa.array([links[k] for k in ids], pa.int64()),
                                       "other": pa.array([to.get(k, k) for k in ids], pa.int64())})

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("t", "key", "dim", "c1", "c2", "c", "id", "size", "v", "keys")]
            for t, key, dim, c1, c2, c, *rest in zip(*cols):
                if (t, key, dim, c1, c2) != unit:
                    yield from finish()
                    unit, rows = (t, key, dim, c1, c2), []
                rows.append((c, *rest))
        yield from finish()

    return run


def _buckets(members: DataFrame) -> DataFrame:
    """t, key, dim, n of the buckets of two vectors and more; of those with equal members the first table's."""
    whole = members.groupBy("dim", "t", "key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).filter("n > 1")
    return whole.groupBy("dim", "n", "x", "y").agg(F.min(F.struct("t", "key")).alias("b")).select("b.t", "b.key", "dim", "n")


def links(embeddings: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    stored = "<f4" if "float" in embeddings.schema["embedding"].dataType.simpleString() else "<f8"
    v = F.transform("embedding", lambda x: x.cast("double"))
    usable = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    # -0.0 and 0.0 are one value; the key of equal vectors is the array itself.
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).select(
        "vec_id", F.when(F.coalesce(usable, F.lit(False)), F.transform("v", lambda x: x + 0.0)).alias("v"))
    copies = rows.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("size"))
    classes = written(copies, "vector-classes")
    hashed = written(classes.select("id", "size", "v").mapInArrow(
        lambda batches: _hashed(batches, stored), "id long, size long, dim int, v binary, keys binary, buckets array<int>"), "vectors")
    bucket, units = ["t", "key", "dim"], ["t", "key", "dim", "c1", "c2"]
    members = hashed.select("id", "dim", F.posexplode("buckets").alias("t", "key"))
    inside = members.join(written(_buckets(members), "vector-buckets"), bucket)
    chunks = F.ceil(F.col("n") / BLOCK).cast("int")
    split = inside.withColumn("c", F.pmod(F.xxhash64("id"), chunks).cast("int")).select(
        *bucket, "c", "id", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("o")).select(
        *bucket, F.least("c", "o").alias("c1"), F.greatest("c", "o").alias("c2"), "c", "id")
    rows_of = split.join(hashed.select("id", "size", "v", "keys"), "id").select(*units, "c", "id", "size", "v", "keys")
    found = rows_of.repartition(*[F.col(c) for c in units]).sortWithinPartitions(*units, "id").mapInArrow(_search(similarity, stored), FOUND)
    found = written(found, "vector-links")
    label = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    per = classes.join(counts, "id", "left").join(label, F.col("id") == F.col("node"), "left").select(
        F.col("v").alias("_v"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component", "id").alias("c"))
    # Copies find their class by a hash of the vector and the vector itself.
    return rows.join(per, F.col("v") == F.col("_v"), "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))
