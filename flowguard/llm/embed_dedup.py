"""Embedding near-duplicates with randomised-rotation binary codes.

1. Equal vectors of a label become one class with a count (partial aggregation), so copies are
   never compared with each other.
2. A vector is turned by seeded random rotations. The signs of the first turn are its binary code;
   the code's inner product with the turned unit vector is stored as its correction factor. Sign
   bits of further turns form the keys of several hash tables; their number is set so that a pair
   at the threshold is missed by all tables with probability ``MISS`` at most.
3. Vectors that meet under a key are compared in cells of bounded size. code . turned(other) /
   factor estimates the cosine without bias; only pairs whose upper confidence bound reaches the
   threshold are recomputed, in double precision, and linked when the cosine is at least that.
4. A cell emits one row per vector: how many vectors it links there (a pair counts only in the
   first table it shares a key in) and the root of its local component. No pair is emitted.

Cases: a vector that is null, empty, all zero or holds null or non-finite components, or a row with
a null label, links with nothing and is its own component. Vectors of different lengths aren't
compared. Repeated rows stay rows and link with each other. A null ``vec_id`` takes part but names
no component, and is never ``kept`` unless its component has no other id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import cells, components, ready, store, whole_groups

THRESHOLD = 0.98
#: Probability that a pair exactly at the threshold shares no key.
MISS = 1e-4
#: Standard deviations of the estimate's error that the confidence bound allows.
SIGMAS = 4.0
BLOCK = 1024
SEED = 11
_turns: dict[tuple[int, int], np.ndarray] = {}


def turn(dim: int, number: int) -> np.ndarray:
    """The ``number``-th random rotation of ``dim`` dimensions."""
    if (dim, number) not in _turns:
        q, r = np.linalg.qr(np.random.RandomState((SEED, dim, number)).normal(size=(dim, dim)))
        _turns[dim, number] = q * np.sign(np.diag(r))
    return _turns[dim, number]


def table_shape(rows: int, threshold: float = THRESHOLD, miss: float = MISS) -> tuple[int, int]:
    """(bits of a key, number of tables) for labels of up to ``rows`` vectors."""
    bits = min(max(math.ceil(math.log2(max(rows, 1) / 8 + 1)), 4), 30)
    agree = 1 - math.acos(min(threshold, 1 - 1e-9)) / math.pi
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - agree**bits)))


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of the first rotation, and correction factors, of unit rows."""
    y = x @ turn(x.shape[1], 0).T
    return np.packbits(y >= 0, axis=1), np.abs(y).sum(1) / math.sqrt(x.shape[1])


def table_keys(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Sign keys (rows x tables) from rotations 1, 2, ..."""
    dim = x.shape[1]
    signs = np.concatenate([x @ turn(dim, 1 + i).T >= 0 for i in range(math.ceil(bits * tables / dim))], axis=1)
    return signs[:, : bits * tables].reshape(len(x), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def upper_bounds(code: np.ndarray, factor: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Upper confidence bounds of cosines between coded rows and unit rows x."""
    dim = x.shape[1]
    sign = np.unpackbits(code, axis=1, count=dim).astype(np.float32) * 2 - 1
    estimate = sign @ (x @ turn(dim, 0).T).astype(np.float32).T / (math.sqrt(dim) * factor.astype(np.float32)[:, None])
    if dim < 8:
        return np.full(estimate.shape, np.inf)
    return estimate + (SIGMAS * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / math.sqrt(dim - 1)).astype(np.float32)[:, None]


def merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of i and j, in place; a root is the smallest row of its component."""
    while True:
        a, b = root[i], root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root[:] = root[root]


def cell_links(x, size, keys, table, block, code, factor, threshold):
    """Linked vectors counted at each row of a cell, and local roots.

    x: raw vectors in double precision; ``size``: vectors per row; ``block``: only pairs of
    different blocks count when the cell joins two blocks.
    """
    n = len(x)
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    unit = x / norm[:, None]
    count, root = np.zeros(n, np.int64), np.arange(n)
    two = block.min() != block.max()
    for at in range(0, n, 512):
        bound = upper_bounds(code[at : at + 512], factor[at : at + 512], unit)
        i, j = np.nonzero(bound >= threshold - 1e-6)
        i += at
        ok = (i < j) & ((block[i] != block[j]) | (not two))
        i, j = i[ok], j[ok]
        for k in range(0, len(i), 100_000):
            a, b = i[k : k + 100_000], j[k : k + 100_000]
            cosine = np.einsum("ij,ij->i", x[a], x[b]) / (norm[a] * norm[b])
            hit = cosine >= threshold
            a, b = a[hit], b[hit]
            merge(root, a, b)
            new = ~(keys[a, :table] == keys[b, :table]).any(1)
            np.add.at(count, a[new], size[b[new]])
            np.add.at(count, b[new], size[a[new]])
    return count, root


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vectors(vec_id, embedding, label)``."""
    spark = vectors.sparkSession
    ready(spark)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("long").alias("label"))
    usable = F.coalesce(
        F.col("label").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    v = v.withColumn("usable", usable).withColumn("k1", F.xxhash64(F.lit(1), "label", "embedding")).withColumn("k2", F.xxhash64(F.lit(2), "label", "embedding"))
    good = v.where("usable")
    classes = store(
        good.groupBy("k1", "k2").agg(F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count("*").alias("size"), F.min("vec_id").alias("first_id"))
        .withColumn("dim", F.size("embedding")).withColumn("node", F.monotonically_increasing_id()),
        "embed-classes",
    )
    most = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, tables = table_shape(most, threshold)
    kind = dict(classes.dtypes)["embedding"].split("<")[1][:-1]
    if kind not in ("float", "double"):
        classes, kind = classes.withColumn("embedding", F.col("embedding").cast("array<double>")), "double"
    raw = np.float32 if kind == "float" else np.float64
    shape = f"label long, dim int, tab int, tkey long, node long, size long, keys array<long>, code binary, factor double, vec array<{kind}>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 400):
                part = batch.slice(at, 400)
                dims = part.column("dim").to_numpy()
                for dim in np.unique(dims):
                    own = part.filter(pa.array(dims == dim))
                    flat = own.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(raw)
                    x = flat.reshape(-1, dim).astype(np.float64)
                    x = x / np.abs(x).max(1, keepdims=True)  # huge or tiny components square safely
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    code, factor = codes(unit)
                    keys = table_keys(unit, bits, tables)
                    n = len(x)
                    every = np.repeat(np.arange(n), tables)
                    nested = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * a.shape[1]), pa.array(a.ravel()))
                    blobs = pa.array([c.tobytes() for c in code], pa.binary())
                    columns = [
                        own.column("label").take(pa.array(every)), own.column("dim").take(pa.array(every)), pa.array(np.tile(np.arange(tables, dtype=np.int32), n)), pa.array(keys.ravel()),
                        own.column("node").take(pa.array(every)), own.column("size").take(pa.array(every)), nested(keys).take(pa.array(every)), blobs.take(pa.array(every)),
                        pa.array(factor[every]), nested(flat.reshape(-1, dim)).take(pa.array(every)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["label", "dim", "tab", "tkey", "node", "size", "keys", "code", "factor", "vec"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, order):
            many = np.flatnonzero(np.diff(at) > 1)
            out: list[list[np.ndarray]] = [[], [], []]
            for g in many:
                own = table.slice(at[g], at[g + 1] - at[g])
                dim, n = own.column("dim")[0].as_py(), own.num_rows
                plain = lambda c: own.column(c).combine_chunks()  # noqa: B023, E731
                x = plain("vec").flatten().to_numpy().reshape(n, dim).astype(np.float64)
                keys = plain("keys").flatten().to_numpy().reshape(n, -1)
                code = np.frombuffer(b"".join(plain("code").to_pylist()), np.uint8).reshape(n, -1)
                node = plain("node").to_numpy()
                x = x / np.abs(x).max(1, keepdims=True)
                count, root = cell_links(x, plain("size").to_numpy(), keys, own.column("tab")[0].as_py(), plain("block").to_numpy(), code, plain("factor").to_numpy(), threshold)
                some = (count > 0) | (root != np.arange(n))
                for put, values in zip(out, (node[some], node[root[some]], count[some]), strict=True):
                    put.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["a", "b", "n"])

    order = ["label", "dim", "tab", "tkey", "cell_i", "cell_j"]
    coded = store(classes.select("node", "label", "size", "dim", "embedding").mapInArrow(encode, shape), "embed-codes")
    met = cells(coded, order[:4], F.col("node"), BLOCK)
    found = store(met.repartition(*[F.col(c) for c in order]).sortWithinPartitions(*order).mapInArrow(compare, "a long, b long, n long"), "embed-links")
    roots = components(found.select("a", "b"), "embed")
    named = (
        classes.select("node", "k1", "k2", "size", "first_id")
        .join(found.groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n")), "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    answer = named.join(smallest, "root").select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    linked = good.select("vec_id", "k1", "k2").join(answer, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = v.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
