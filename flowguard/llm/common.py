"""Helpers that several operators of this subpackage share: tables in the shared folder, text in
Arrow batches as numpy arrays of words and hashes, complete groups out of a sorted partition, and
connected components."""

from __future__ import annotations

import ctypes
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.session import ensure_checkpoint_dir, ship_package

#: Bytes of text that numpy works on at once in a task; arrays of words and hashes are some 60 times
#: that.
SLICE_BYTES = 1 << 20
#: Rows of an Arrow batch: texts are long, and a batch is held by the JVM and by the worker.
BATCH_ROWS = 1000

#: Whitespace of the word rule ``[^\x20\x09-\x0D]+``.
SPACES = np.array([9, 10, 11, 12, 13, 32])


# ---------------------------------------------------------------- tables in the shared folder


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared checkpoint folder and read it again.

    Later jobs read the files, so a lost executor costs no recomputation of what came before.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/flowguard-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._flowguard_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Remove a stored table that nothing reads any more."""
    path = getattr(df, "_flowguard_path", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def early_hashes(df: DataFrame, h: Column, rows: int, total: int) -> DataFrame:
    """Of ``total`` rows, those among which the first ``rows`` in the order of the 64-bit hash ``h``
    lie (some 2 * rows), so that a sample's candidates don't come to the driver from every task."""
    if total <= 4 * rows:
        return df
    return df.where(h < F.lit(-(1 << 63) + (1 << 64) * 2 * rows // total))


#: Rows of a narrow stored table up to which a join broadcasts it; a larger one is shuffled.
BROADCAST_ROWS = 200_000


def counted(stored: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A stored narrow table, marked for broadcast when its counted rows are few."""
    return F.broadcast(stored) if stored.count() <= most else stored


def ready(spark: SparkSession) -> None:
    """Before any step with Python functions: the package is shipped to the executors' workers, and
    the session's Arrow batches get at most BATCH_ROWS rows."""
    ship_package(spark)
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(rows)) > BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))


# ------------------------------------------------------------------------- words as numpy arrays




NOT_SPACE = np.ones(256, bool)
NOT_SPACE[SPACES] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` on UTF-8 bytes: digits, a-z and every byte above ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_buffer(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n+1 offsets of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = arr.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8) if len(arr) else np.zeros(1, np.int64)
    raw = arr.buffers()[2] if len(arr) else None
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return data, off - off[0]


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what a finished batch has left in the allocators: a worker lives on through later
    stages, and would hold the memory of its largest batch beside theirs."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


_OPTION = getattr(ctypes.CDLL(None), "mallopt", None)


def keep_memory(most: int = 32 << 20) -> None:
    """For steps over many arrays of some 100 KB: the allocator keeps up to ``most`` bytes that are
    free, so that these arrays aren't asked of the system, page by page, at every step."""
    if _OPTION is not None:
        _OPTION(-3, most)  # M_MMAP_THRESHOLD
        _OPTION(-1, most)  # M_TRIM_THRESHOLD


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of a batch with about ``most`` bytes of text each, so that memory
    follows the slice and not the batch. A longer text is a slice of its own."""
    if not batch.num_rows:
        return
    arr = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string())
    off = np.frombuffer(arr.buffers()[1], np.int64, len(arr) + 1, arr.offset * 8)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    give_back()


class Words:
    """Words of a slice of texts.

    ``low``: lower-cased bytes; ``start``/``end``: byte range of each word; ``doc``: row of each
    word; ``first``: n+1 offsets of each row's words.
    """

    def __init__(self, arr: pa.Array, word: np.ndarray):
        data, off = text_buffer(arr)
        self.low = LOWER[data]
        inside = word[self.low]
        n = len(inside)
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        edge = off[:-1][off[:-1] < n]
        before[edge] = False
        edge = off[1:][off[1:] > 0] - 1
        after[edge] = False
        self.inside = inside
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.count)
        self.off = off

    def hashes(self) -> np.ndarray:
        return span_hashes(self.low, self.start, self.end)


_RNG = np.random.RandomState(20240611)
_BYTE = _RNG.randint(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15 | 3)
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16) * 5 // 4
        for name, p in (("up", _P), ("down", _P_INV)):
            run = np.full(size, p, np.uint64)
            run[0] = 1
            _powers[name] = np.cumprod(run, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser (xor-shift and multiply) that spreads every bit of a 64-bit value."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def rolling(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which the hash of any range follows by one subtraction."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return total, down


def span_hashes(low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ascending byte ranges (a polynomial over random byte values, then mixed)."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):  # about a slice of bytes at a time
        to = max(at + 1, int(np.searchsorted(start, start[at] + SLICE_BYTES)))
        low_end = end[at:to].max()
        total, down = rolling(_BYTE[low[start[at] : low_end]])
        s, e = start[at:to] - start[at], end[at:to] - start[at]
        out[at:to] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def range_hashes(values: np.ndarray, start: np.ndarray, length: int) -> np.ndarray:
    """Hashes of ``length`` consecutive 64-bit values from each ``start``."""
    total, down = rolling(values)
    return mix((total[start + length] - total[start]) * down[start])


# --------------------------------------------------------------- groups out of sorted partitions


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold complete groups of a partition sorted by ``keys``, with n+1 group offsets.

    Only the last, perhaps unfinished group is carried over, so memory is a batch and a group.
    Keys are non-null integers.
    """

    def bounds(t: pa.Table) -> np.ndarray:
        change = np.zeros(t.num_rows, bool)
        change[0] = True
        for k in keys:
            v = t.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        return np.flatnonzero(change)

    held: list[pa.Table] = []
    rows = 0
    last: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        if held and all(t.column(k)[t.num_rows - 1].as_py() == v for k, v in zip(keys, last, strict=True)):
            held.append(t)  # the carried group goes on through this whole batch
            rows += t.num_rows
            continue
        t = pa.concat_tables([*held, t]).combine_chunks()
        at = bounds(t)
        if len(at) > 1:
            yield t.slice(0, at[-1]), at
        held = [t.slice(at[-1])]
        rows = held[0].num_rows
        last = [held[0].column(k)[0].as_py() for k in keys]
    if rows:
        t = pa.concat_tables(held).combine_chunks()
        at = bounds(t)
        yield t, np.append(at, t.num_rows)


def cells(rows: DataFrame, keys: list[str], ident: Column, bound: int) -> DataFrame:
    """Split large groups into cells for all-against-all work within a group.

    A group of n rows is cut into k = ceil(n / bound) blocks by a hash of ``ident``; the cell
    (i, j) holds blocks i and j, so any two rows of the group meet in some cell and a cell has
    about 2 * bound rows, whatever n is. Adds ``cell_i``, ``cell_j`` and ``block``.
    """
    large = rows.groupBy(*keys).agg(F.count("*").alias("cell_n")).where(F.col("cell_n") > bound)
    k = F.ceil(F.coalesce(F.col("cell_n"), F.lit(1)) / F.lit(bound)).cast("int")
    return (
        rows.join(large, keys, "left")
        .withColumn("block", F.pmod(F.xxhash64(ident, F.lit(7)), k).cast("int"))
        .withColumn("cell_other", F.explode(F.sequence(F.lit(0), k - 1)))
        .withColumn("cell_i", F.least("block", "cell_other"))
        .withColumn("cell_j", F.greatest("block", "cell_other"))
        .drop("cell_n", "cell_other")
    )


def local_roots(n: int, near) -> np.ndarray:
    """Components among rows 0..n-1; ``near(i, rest)`` tells which of ``rest`` row i links with."""
    root = np.full(n, -1)
    rest = np.arange(n)
    while len(rest):
        head, rest = rest[0], rest[1:]
        root[head] = head
        todo = [head]
        while todo and len(rest):
            hit = near(todo.pop(), rest)
            found = rest[hit]
            root[found] = head
            todo.extend(found.tolist())
            rest = rest[~hit]
    return root


# ------------------------------------------------------------------------- connected components


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of undirected links ``(a, b)`` of longs: ``(node, root)``, root being
    the smallest node. Nodes without a link don't occur.

    Each round points every node at its smallest neighbour (one partial aggregate) and renames the
    links' ends to these; a link (u, v) with v = parent(u) becomes (v, parent(v)), so no
    connection is lost. Nodes that are nobody's smallest neighbour go away each round. Every
    round's tables are stored, so lineage stays short; only row counts reach the driver.
    """
    e = store(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), f"{name}-links")
    names = None
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up")), f"{name}-up")
        if names is None:
            new = parent.select("node", F.col("up").alias("root"))
        else:
            new = names.join(parent.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        new = store(new, f"{name}-names")
        up_a = parent.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        up_b = parent.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        renamed = e.join(up_a, "a").join(up_b, "b").select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).where("a < b").distinct()
        later = store(renamed, f"{name}-links")
        for t in (e, parent, names):
            discard(t)
        e, names = later, new
    discard(e)
    if names is None:
        return e.select(F.col("a").alias("node"), F.col("b").alias("root")).where("false")
    return names


def blocks_needed(total: float, each: float) -> int:
    return max(1, math.ceil(total / each))
