"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: a text is lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and 3-word
shingles; bit b is set when more than half of the shingles' XXH64 (seed 42) have it.

Search: the 64 bits are cut into m parts, each holding bits that go together in a bounded sample.
Two fingerprints within tau bits agree within T_i bits on some part i whenever the T_i add up to
tau - m + 1 (T_i = -1: part i is not probed). Each fingerprint chooses its own T by dynamic
programming over estimated candidate counts, so that part values shared by many are left out in
favour of a wider search elsewhere. It then probes part values within T_i; everything that meets
at a part value is verified by the full Hamming distance.

Documents with equal fingerprints are one class (counted before any search). Within a part value
rows are compared in cells of bounded size, and only links to a local root are emitted, so a dense
group of n fingerprints gives about n links and not n * n.

Cases: null text or no words: fingerprint zero, linked like any other. Repeated rows stay rows of
the result. A null ``doc_id`` takes part, but never names a component (null when a component has
no other id). Empty table: no rows. Extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import NOT_SPACE, Words, cells, components, counted, early_hashes, local_roots, ready, slices, store, whole_groups

SHINGLE, BITS, SEED = 3, 3, 42
#: Distinct fingerprints that the bit parts and the candidate estimates are fitted on.
SAMPLE_ROWS = 20_000
#: Most frequent sampled values of a part that estimates look at.
FREQUENT = 512
#: Distinct fingerprints up to which three parts (about 24 probes each, 21 bits a part) cost less
#: than two (about 66 probes each, 32 bits a part) when values are spread evenly.
THREE_PARTS = 1 << 22
#: Rows of a block of a part value; larger groups are split into cells.
BLOCK = 2048

_U = np.uint64
# fixed values: the five primes of XXH64
P1, P2, P3, P4, P5 = (_U(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _rot(x: np.ndarray, r: int) -> np.ndarray:
    return (x << _U(r)) | (x >> _U(64 - r))


def xxh64_spans(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of byte ranges of ``data``: ranges under 32 bytes all at once, longer ones one by one."""
    out = np.empty(len(start), np.uint64)
    short = size < 32
    at, n = start[short], size[short]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lane8 = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), strides=(1,))
    with np.errstate(over="ignore"):
        h = _U(seed) + P5 + n.astype(np.uint64)
        for k in range(3):
            on = np.flatnonzero(n >= 8 * (k + 1))
            if not len(on):
                break
            lane = lane8[at[on] + 8 * k]
            h[on] = _rot(h[on] ^ (_rot(lane * P2, 31) * P1), 27) * P1 + P4
        done = n // 8 * 8
        on = np.flatnonzero(n - done >= 4)
        lane = lane8[at[on] + done[on]] & _U(0xFFFFFFFF)
        h[on] = _rot(h[on] ^ (lane * P1), 23) * P2 + P3
        done[on] += 4
        for k in range(3):
            on = np.flatnonzero(n - done > k)
            if not len(on):
                break
            byte = padded[at[on] + done[on] + k].astype(np.uint64)
            h[on] = _rot(h[on] ^ (byte * P5), 11) * P1
        h ^= h >> _U(33)
        h *= P2
        h ^= h >> _U(29)
        h *= P3
        h ^= h >> _U(32)
    out[short] = h
    whole = data.tobytes()
    for i in np.flatnonzero(~short):
        out[i] = xxhash.xxh64_intdigest(whole[start[i] : start[i] + size[i]], seed)
    return out


def fingerprints_of(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """One uint64 fingerprint per text."""
    w = Words(texts, NOT_SPACE)
    out = np.zeros(len(texts), np.uint64)
    n = w.count
    some = np.flatnonzero(n)
    if not len(some):
        return out
    # words joined by one space: a byte moves to its rank among word bytes plus the words before it
    size = w.end - w.start
    to = np.cumsum(size + 1) - size - 1
    joined = np.full(int(size.sum() + len(size)), 32, np.uint8)
    joined[np.flatnonzero(w.inside) - np.repeat(w.start - to, size)] = w.low[w.inside]
    many = np.maximum(1, n - shingle + 1)[some]
    bounds = np.concatenate([[0], np.cumsum(many)])
    first = np.repeat(w.first[:-1][some] - bounds[:-1], many) + np.arange(bounds[-1])
    last = np.minimum(first + shingle - 1, np.repeat(w.first[1:][some] - 1, many))
    h = xxh64_spans(joined, to[first], to[last] + size[last] - to[first])
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    for i, row in enumerate(some):  # sums of 0/1 bytes, document by document
        total = bits[bounds[i] : bounds[i + 1]].sum(0, dtype=np.int64)
        out[row] = np.packbits(total * 2 > many[i], bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp long)``, one row per document row."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fp = fingerprints_of(part.column(1), shingle)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


# ------------------------------------------------------------------------------------- the plan


def bit_parts(sample: np.ndarray, m: int) -> list[list[int]]:
    """m groups of bits, greedily filled with the bits most correlated with those already in."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
    with np.errstate(all="ignore"):
        c = np.nan_to_num(np.abs(np.corrcoef(bits.T))) if len(sample) > 2 else np.zeros((64, 64))
    free, parts = list(range(64)), []
    for i in range(m):
        size = (64 - sum(map(len, parts))) // (m - i)
        seed = max(free, key=lambda b: (c[b, free].sum(), -b))
        part = [seed]
        free.remove(seed)
        while len(part) < size:
            best = max(free, key=lambda b: (c[b, part].sum(), -b))
            part.append(best)
            free.remove(best)
        parts.append(sorted(part))
    return parts


def part_values(fp: np.ndarray, part: list[int]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for k, b in enumerate(part):
        out |= ((fp >> _U(b)) & _U(1)) << _U(k)
    return out


def flips(width: int, radius: int) -> list[np.ndarray]:
    """For t = 1..radius the masks with exactly t bits."""
    return [np.array([sum(1 << b for b in pick) for pick in combinations(range(width), t)], np.uint64) for t in range(1, radius + 1)]


class Plan:
    """Bit parts and candidate estimates, fitted on a bounded sample of distinct fingerprints."""

    def __init__(self, sample: np.ndarray, total: int, tau: int = BITS):
        self.tau, self.total = tau, max(total, 1)
        self.m = min(3 if self.total <= THREE_PARTS else 2, tau + 1)
        self.parts = bit_parts(sample, self.m)
        self.frequent = []
        for part in self.parts:
            value, count = np.unique(part_values(sample, part), return_counts=True)
            top = np.lexsort((value, -count))[:FREQUENT]
            top = top[count[top] > 1]
            share = count[top] / max(len(sample), 1)
            self.frequent.append((value[top], share, 1.0 - share.sum()))
        budget = tau - self.m + 1
        self.choices = np.array([t for t in product(range(-1, tau + 1), repeat=self.m) if sum(t) == budget])

    def expected(self, i: int, value: np.ndarray) -> np.ndarray:
        """Cost of radius t = -1..tau on part i for each value: probes and estimated candidates."""
        width = len(self.parts[i])
        hot, share, rest = self.frequent[i]
        out = np.zeros((len(value), self.tau + 2))
        near = np.zeros((len(value), self.tau + 1))
        for at in range(0, len(value), 8192):
            d = np.bitwise_count(value[at : at + 8192, None] ^ hot[None, :])
            for t in range(self.tau + 1):
                near[at : at + 8192, t] = (d <= t) @ share
        for t in range(self.tau + 1):
            ball = sum(comb(width, j) for j in range(min(t, width) + 1))
            out[:, t + 1] = ball + self.total * (near[:, t] + rest * min(1.0, ball / 2.0**width))
        return out

    def allocate(self, fp: np.ndarray) -> np.ndarray:
        """Thresholds of each fingerprint: dynamic programming over parts and budget left.

        best[b] holds the least cost of the parts so far with thresholds that add up to b.
        """
        values = [part_values(fp, p) for p in self.parts]
        low, high = -self.m, self.tau * self.m
        width = high - low + 1
        best = np.full((len(fp), width), np.inf)
        best[:, -low] = 0
        trail = []
        for i in range(self.m):
            cost = self.expected(i, values[i])
            new, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int8)
            for t in range(-1, self.tau + 1):
                moved = np.full_like(best, np.inf)
                src = best[:, max(0, -t) : width - max(0, t)]
                moved[:, max(0, t) : width - max(0, -t)] = src + cost[:, t + 1 : t + 2]
                better = moved < new
                new[better], pick[better] = moved[better], t
            best = new
            trail.append(pick)
        at = np.full(len(fp), self.tau - self.m + 1 - low)
        out = np.zeros((len(fp), self.m), np.int64)
        for i in reversed(range(self.m)):
            out[:, i] = trail[i][np.arange(len(fp)), at]
            at = at - out[:, i]
        return out

    def probes(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows (part, value, index into fp): every fingerprint under its own value of each part,
        and under the values within its threshold."""
        t = self.allocate(fp)
        part, value, index = [], [], []
        for i, bits in enumerate(self.parts):
            own = part_values(fp, bits)
            part.append(np.full(len(fp), i, np.int32))
            value.append(own)
            index.append(np.arange(len(fp)))
            for radius, masks in enumerate(flips(len(bits), int(t[:, i].max(initial=0))), 1):
                who = np.flatnonzero(t[:, i] >= radius)
                value.append((own[who][:, None] ^ masks[None, :]).ravel())
                index.append(np.repeat(who, len(masks)))
                part.append(np.full(len(who) * len(masks), i, np.int32))
        return np.concatenate(part), np.concatenate(value), np.concatenate(index)


def group_links(fp: np.ndarray, at: np.ndarray, tau: int, small: int = 33) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within tau bits inside each group ``at[g]:at[g+1]``.

    Small groups: all linked pairs by comparing rows at distance 1, 2, ... in the table; larger
    ones: one link per row to the root of its local component.
    """
    size = np.diff(at)
    gid = np.repeat(np.arange(len(size)), size)
    few = (size <= small)[gid]
    a, b = [], []
    live = np.flatnonzero(few & (size > 1)[gid])
    for lag in range(1, small):
        live = live[live + lag < len(fp)]
        live = live[gid[live] == gid[live + lag]]
        if not len(live):
            break
        hit = live[np.bitwise_count(fp[live] ^ fp[live + lag]) <= tau]
        a.append(fp[hit])
        b.append(fp[hit + lag])
    for g in np.flatnonzero(size > small):
        own = np.unique(fp[at[g] : at[g + 1]])
        root = local_roots(len(own), lambda i, rest, own=own: np.bitwise_count(own[rest] ^ own[i]) <= tau)
        a.append(own)
        b.append(own[root])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (a, b))
    keep = a != b
    return a[keep], b[keep]


def fingerprint_links(distinct: DataFrame, tau: int = BITS) -> DataFrame:
    """Links ``(a, b)`` between fingerprints within ``tau`` bits that connect exactly the
    components of the whole link graph. ``distinct``: one row ``fp`` per fingerprint."""
    spark = distinct.sparkSession
    ready(spark)
    total = distinct.count()
    by = F.xxhash64("fp", F.lit(3))
    first = early_hashes(distinct, by, SAMPLE_ROWS, total).orderBy(by, "fp").limit(SAMPLE_ROWS)
    sample = np.array([r[0] for r in first.collect()], np.int64).view(np.uint64)
    plan = spark.sparkContext.broadcast(Plan(sample, total, tau))  # 64 bit numbers and m * FREQUENT estimates

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                fp = batch.column(0).slice(at, 2000).to_numpy().view(np.uint64)
                part, value, index = plan.value.probes(fp)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(value.view(np.int64)), pa.array(fp[index].view(np.int64))], ["part", "value", "fp"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, at in whole_groups(batches, ["part", "value", "cell_i", "cell_j"]):
            a, b = group_links(table.column("fp").to_numpy().view(np.uint64), at, tau)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    keys = ["part", "value"]
    probes = store(distinct.select("fp").mapInArrow(probe, "part int, value long, fp long"), "simhash-probes")
    met = cells(probes, keys, F.col("fp"), BLOCK).select(*keys, "cell_i", "cell_j", "fp")
    order = [*keys, "cell_i", "cell_j"]
    return met.repartition(*[F.col(c) for c in order]).sortWithinPartitions(*order).mapInArrow(verify, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, tau: int = BITS) -> DataFrame:
    """Per document row: ``doc_id, fp long, component_id`` (smallest doc_id reachable)."""
    prints = store(fingerprints(docs, shingle), "simhash-prints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    links = fingerprint_links(classes.select("fp"), tau)
    roots = components(links, "simhash")
    named = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    by_print = named.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp: str = "fp"):
    """16 lowercase hexadecimal digits of a signed long."""
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def unique_documents(docs: DataFrame, shingle: int = SHINGLE, tau: int = BITS) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its component (one document of each group), plus
    rows without a doc_id, which nothing can name; columns as given."""
    gone = near_duplicates(docs, shingle, tau).where("doc_id != component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(counted(store(gone, "simhash-gone")), F.col("doc_id") == F.col("gone_id"), "left_anti")
