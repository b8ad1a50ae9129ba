"""Periodic runs: stretches of words that repeat with a period, and texts with the repeats removed.

A *run* is a stretch of consecutive words with smallest period q (words q apart are equal) and length
``>= max(12, 2 * q)`` that no neighbouring word extends keeping the period.

Method. A document's words are numbers; the grid of period p is the pairs (i, i + p) with i = 0, p,
2p, ...: every run of period p holds one of its pairs, and all grids of a text of n words have some
n ln n pairs. A pair that agrees is extended both ways by longest common extensions (LCE). First a few
words are compared, which settles nearly all. The others ask an index of the document: its suffixes
at the places of a difference cover modulo 13 are sorted (by 13 words, then by doubling inside the
sample), neighbours' common prefixes are kept in a sparse table, and an extension follows words to the
next pair of synchronised sample places, then one range minimum. The same index over the reversed
words extends to the left. A run found again by a multiple of its period has the same ends, so the
least period of equal ends is its smallest period.

Documents are independent rows, so there is no shuffle; a task works on slices of about 1 MB of
text. A longer text is a slice of its own (some 300 bytes of memory a word).

Words are ``[^\\x20\\x09-\\x0D]+``, compared as bytes. A null or empty text has no words, no runs and an
empty collapsed text. Repeated rows, null and repeated ids are kept, each row by itself; further
columns are left out. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import ready, slices

#: Least words of a run, and least number of its periods.
LEAST_WORDS, LEAST_PERIODS = 12, 2

#: A perfect difference set: any two residues modulo 13 have one shift that brings both into it.
COVER_MOD, COVER = 13, (0, 1, 3, 9)
#: Grid pairs that numpy looks at in one go.
GRID_PAIRS = 1 << 20

_CLASS = np.full(COVER_MOD, -1)
_CLASS[list(COVER)] = range(len(COVER))
_SHIFT = np.array([[next(d for d in range(COVER_MOD) if (a + d) % COVER_MOD in COVER and (b + d) % COVER_MOD in COVER) for b in range(COVER_MOD)] for a in range(COVER_MOD)])


def common_words(t: np.ndarray, i: np.ndarray, j: np.ndarray, most: np.ndarray, step: int = 1) -> np.ndarray:
    """Equal words from ``i`` and ``j`` on (to the left with step -1), up to ``most``."""
    out = np.zeros(len(i), np.int64)
    left = np.flatnonzero(most > 0)
    while len(left):
        at = out[left] * step
        left = left[t[i[left] + at] == t[j[left] + at]]
        out[left] += 1
        left = left[out[left] < most[left]]
    return out


class Extensions:
    """Longest common extensions to the right, for words ``t`` of documents ``doc``.

    Documents end with words that occur once, so an extension of two places stays in its document.
    """

    def __init__(self, t: np.ndarray, doc: np.ndarray):
        self.t = t
        n = len(t)
        v, size = COVER_MOD, len(COVER)
        grid = np.arange(0, n, v)[:, None] + np.array(COVER)
        pos = grid.ravel()
        pos = pos[pos < n]
        m = len(pos)
        padded = np.concatenate([t, np.zeros(v, t.dtype)])
        rank, tied = np.zeros(m, np.int64), np.arange(m)
        rank, tied = self._refine(rank, tied, doc[pos])
        for d in range(v):
            rank, tied = self._refine(rank, tied, padded[pos + d])
        levels = []
        while len(tied):  # places v * 2^k words on are in the sample too
            levels.append(rank)
            on = np.arange(m) + (size << (len(levels) - 1))
            rank, tied = self._refine(rank, tied, np.where(on < m, rank[np.minimum(on, m - 1)], -1))
        self.rank = rank
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        self.table = self._minima(self._neighbours(padded, pos, order, levels))

    @staticmethod
    def _refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order the still tied places by one key more; ranks are the first place of their group."""
        if not len(tied):
            return rank, tied
        o = tied[np.lexsort((key[tied], rank[tied]))]
        r, k, at = rank[o], key[o], np.arange(len(o))
        new = np.ones(len(o), bool)
        new[1:] = r[1:] != r[:-1]
        group = np.maximum.accumulate(np.where(new, at, 0))
        new[1:] |= k[1:] != k[:-1]
        part = np.maximum.accumulate(np.where(new, at, 0))
        out = rank.copy()
        out[o] = r + part - group
        alone = new & np.append(new[1:], True)
        return out, o[~alone]

    @staticmethod
    def _neighbours(t: np.ndarray, pos: np.ndarray, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of neighbours in the order, from the ranks of each doubling, longest first."""
        a, b = order[:-1].copy(), order[1:].copy()
        h = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][a] == levels[k][b]
            h += same * (COVER_MOD << k)
            a += same * (len(COVER) << k)
            b += same * (len(COVER) << k)
        return h + common_words(t, pos[a], pos[b], np.full(len(a), COVER_MOD))

    @staticmethod
    def _minima(lcp: np.ndarray) -> np.ndarray:
        rows = max(1, len(lcp).bit_length())
        table = np.zeros((rows, max(1, len(lcp))), np.int32)
        table[0, : len(lcp)] = lcp
        for j in range(1, rows):
            half = 1 << (j - 1)
            table[j] = table[j - 1]
            table[j, :-half] = np.minimum(table[j - 1, :-half], table[j - 1, half:])
        return table

    def words(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from ``i`` and ``j`` (other places of one document) on."""
        shift = _SHIFT[i % COVER_MOD, j % COVER_MOD]
        out = common_words(self.t, i, j, shift)
        go = np.flatnonzero(out == shift)
        a, b = i[go] + shift[go], j[go] + shift[go]
        a = self.rank[a // COVER_MOD * len(COVER) + _CLASS[a % COVER_MOD]]
        b = self.rank[b // COVER_MOD * len(COVER) + _CLASS[b % COVER_MOD]]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        j2 = np.frexp((hi - lo).astype(float))[1] - 1
        out[go] += np.minimum(self.table[j2, lo], self.table[j2, hi - (1 << j2)])
        return out


def laid_out(words: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of documents in one array, a number that occurs once before, between and after
    them; the document of each place and the first place of each document."""
    sizes = np.array([len(w) for w in words], np.int64)
    first = np.cumsum(sizes + 1) - sizes
    t = np.empty(int(sizes.sum()) + len(words) + 1, np.int64)
    doc = np.repeat(np.arange(len(words) + 1), np.append(sizes + 1, 1))
    ends = np.append(first - 1, len(t) - 1)
    inside = np.ones(len(t), bool)
    inside[ends] = False
    t[ends] = least + np.arange(len(ends))
    if sizes.sum():
        t[inside] = np.concatenate(words)
    return t, doc, first


class _Pairs:
    """Extensions both ways of agreeing pairs; the index covers those documents that need it."""

    def __init__(self, words: list[np.ndarray], most: int):
        self.words, self.most = words, most
        self.t, self.doc, self.first = laid_out(words, most)

    def ends(self, i: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, period) of the stretches around agreeing pairs (i, i + p) that are long
        enough to be runs."""
        need = np.maximum((LEAST_PERIODS - 1) * p, LEAST_WORDS - p)
        few = np.full(len(i), COVER_MOD)
        right, left = common_words(self.t, i, i + p, few), common_words(self.t, i - 1, i - 1 + p, few, -1)
        far = (right == COVER_MOD) | (left == COVER_MOD)
        keep = far | (right + left >= need)
        i, p, need, right, left, far = i[keep], p[keep], need[keep], right[keep], left[keep], far[keep]
        if far.any():
            right[far], left[far] = self._indexed(i[far], p[far])
        keep = right + left >= need
        return (i - left)[keep], (i + p + right)[keep], p[keep]

    def _indexed(self, i: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = self.doc[i] - (self.t[i] >= self.most)
        chosen, which = np.unique(d, return_inverse=True)
        t, doc, first = laid_out([self.words[x] for x in chosen], self.most)
        i = i - self.first[d] + first[which]
        right = Extensions(t, doc).words(i, i + p)
        n = len(t) - 1
        back = Extensions(t[::-1].copy(), doc[::-1].copy())
        return right, back.words(n - (i - 1), n - (i - 1 + p))


def runs_of(words: list[np.ndarray]) -> list[np.ndarray]:
    """Runs of each document's word numbers: rows (start, length, period) by start, then period."""
    most = max((int(w.max()) + 1 for w in words if len(w)), default=0)
    pairs = _Pairs(words, most)
    t, first = pairs.t, pairs.first
    sizes = np.array([len(w) for w in words], np.int64)
    top = np.where(sizes >= LEAST_WORDS, sizes // LEAST_PERIODS, 0)
    doc = np.repeat(np.arange(len(words)), top)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(top) - top, top) + 1
    count = (sizes[doc] - 1) // np.maximum(period, 1)
    total = np.cumsum(count)
    found = [np.zeros((0, 4), np.int64)]
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    at = held = 0
    while at < len(doc):
        to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + GRID_PAIRS, "right")))
        c = count[at:to]
        p = np.repeat(period[at:to], c)
        k = np.arange(len(p)) - np.repeat(np.cumsum(c) - c, c)
        i = np.repeat(first[doc[at:to]], c) + k * p
        same = np.flatnonzero(t[i] == t[i + p])
        waiting.append((i[same], p[same]))
        held += len(same)
        at = to
        if held >= GRID_PAIRS or at == len(doc):
            start, end, p = pairs.ends(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            d = np.searchsorted(first, start, "right") - 1
            found.append(_least_periods(np.stack([d, start - first[d], end - start, p], 1)))
            waiting, held = [], 0
    rows = _least_periods(np.concatenate(found))
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cut = np.searchsorted(rows[:, 0], np.arange(len(words) + 1))
    return [rows[a:b, 1:] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _least_periods(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    return rows[new]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


RESULT = "doc_id {id}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _slice_rows(part: pa.RecordBatch) -> pa.RecordBatch:
    texts = [(x or "").encode().split() for x in part.column(1).to_pylist()]
    flat = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode()
    number = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(flat) else np.zeros(0, np.int64)
    sizes = np.array([len(x) for x in texts], np.int64)
    cut = np.append(0, np.cumsum(sizes))
    runs = runs_of([number[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)])
    collapsed = []
    for words, found in zip(texts, runs, strict=True):
        if len(found):
            words = [words[x] for x in np.flatnonzero(kept_words(len(words), found))]
        collapsed.append(b" ".join(words).decode())
    all_runs = np.concatenate([np.zeros((0, 3), np.int64), *runs])
    lists = pa.ListArray.from_arrays(
        pa.array(np.append(0, np.cumsum([len(x) for x in runs])), pa.int32()),
        pa.StructArray.from_arrays([pa.array(all_runs[:, c]) for c in range(3)], fields=list(_RUN.value_type)),
    )
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(sizes), lists, pa.array(collapsed, pa.string())],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs and collapsed text of every row of ``docs (doc_id, text)``.

    ``runs``: (start word, length, smallest period) by start, then period; ``collapsed``: the words
    that no run holds after its first period, joined by one space.
    """
    ready(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield _slice_rows(part)

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(each, RESULT.format(id=narrow.schema["doc_id"].dataType.simpleString()))
