"""Benchmark decontamination by a distributed positional inverted index.

Index: documents stay where they are; each block of consecutive documents (``BLOCK_BYTES`` of text)
becomes one row that holds its own inverted index: the sorted 64-bit hashes of its terms, and for
each term the sorted token positions inside the block (documents follow each other with a gap, so
that no phrase spans two of them). The rows are written to the shared folder. No posting is
shuffled, whatever the frequency of a term, and a lost executor repeats only its own blocks.

Search: the benchmark's windows (``WINDOW`` consecutive words of an item, or the whole item when it
is shorter) form a query set, sent to the index in blocks of at most ``QUERY_WINDOWS``. In each
index row a window starts from the postings of its rarest term there; the lists of the other terms,
adjusted by their offset, are intersected from rare to frequent. ``slop`` > 0 gives proximity
matches: each term within that many places of its place in the phrase.

Words: A-Z lower-cased, then ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Equality of words is that of
64-bit hashes.

Cases: null or wordless texts have no words and match nothing; items without words have no window.
Repeated rows and ids stay rows (items with one id count as one item). Null item_ids are ignored in
the list of items, but their windows still hit. Empty tables give empty or unmarked results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import ALNUM, Words, counted, ready, slices, store

WINDOW = 10
BLOCK_BYTES = 2 << 20
#: Windows of one query block (10 hashes of 8 bytes each and an item id: 20 MB at most).
QUERY_WINDOWS = 200_000

INDEX = "doc_ids array<long>, first array<long>, terms binary, starts binary, positions binary"


def build_index(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per block of documents: ids, word offsets, and the block's inverted index.

    ``first``: n+1 word offsets of the documents; ``terms``: sorted uint64; ``starts``: uint32
    offsets into ``positions`` (uint32, ascending within a term; word number + gap * document).
    """
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                yield index_block(part)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), "text").mapInArrow(run, INDEX)


def index_block(part: pa.RecordBatch) -> pa.RecordBatch:
    w = Words(part.column(1), ALNUM)
    h = w.hashes()
    order = np.argsort(h, kind="stable")
    place = (np.arange(len(h)) + w.doc * GAP).astype(np.uint32)
    ordered = h[order]
    new = np.ones(len(h), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.append(np.flatnonzero(new), len(h)).astype(np.uint32)
    one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x if isinstance(x, pa.Array) else pa.array(x, kind))
    blob = lambda x: pa.array([x.tobytes()], pa.binary())
    ids = part.column(0).cast(pa.int64())
    return pa.RecordBatch.from_arrays(
        [one(ids, None), one(w.first.astype(np.int64), pa.int64()), blob(ordered[new]), blob(starts), blob(place[order])],
        ["doc_ids", "first", "terms", "starts", "positions"],
    )


#: Free places between two documents of a block; slop must stay below.
GAP = 64


class Windows:
    """A block of query windows: term hashes (windows x WINDOW, 0 past ``size``), size, item id."""

    def __init__(self, texts: list, ids: list, window: int = WINDOW):
        self.terms = np.zeros((0, window), np.uint64)
        self.size, self.item = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.array([-1 if i is None else i for i in ids], np.int64)
        self.named = np.array([i is not None for i in ids], bool)
        if not texts:
            return
        w = Words(pa.array(texts, pa.large_string()), ALNUM)
        h = np.append(w.hashes(), np.zeros(window, np.uint64))
        many = np.where(w.count >= window, w.count - window + 1, (w.count > 0).astype(np.int64))
        self.item = np.repeat(np.arange(len(texts)), many)
        begin = np.repeat(w.first[:-1], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        self.size = np.minimum(w.count[self.item], window)
        at = begin[:, None] + np.arange(window)[None, :]
        self.terms = np.where(np.arange(window)[None, :] < self.size[:, None], h[at], np.uint64(0))


def expand(low: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges low..low+many flattened: (which range, value)."""
    which = np.repeat(np.arange(len(low)), many)
    return which, np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + low[which]


def search_block(terms: np.ndarray, starts: np.ndarray, positions: np.ndarray, q: Windows, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches in one index row: (window, first place, last place), all occurrences."""
    none = np.zeros(0, np.int64)
    if not len(terms) or not len(q.size):
        return none, none, none
    used = np.arange(q.terms.shape[1])[None, :] < q.size[:, None]
    at = np.minimum(np.searchsorted(terms, q.terms), len(terms) - 1)
    known = (terms[at] == q.terms) | ~used
    live = np.flatnonzero(known.all(1))
    if not len(live):
        return none, none, none
    at, used, size = at[live], used[live], q.size[live]
    freq = np.where(used, starts[at + 1].astype(np.int64) - starts[at], np.iinfo(np.int64).max)
    order = np.argsort(freq, axis=1, kind="stable")  # rarest first
    rows = np.arange(len(live))
    rarest = order[:, 0]
    win, slot = expand(starts[at[rows, rarest]].astype(np.int64), freq[rows, rarest])
    place = positions[slot].astype(np.int64)
    base = place - rarest[win]  # where the phrase would begin
    low, high = place.copy(), place.copy()
    # postings of all terms as one ascending array: (term number, place)
    number = np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(starts.astype(np.int64)))
    posting = (number << 32) | positions.astype(np.int64)
    for step in range(1, q.terms.shape[1]):
        here = size[win] > step
        j = order[win, step]
        want = (at[win, j] << 32) | np.maximum(base + j - slop, 0)
        found = np.minimum(np.searchsorted(posting, want), len(posting) - 1)
        got = posting[found]
        near = (got >= want) & (got <= ((at[win, j] << 32) | np.maximum(base + j + slop, 0))) & (base + j + slop >= 0)
        keep = ~here | near
        p = got & 0xFFFFFFFF
        low, high = np.where(here & near, np.minimum(low, p), low), np.where(here & near, np.maximum(high, p), high)
        win, base, low, high = win[keep], base[keep], low[keep], high[keep]
        if not len(win):
            break
    return live[win], low, high


FOUND = "block_key long, doc_row int, doc_id long, item_id long, first_word long, last_word long"


def query_blocks(items: DataFrame, id_column: str = "item_id", window: int = WINDOW) -> Iterator[Windows]:
    """The benchmark's windows in blocks; only one block at a time is on the driver."""
    texts, ids, words = [], [], 0
    for r in items.select(F.col(id_column).cast("long"), "text").toLocalIterator():
        if r[1]:
            texts.append(r[1])
            ids.append(r[0])
            words += len(r[1]) // 2 + 1
        if words >= QUERY_WINDOWS:
            yield Windows(texts, ids, window)
            texts, ids, words = [], [], 0
    if texts:
        yield Windows(texts, ids, window)


def phrase_matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0, id_column: str = "item_id") -> DataFrame:
    """All matches ``(block_key, doc_row, doc_id, item_id, first_word, last_word)``; word numbers
    count from 0 in the document. ``index`` must have ``block_key``. Exact phrases with slop 0."""
    if not 0 <= slop < GAP // 2:
        raise ValueError(f"slop must be from 0 to {GAP // 2 - 1}")
    spark = index.sparkSession
    ready(spark)
    out = None
    for block in query_blocks(items, id_column, window):
        q = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], q=q) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in range(batch.num_rows):
                    yield matches_in_row(batch.slice(r, 1), q.value, slop)

        found = index.mapInArrow(run, FOUND)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], FOUND)


def matches_in_row(row: pa.RecordBatch, q: Windows, slop: int) -> pa.RecordBatch:
    array = lambda c, kind: np.frombuffer(row.column(c)[0].as_buffer(), kind)
    first = row.column("first")[0].values.to_numpy()
    doc_ids = row.column("doc_ids")[0].values
    win, low, high = search_block(array("terms", np.uint64), array("starts", np.uint32), array("positions", np.uint32), q, slop)
    begin = first[:-1] + np.arange(len(first) - 1) * GAP  # place of each document's first word
    doc = np.searchsorted(begin, low, "right") - 1
    # documents without words share a place with the next: the last of them holds the word
    item = q.item[win]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(win), row.column("block_key")[0].as_py(), np.int64)), pa.array(doc.astype(np.int32)), doc_ids.take(pa.array(doc)),
            pa.array(q.ids[item], mask=~q.named[item]) if len(item) else pa.array([], pa.int64()), pa.array(low - begin[doc]), pa.array(high - begin[doc]),
        ],
        ["block_key", "doc_row", "doc_id", "item_id", "first_word", "last_word"],
    )


def stored_index(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """The index as a table in the shared folder, with a ``block_key`` per row."""
    return store(build_index(docs, id_column).withColumn("block_key", F.monotonically_increasing_id()), "posting-index")


def marked_documents(index: DataFrame, matches: DataFrame) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit`` (words inside any match), ``items`` (sorted as
    strings), from an index and its matches."""
    rows = index.select(
        "block_key",
        F.posexplode(F.transform(F.col("doc_ids"), lambda d, i: F.struct(d.alias("doc_id"), (F.get("first", i + 1) - F.get("first", i)).alias("n_words")))).alias("doc_row", "d"),
    ).select("block_key", "doc_row", "d.doc_id", "d.n_words")
    by_doc = ["block_key", "doc_row"]
    # covered words: spans by their start, each adding what lies beyond the furthest end so far
    spans = matches.groupBy(*by_doc, "first_word").agg(F.max("last_word").alias("last_word"))
    spans = spans.groupBy(*by_doc).agg(F.array_sort(F.collect_list(F.struct("first_word", "last_word"))).alias("spans"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("end"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0).cast("long"), s["last_word"] - F.greatest(acc["end"], s["first_word"] - 1))).alias("n"), F.greatest(acc["end"], s["last_word"]).alias("end")
    )
    hits = spans.select(*by_doc, F.aggregate("spans", start, step)["n"].alias("n_hit"))
    items = matches.groupBy(*by_doc).agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    marked = hits.join(items, by_doc)
    return rows.join(marked, by_doc, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """``doc_id, n_words, n_hit, items`` per row of ``docs``."""
    index = stored_index(docs)
    return marked_documents(index, store(phrase_matches(index, items, window, slop), "phrase-matches"))


def clean_documents(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """The rows of ``docs`` without any match; columns as given."""
    row = F.xxhash64("doc_id", "text")  # equal for equal rows alone
    index = stored_index(docs.select(row.alias("row_key"), "text"), "row_key")
    bad = store(phrase_matches(index, items, window, slop).select(F.col("doc_id").alias("bad_key")).distinct(), "contaminated")
    return docs.join(counted(bad), row == F.col("bad_key"), "left_anti")
