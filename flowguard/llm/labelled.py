"""Labelled rows for the classifiers: the held-out rule and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.common import early_hashes

#: Labelled documents per class that a classifier is fitted on (the first in a hashed order), and
#: bytes of text of a sample whose texts come to the driver.
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 24 << 20


def remainder(doc_id: str | Column = "doc_id", of: int = 5) -> Column:
    """crc32(doc_id as text) mod ``of``; null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % of


def held_out(doc_id: str | Column = "doc_id", of: int = 5) -> Column:
    """Remainder 0; false for a null id."""
    return F.coalesce(remainder(doc_id, of) == 0, F.lit(False))


def sample_ids(labels: DataFrame, column: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, y``: up to ``rows`` labelled ids of each class that aren't held out, in hashed
    order. Several labels of an id count as its largest; null ids and labels are left out."""
    one = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("y"))
    h = F.xxhash64("doc_id", F.lit(5))
    totals = {r.y: r.n for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows
    # a class's candidates are cut by hash where they stand; only some 2 * rows of them are sorted
    first = [early_hashes(one.where(F.col("y") == y), h, rows, totals.get(y, 0)).orderBy(h, "doc_id").limit(rows) for y in (0, 1)]
    return first[0].unionByName(first[1]).select("doc_id", "y")


def sample_texts(docs: DataFrame, labels: DataFrame, column: str, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> list[tuple[str, int]]:
    """(text, label) pairs: whole texts, as many as fit the byte bound in hashed order. An id is taken
    with all its rows or not at all."""
    ids = sample_ids(labels, column, rows)
    near = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # 2 * rows ids at most
    sizes = near.groupBy("doc_id").agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))).cast("long")).alias("n"))
    sizes = sizes.withColumn("h", F.xxhash64("doc_id", F.lit(6)))
    total, chosen = 0, []
    for r in sorted(sizes.collect(), key=lambda r: (r.h, r.doc_id)):
        if total + r.n <= most_bytes:
            total += r.n
            chosen.append(r.doc_id)
    got = near.where(F.col("doc_id").isin(chosen)) if chosen else near.where("false")
    return sorted(((r.text or "", r.y) for r in got.select("text", "y").collect()), key=lambda p: (p[0], p[1]))
