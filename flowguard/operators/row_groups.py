"""Groups of equal rows without shuffling whole rows.

A group-by over all columns moves every wide row once. Here rows are first told apart by a 128-bit hash:

1. ``(hash, hash)`` pairs are counted; only these 16 bytes a row are shuffled, after map-side
   partial counts.
2. The hashes that occur more than once set bits of a table of 64-bit words, at most ``MAX_WORDS`` of
   them whatever the input's size, so it can be broadcast. A row whose bit is clear is the only one of
   its kind and goes straight on.
3. Rows whose bit is set (copies, and some rows that share a bit by chance) are grouped by all
   their columns, so rows with equal hashes but other values stay apart.

The result is that of ``groupBy(all columns)``: null equals null, NaN equals NaN, ``-0.0`` equals ``0.0``.
Where so many hashes repeat that most bits would be set, whole rows are grouped at once, which
moves no more then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words of the broadcast bit table: 2^20 of 8 bytes (and their numbers) at most.
MAX_WORDS = 1 << 20
#: Bits per repeated hash that the table has, while ``MAX_WORDS`` allows it.
BITS_PER_HASH = 64
#: Plan size (Catalyst's estimate) above which :func:`group_rows` hashes first by default: below
#: it, a shuffle of whole rows costs less than the passes for the hashes.
HASH_FIRST_BYTES = 128 << 20

COUNT = "__n"


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; equal for rows that group-by holds equal."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            c = c + F.lit(0.0).cast(f.dataType)  # one zero
        parts.append(c)
        if f.nullable:  # a null leaves the running hash as it is: say where nulls stand
            parts.append(c.isNull())
    return F.xxhash64(*parts), F.xxhash64(F.lit(0x5EED), *reversed(parts))


def can_hash(df: DataFrame) -> bool:
    """Floating numbers inside arrays and structs aren't made one zero; maps have no hash."""

    def plain(t: T.DataType) -> bool:
        return not isinstance(t, (T.ArrayType, T.StructType, T.MapType, T.VariantType))

    return bool(df.columns) and all(plain(f.dataType) for f in df.schema.fields)


def plan_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def group_rows(df: DataFrame, hash_first: bool | None = None, hashes=row_hashes) -> DataFrame:
    """``df``'s columns and ``__n``: one row per set of equal rows, with its number of rows.

    ``hash_first``: count hashes before whole rows move; by default for inputs above
    ``HASH_FIRST_BYTES``. ``hashes`` gives the two hash columns (tests put in weak ones).
    """
    columns = [F.col(f"`{c}`") for c in df.columns]

    def whole(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(COUNT))

    if hash_first is None:
        hash_first = can_hash(df) and plan_bytes(df) > HASH_FIRST_BYTES
    if not hash_first:
        return whole(df)
    h1, h2 = hashes(df)
    repeated = df.select(h1.alias("h1"), h2.alias("h2")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = repeated.persist()
    try:
        n = repeated.count()
        if n == 0:
            return df.withColumn(COUNT, F.lit(1).cast("long"))
        words = 1
        while words < MAX_WORDS and words * 64 < n * BITS_PER_HASH:
            words *= 2
        if n > words * 32:
            return whole(df)
        bits = repeated.select(word_number(F.col("h1"), words).alias("__word"), bit_of(F.col("h1")).alias("bit"))
        # at most MAX_WORDS rows of two numbers, whatever the input
        table = df.sparkSession.createDataFrame(bits.groupBy("__word").agg(F.bit_or("bit").alias("__bits")).toArrow())
    finally:
        repeated.unpersist()
    marked = df.withColumn("__word", word_number(h1, words)).join(F.broadcast(table), "__word", "left")
    again = F.coalesce(F.col("__bits").bitwiseAND(bit_of(h1)) != 0, F.lit(False))
    alone = marked.where(~again).select(*columns, F.lit(1).cast("long").alias(COUNT))
    return alone.unionByName(whole(marked.where(again).select(*columns)))


def word_number(h: Column, words: int) -> Column:
    return F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(words - 1)).cast("int")


def bit_of(h: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
