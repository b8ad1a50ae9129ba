"""Exact top-k values without shuffling every distinct value.

A frequent-items summary of bounded size is merged over all tasks. A value that it does not name has at
most ``2 * 3.5 / size`` of all rows: a summary of ``size`` slots is wrong by at most ``3.5 / size`` of the
rows it has seen, and it names every value whose count is certain to exceed that error. The named
values, at most ``TRACKED``, are counted again exactly; only their partial counts are shuffled. Where
the k-th of them has more rows than any unnamed value can have, the k first are the exact top k, ties
by value included. Where the bound does not decide (flat distributions), all values are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000


def summary_slots(tracked: int) -> int:
    """Slots of a summary that tracks so many items: a power of two, three quarters in use."""
    slots = 8
    while slots * 3 < tracked * 4:
        slots *= 2
    return slots


def unnamed_share(tracked: int) -> float:
    """Greatest share of the rows that a value which the summary does not name can have."""
    return 2 * 3.5 / summary_slots(tracked)


def counts_by_value(df: DataFrame, name: str) -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("count"))


def ordered(counts: DataFrame, name: str, k: int) -> DataFrame:
    return counts.orderBy(F.col("count").desc(), F.col(name).asc()).limit(k)


def proven_top(df: DataFrame, name: str, k: int, tracked: int = TRACKED) -> DataFrame | None:
    """Exact top ``k`` of the text column ``name`` (no nulls) by way of the summary, or None where its
    bound does not prove them. Values the summary names reach the driver, at most ``tracked``."""
    named = F.expr(f"approx_top_k(`{name}`, {tracked}, {tracked})")
    row = df.agg(F.count(F.lit(1)).alias("n"), named.alias("named")).collect()[0]
    values = [(r["item"],) for r in row["named"] or []]
    if not values:
        return None
    table = F.broadcast(df.sparkSession.createDataFrame(values, df.select(name).schema))
    top = ordered(counts_by_value(df.join(table, name, "left_semi"), name), name, k).collect()
    bound = unnamed_share(tracked) * row["n"]
    if len(top) == k and top[-1]["count"] > bound:
        return df.sparkSession.createDataFrame(top, f"`{name}` string, count long")
    return None


def top_values(df: DataFrame, name: str, k: int, summary_first: bool = False, tracked: int = TRACKED) -> DataFrame:
    """Top ``k`` values of the text column ``name`` by count, ties by value: ``(name, count)``."""
    found = proven_top(df, name, k, tracked) if summary_first else None
    return ordered(counts_by_value(df, name), name, k) if found is None else found
