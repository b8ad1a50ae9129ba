"""Cleaning operators: dedup (A3, A4), numeric coercion (P5-P7), medians and fill (A5, P14),
moments and standard scaling (A6, P16), schema alignment (P15).

Per-column statistics come back to the driver as one small dict per call (one entry per
feature column, never per row) and are put into the plan as literals, so the scaling
itself is a narrow projection inside whole-stage code generation.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.columns import to_number
from flowguard.operators.exact_sums import exact_sums
from flowguard.operators.quantile_sketch import sketched_quantiles
from flowguard.operators.row_groups import COUNT, HASH_FIRST_BYTES, can_hash, group_rows, plan_bytes


def drop_duplicate_rows(df: DataFrame, hash_first: bool | None = None) -> DataFrame:
    """A3: keep one row of each set of equal rows (all columns; nulls and NaN equal).

    Planned as a hash aggregate on all columns with map-side partial aggregation, so a row
    repeated a third of all times collapses inside each map task before the shuffle. A large input
    is told apart by row hashes first, and only rows whose hash repeats move whole
    (:mod:`flowguard.operators.row_groups`).
    """
    if hash_first is None and not large_and_plain(df):
        return df.dropDuplicates()
    return group_rows(df, hash_first).drop(COUNT)


def large_and_plain(df: DataFrame) -> bool:
    return can_hash(df) and plan_bytes(df) > HASH_FIRST_BYTES


def canonical_numbers(df: DataFrame, exclude=()) -> DataFrame:
    """Q21: text columns whose every value is number text get one spelling per number.

    A CSV read as text keeps ``1`` and ``1.0`` apart, while a parsed numeric column makes them
    equal (for dedup and for port keys). One aggregate finds the text columns that are wholly
    numeric; their values take one spelling per number (:func:`number_spelling`, which keeps the
    digits of 64-bit integers). Typed columns and ``exclude`` (label, identity columns, row key)
    are left alone.
    """
    from pyspark.sql.types import StringType

    from flowguard.functions.columns import NUMBER_PATTERN, number_spelling

    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]
    if not cols:
        return df
    row = df.agg(*[
        F.count_if(F.col(f"`{c}`").isNotNull() & ~F.col(f"`{c}`").rlike(NUMBER_PATTERN)).alias(f"b{i}")
        for i, c in enumerate(cols)
    ]).collect()[0]
    numeric = [c for i, c in enumerate(cols) if row[f"b{i}"] == 0]
    if not numeric:
        return df
    return df.withColumns({c: number_spelling(F.col(f"`{c}`")) for c in numeric})


def duplicate_row_count(df: DataFrame, hash_first: bool | None = None) -> DataFrame:
    """A4: rows beyond the first of each set of equal rows (one-row DataFrame)."""
    grouped = group_rows(df, hash_first)
    return grouped.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def numeric_frame(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """P5 + P6: each feature column to DOUBLE with bad text, NaN and +-inf as null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[F.col(f"`{k}`") for k in keep],
        *[to_number(F.col(f"`{c}`"), types[c]).alias(c) for c in columns],
    )


def non_null_counts(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """Non-null cells per column in one aggregate pass."""
    if not columns:
        return {}
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]).collect()[0]
    return {c: int(row[f"c{i}"]) for i, c in enumerate(columns)}


def usable_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns with at least one non-missing value (order kept)."""
    counts = non_null_counts(df, columns)
    return [c for c in columns if counts[c] > 0]


def long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value) rows for the given columns (narrow unpivot)."""
    cols = [F.col(f"`{c}`").cast("double").alias(c) for c in columns]
    return df.select(*cols).unpivot([], [F.col(f"`{c}`") for c in columns], "feature", "value")


def column_medians(df: DataFrame, columns: list[str], method: str = "exact", accuracy: int = 100_000, with_counts: bool = False):
    """A5: median of each column, missing values skipped; an all-missing column gives 0.

    ``exact`` unpivots to (feature, value) and takes two passes over the rows: a sketch per feature,
    then the counts of the few values about its middle
    (:mod:`flowguard.operators.quantile_sketch`). ``approx`` is one pass of ``percentile_approx`` with
    the given accuracy. With ``with_counts`` the non-null count per column (P7) is returned too.
    """
    if not columns:
        return ({}, {}) if with_counts else {}
    if method == "approx":
        aggs = []
        for i, c in enumerate(columns):
            aggs += [F.percentile_approx(F.col(f"`{c}`"), 0.5, accuracy).alias(f"m{i}"), F.count(F.col(f"`{c}`")).alias(f"n{i}")]
        row = df.agg(*aggs).collect()[0]
        med = {c: (float(row[f"m{i}"]) if row[f"m{i}"] is not None else 0.0) for i, c in enumerate(columns)}
        counts = {c: int(row[f"n{i}"]) for i, c in enumerate(columns)}
        return (med, counts) if with_counts else med
    found, n = sketched_quantiles(long_values(df, columns), "value", [0.5], ["feature"])
    med = {c: found[(c,)][0.5] if (c,) in found else 0.0 for c in columns}
    counts = {c: n.get((c,), 0) for c in columns}
    return (med, counts) if with_counts else med


def fill_missing(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    """Missing cells take the column median, then 0."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(float(m)), F.lit(0.0)) for c, m in medians.items()})


# Fixed value: float64 machine epsilon, used by the near-constant column rule.
FLOAT64_EPS = 2.220446049250313e-16


def is_constant_feature(var: float, mean: float, n: int) -> bool:
    """Q11: a column whose variance is within float rounding of zero is constant."""
    return var <= n * FLOAT64_EPS * var + (n * mean * FLOAT64_EPS) ** 2


def column_moments(df: DataFrame, columns: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Mean and population standard deviation (ddof 0) of each column's finite values.

    Both come from exact sums and are rounded once (:mod:`flowguard.operators.exact_sums`), so they
    are the same bits however the rows are partitioned. A near-constant column reports std 0, so that
    scaling divides it by 1.
    """
    means, stds = {}, {}
    for c, sums in exact_sums(df, columns).items():
        means[c], var = sums.mean, sums.variance
        stds[c] = 0.0 if is_constant_feature(var, means[c], sums.n) else math.sqrt(var)
    return means, stds


def standardize(df: DataFrame, means: dict[str, float], stds: dict[str, float]) -> DataFrame:
    """(x - mean) / std; a constant column is divided by 1 (Q11)."""
    out = {}
    for c, m in means.items():
        s = stds.get(c, 0.0)
        scale = s if s > 0 else 1.0
        out[c] = (F.col(f"`{c}`") - F.lit(m)) / F.lit(scale)
    return df.withColumns(out)


def align_columns(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Select the train feature list; a column absent here becomes missing."""
    present = set(df.columns)
    return df.select(
        *[F.col(f"`{k}`") for k in keep],
        *[(F.col(f"`{c}`") if c in present else F.lit(None).cast("double")).alias(c) for c in columns],
    )
