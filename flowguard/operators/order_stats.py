"""Exact order statistics without sorting a whole group in one task.

The k-th smallest value of a group is found by histogram refinement: each level is one
aggregate pass that counts the rows of the current value window in ``bins`` equal-width
buckets (partial aggregation map-side, output bounded by targets x bins rows). The bucket
that holds rank k becomes the next window. Once a window holds few rows
(``final_rows``) they are ranked by a window function whose partitions are bounded by that
number. A window whose low and high ends are equal needs no last pass: the value is known,
however many rows share it (a value held by a third of all rows costs nothing extra).

Used for the exact stratified split (W4, W5), where the value is an md5 prefix and the ties are
broken by the full md5 text. Quantiles (A5, A19, M13) have a way of their own:
:mod:`flowguard.operators.quantile_sketch`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TID = "__tid"
_LO = "__lo"
_HI = "__hi"
_RANK = "__rank"
_BUCKET = "__bucket"


@dataclass
class _Target:
    tid: int
    group: tuple
    k: int
    lo: object
    hi: object
    below: int
    n_in: int
    done_value: object = None
    resolved: bool = False
    extra: dict = field(default_factory=dict)


def _group_key(row, group_cols):
    return tuple(row[g] for g in group_cols)


def group_counts(df: DataFrame, value_col: str, group_cols=()) -> dict:
    """Count, min and max of non-null values per group; one aggregate pass.

    Returned to the driver: one row per group (group counts are bounded by the caller, e.g.
    strata or feature names, never by the data).
    """
    v = F.col(value_col)
    agg = df.where(v.isNotNull()).groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")
    )
    return {_group_key(r, group_cols): (r["n"], r["lo"], r["hi"]) for r in agg.collect()}


def kth_smallest(
    df: DataFrame,
    value_col: str,
    targets: list[tuple[tuple, int]],
    group_cols=(),
    tie_cols=(),
    stats: dict | None = None,
    bins: int = 2048,
    final_rows: int = 50_000,
    start: dict | None = None,
) -> tuple[DataFrame, dict[int, tuple[tuple, int]]]:
    """Rows of rank ``k`` (1-based) in ``(value, tie_cols)`` order within each group.

    ``targets`` lists ``(group_key, k)``. Returns a DataFrame ``(__tid, value, *tie_cols)`` and
    a map ``tid -> (group_key, k)``. Targets with k outside 1..n are left out. ``start`` may
    give, per ``(group_key, k)``, an already narrowed window ``(lo, hi, below, n_in)``.
    """
    spark = df.sparkSession
    group_cols = list(group_cols)
    tie_cols = list(tie_cols)
    value_type = df.schema[value_col].dataType
    v = F.col(value_col)
    data = df.where(v.isNotNull())
    if stats is None:
        stats = group_counts(data, value_col, group_cols)

    state: list[_Target] = []
    for gk, k in targets:
        if gk not in stats:
            continue
        n, lo, hi = stats[gk]
        if 1 <= k <= n:
            if start and (gk, k) in start:
                lo, hi, below, n_in = start[(gk, k)]
                state.append(_Target(len(state), gk, int(k), lo, hi, below, n_in))
            else:
                state.append(_Target(len(state), gk, int(k), lo, hi, 0, n))
    tid_map = {t.tid: (t.group, t.k) for t in state}

    group_fields = [df.schema[g] for g in group_cols]
    window_schema = T.StructType(
        [T.StructField(_TID, T.IntegerType(), False)]
        + [T.StructField(f.name, f.dataType, True) for f in group_fields]
        + [T.StructField(_LO, value_type, True), T.StructField(_HI, value_type, True),
           T.StructField("__need", T.LongType(), False)]
    )

    def windows_df(items: list[_Target]) -> DataFrame:
        rows = [(t.tid, *t.group, t.lo, t.hi, t.k - t.below) for t in items]
        return spark.createDataFrame(rows, window_schema)

    def in_window(items: list[_Target]) -> DataFrame:
        w = windows_df(items)
        # The window table has one row per target: bounded by the caller's target list.
        if group_cols:
            joined = data.join(F.broadcast(w), group_cols)
        else:
            joined = data.withColumn("__one", F.lit(1)).join(F.broadcast(w.withColumn("__one", F.lit(1))), "__one")
        return joined.where((v >= F.col(_LO)) & (v <= F.col(_HI)))

    while True:  # every level narrows each window, down to one value at last
        frame_targets = [
            t for t in state
            if not t.resolved and t.n_in > final_rows and t.lo != t.hi
        ]
        for t in state:
            if not t.resolved and t.lo == t.hi and not tie_cols:
                t.resolved, t.done_value = True, t.lo
        if not frame_targets:
            break
        rows = in_window(frame_targets)
        lo_d, hi_d = F.col(_LO).cast("double"), F.col(_HI).cast("double")
        bucket = F.least(
            F.lit(bins - 1),
            F.floor((v.cast("double") - lo_d) / (hi_d - lo_d) * F.lit(float(bins))).cast("int"),
        )
        hist = rows.groupBy(_TID, "__need", bucket.alias(_BUCKET)).agg(
            F.count(F.lit(1)).alias("c"), F.min(v).alias("bmin"), F.max(v).alias("bmax")
        )
        w = Window.partitionBy(_TID).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        chosen = (
            hist.withColumn("cum", F.sum("c").over(w))
            .where((F.col("cum") - F.col("c") < F.col("__need")) & (F.col("cum") >= F.col("__need")))
            .select(_TID, (F.col("cum") - F.col("c")).alias("skip"), "c", "bmin", "bmax")
            .collect()
        )
        by_tid = {r[_TID]: r for r in chosen}
        for t in frame_targets:
            r = by_tid[t.tid]
            if (t.lo, t.hi) == (r["bmin"], r["bmax"]) and t.n_in == int(r["c"]):
                raise ArithmeticError(f"the window {t.lo}..{t.hi} of {value_col} can't be narrowed")
            t.below += int(r["skip"])
            t.n_in = int(r["c"])
            t.lo, t.hi = r["bmin"], r["bmax"]

    for t in state:
        if not t.resolved and t.lo == t.hi and not tie_cols:
            t.resolved, t.done_value = True, t.lo

    parts = []
    frame_targets = [t for t in state if not t.resolved]
    if frame_targets:
        rows = in_window(frame_targets)
        order = [v] + [F.col(c) for c in tie_cols]
        w = Window.partitionBy(_TID).orderBy(*order)
        parts.append(
            rows.withColumn(_RANK, F.row_number().over(w))
            .where(F.col(_RANK) == F.col("__need"))
            .select(F.col(_TID), v.alias("value"), *[F.col(c) for c in tie_cols])
        )
    resolved = [t for t in state if t.resolved]
    if resolved:
        schema = T.StructType([T.StructField(_TID, T.IntegerType(), False), T.StructField("value", value_type, True)])
        lit_df = spark.createDataFrame([(t.tid, t.done_value) for t in resolved], schema)
        for c in tie_cols:
            lit_df = lit_df.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
        parts.append(lit_df)
    if not parts:
        schema = T.StructType(
            [T.StructField(_TID, T.IntegerType(), False), T.StructField("value", value_type, True)]
            + [T.StructField(c, df.schema[c].dataType, True) for c in tie_cols]
        )
        return spark.createDataFrame([], schema), tid_map
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, tid_map


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    probs: list[float],
    group_cols=(),
    groups: list[tuple] | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles (numpy's default) of ``value_col`` per group.

    Null and NaN values are skipped; infinite values take their place in the order. Returns
    ``(*group_cols, q, value)``; a group with no values is
    absent. ``groups`` restricts the groups (default: every group present). Two passes over the
    data: :mod:`flowguard.operators.quantile_sketch`.
    """
    from flowguard.operators.quantile_sketch import sketched_quantiles

    group_cols = list(group_cols)
    found, _n = sketched_quantiles(df, value_col, probs, group_cols)
    rows = [(*g, float(p), found[g][p]) for g in (groups if groups is not None else found) if g in found for p in probs]
    schema = T.StructType(
        [T.StructField(g, df.schema[g].dataType, True) for g in group_cols]
        + [T.StructField("q", T.DoubleType(), False), T.StructField("value", T.DoubleType(), True)]
    )
    return df.sparkSession.createDataFrame(rows, schema)


def log_bucket(v: Column, sub: int = 16) -> Column:
    """Order-preserving bucket of a DOUBLE without knowing its range.

    Binade (floor of log2 |v|) times ``sub`` plus the position inside the binade; negative
    values mirror below zero, zero is bucket 0. Monotone non-decreasing in ``v``.
    """
    a = F.abs(v)
    e = F.floor(F.log2(a))
    m = a / F.pow(F.lit(2.0), e)
    b = (e + F.lit(1100)) * F.lit(sub) + F.floor((m - F.lit(1.0)) * F.lit(sub))
    return (F.when(v == 0, F.lit(0)).when(v > 0, b + 1).otherwise(-(b + 1))).cast("long")


def value_bucket(v: Column, sub: int = 16) -> Column:
    """:func:`log_bucket` for any DOUBLE: +-inf and NaN have the outermost buckets of their own."""
    edge = F.lit(1 << 40)
    return (
        F.when(F.isnan(v), edge + 1).when(v == F.lit(float("inf")), edge).when(v == F.lit(float("-inf")), -edge).otherwise(log_bucket(v, sub))
    )


def prefix_histogram(df: DataFrame, value_col: str, group_cols, shift: int) -> dict:
    """One aggregate pass: per group, count/min/max of ``value >> shift`` buckets.

    For values with a known non-negative range (md5 prefixes) this is both the group count
    pass and the first refinement level. Output is bounded by groups x 2^(bits - shift).
    """
    b = F.shiftright(F.col(value_col), shift).alias("__b")
    rows = df.groupBy(*group_cols, b).agg(
        F.count(F.lit(1)).alias("c"), F.min(value_col).alias("lo"), F.max(value_col).alias("hi")
    ).collect()
    out: dict = {}
    for r in rows:
        out.setdefault(_group_key(r, group_cols), []).append((r["__b"], r["c"], r["lo"], r["hi"]))
    for v in out.values():
        v.sort()
    return out


def start_from_histogram(hist: dict, targets: list[tuple[tuple, int]]) -> tuple[dict, dict]:
    """Group stats and narrowed start windows for ``kth_smallest`` from a prefix histogram."""
    stats, start = {}, {}
    for gk, buckets in hist.items():
        stats[gk] = (sum(c for _b, c, _l, _h in buckets), buckets[0][2], buckets[-1][3])
    for gk, k in targets:
        below = 0
        for _b, c, lo, hi in hist.get(gk, []):
            if below + c >= k:
                start[(gk, k)] = (lo, hi, below, c)
                break
            below += c
    return stats, start


def rank_cut(df: DataFrame, order_col: str, quotas: dict[tuple, int], group_cols=(), **kwargs) -> dict[tuple, tuple]:
    """Per group, the value at rank ``quota`` in the order of ``order_col``, with the rows below it
    and the rows that share it: ``{group: (value, below, equal)}``.

    Refinement ends at one value however many rows share it, so a hot value costs nothing extra.
    Only these numbers reach the driver, one row per group.
    """
    targets = [(gk, q) for gk, q in quotas.items() if q > 0]
    vals, tid_map = kth_smallest(df, order_col, targets, group_cols, **kwargs)
    cuts = {tid_map[r[_TID]][0]: r["value"] for r in vals.collect()}
    if not cuts:
        return {}
    table = cut_table(df, cuts, group_cols, "__at")
    v, at = F.col(order_col), F.col("__at")
    got = df.select(*group_cols, order_col).join(F.broadcast(table), list(group_cols))
    got = got.groupBy(*group_cols).agg(F.count_if(v < at).alias("below"), F.count_if(v == at).alias("equal"))
    return {_group_key(r, group_cols): (cuts[_group_key(r, group_cols)], r["below"], r["equal"]) for r in got.collect()}


def cut_table(df: DataFrame, cuts: dict[tuple, object], group_cols, name: str = "__cut") -> DataFrame:
    """``(*group_cols, name)``: one row per group, for a broadcast join."""
    schema = T.StructType([T.StructField(g, df.schema[g].dataType, True) for g in group_cols] + [T.StructField(name, T.LongType(), True)])
    return df.sparkSession.createDataFrame([(*gk, v) for gk, v in cuts.items()], schema)
