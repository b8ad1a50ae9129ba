"""Exact quantiles in two passes over the data, whatever its size.

1. One aggregate keeps a KLL sketch per group: mergeable, some thousand values, with a known rank error
   ``eps``. It gives the group's count and, for each wanted rank, two values between which that rank
   lies but for a chance of less than 1e-4.
2. One aggregate counts the rows below each such window (one partial row a task) and the rows of
   each value inside it, some ``6 * eps`` (0.4 %) of the values. The table of these counts is kept.

The wanted values then follow from that table alone: it is narrowed by histograms while a window has
many distinct values, and ranked by a running sum over the few that are left. The counts prove the
result: were a rank outside its window, that window would be widened and the second pass run
again. Only windows and counts per (group, probability) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Values a sketch keeps (KLL's k), and its normalized rank error at 99 % confidence.
SKETCH_K = 4096
SKETCH_EPS = 2.296 / SKETCH_K**0.9723
#: Half width of a window in ranks, in units of the error.
WIDTH = 3
#: Distinct values of a window that are ranked by one running sum; more are narrowed first.
RANKED_VALUES = 100_000
BINS = 1024
#: Rows up to which a group's window is its whole range (one rank more or less counts there).
SMALL_GROUP = int(10 / SKETCH_EPS)

_TID, _LO, _HI = "__tid", "__lo", "__hi"


@dataclass
class _Target:
    group: tuple
    p: float
    n: int
    lo: float
    hi: float

    @property
    def position(self) -> float:
        return self.p * (self.n - 1)

    @property
    def ranks(self) -> tuple[int, int]:
        """The two ranks (from 1) between which the quantile lies."""
        low = int(self.position // 1) + 1
        return low, low if self.position == low - 1 else low + 1


def _ranks(p: float, width: float) -> tuple[float, float]:
    return max(0.0, p - width), min(1.0, p + width)


def _sketches(df: DataFrame, value: str, groups: list[str]) -> DataFrame:
    s = F.kll_sketch_agg_double(F.col(value), F.lit(SKETCH_K)).alias("__s")
    return df.groupBy(*groups).agg(F.count(value).alias("__n"), s)


def _windows(sketches: DataFrame, groups: list[str], probs: list[float], width: float) -> list[_Target]:
    """Count and window per group and probability; the ends of the range are exact."""
    bounds = [r for p in probs for r in _ranks(p, width)] + [0.0, 1.0]
    row = sketches.where("__n > 0").select(*groups, "__n", F.kll_sketch_get_quantile_double("__s", F.array(*[F.lit(r) for r in bounds])).alias("__q"))
    out = []
    for r in row.collect():
        for i, p in enumerate(probs):
            at = 2 * i if r["__n"] > SMALL_GROUP else -2
            out.append(_Target(tuple(r[g] for g in groups), p, int(r["__n"]), r["__q"][at], r["__q"][at + 1]))
    return out


def _window_counts(df: DataFrame, value: str, groups: list[str], targets: dict[int, _Target]) -> DataFrame:
    """``(__tid, v, c)``: rows of each value inside a target's window; ``v`` null: rows below it."""
    fields = [T.StructField(f"__g{i}", df.schema[g].dataType) for i, g in enumerate(groups)]
    schema = T.StructType([T.StructField(_TID, T.IntegerType()), *fields, T.StructField(_LO, T.DoubleType()), T.StructField(_HI, T.DoubleType())])
    table = F.broadcast(df.sparkSession.createDataFrame([(i, *t.group, t.lo, t.hi) for i, t in targets.items()], schema))
    v = F.col(value)
    on = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)] + [v <= F.col(_HI)]
    inside = F.when(v >= F.col(_LO), v)
    return df.select(*groups, value).join(table, on).groupBy(_TID, inside.alias("v")).agg(F.count(F.lit(1)).alias("c"))


def _values_at(counts: DataFrame, wanted: list[tuple[int, int]], distinct: dict[int, int]) -> dict[tuple[int, int], float]:
    """Values at ranks (within its window) of targets, from the kept counts alone."""
    spark = counts.sparkSession
    inside = counts.where(F.col("v").isNotNull())
    state = {(tid, k): (None, None, 0, distinct[tid]) for tid, k in wanted}  # lo, hi, rows below, distinct values

    def narrowed(keys) -> DataFrame:
        rows = [(tid, k, *state[tid, k][:2], k - state[tid, k][2]) for tid, k in keys]
        table = spark.createDataFrame(rows, f"{_TID} int, k long, {_LO} double, {_HI} double, need long")
        within = (F.col(_LO).isNull() | (F.col("v") >= F.col(_LO))) & (F.col(_HI).isNull() | (F.col("v") <= F.col(_HI)))
        return inside.join(F.broadcast(table), _TID).where(within)

    while many := [key for key, s in state.items() if s[3] > RANKED_VALUES]:
        rows = narrowed(many)
        ends = rows.groupBy(_TID, "k").agg(F.min("v").alias("a"), F.max("v").alias("b"))
        share = (F.col("v") - F.col("a")) / (F.col("b") - F.col("a"))
        # infinite ends have a bin of their own
        bin_of = F.when(F.isnan(share), F.when(F.col("v") == F.col("a"), -1).otherwise(BINS)).otherwise(F.least(F.lit(BINS - 1), F.floor(share * BINS)))
        binned = rows.join(F.broadcast(ends), [_TID, "k"]).groupBy(_TID, "k", "need", bin_of.alias("b"))
        hist = binned.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("d"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        w = Window.partitionBy(_TID, "k").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for r in hist.withColumn("cum", F.sum("n").over(w)).where("cum - n < need AND need <= cum").collect():
            key = (r[_TID], r["k"])
            if r["d"] == state[key][3]:
                raise ArithmeticError(f"the values from {r['lo']} to {r['hi']} can't be narrowed")
            state[key] = (r["lo"], r["hi"], state[key][2] + int(r["cum"] - r["n"]), int(r["d"]))
    w = Window.partitionBy(_TID, "k").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = narrowed(list(state)).withColumn("cum", F.sum("c").over(w)).where("cum - c < need AND need <= cum")
    return {(r[_TID], r["k"]): float(r["v"]) for r in ranked.collect()}


def sketched_quantiles(df: DataFrame, value: str, probs: list[float], groups=()) -> tuple[dict[tuple, dict[float, float]], dict[tuple, int]]:
    """Linear-interpolated quantiles (numpy's default) per group, and counts per group.

    Null and NaN values are skipped, infinite ones take their place in the order; a group without values
    is absent. ``({group: {p: value}}, {group: n})``.
    """
    groups = list(groups)
    data = df.where(F.col(value).isNotNull() & ~F.isnan(value)).withColumn(value, F.col(value).cast("double"))
    open_targets = dict(enumerate(_windows(_sketches(data, value, groups), groups, probs, WIDTH * SKETCH_EPS)))
    out: dict[tuple, dict[float, float]] = {t.group: {} for t in open_targets.values()}
    counted = {t.group: t.n for t in open_targets.values()}
    while open_targets:
        counts = _window_counts(data, value, groups, open_targets).persist()
        try:
            per = counts.groupBy(_TID).agg(
                F.sum(F.when(F.col("v").isNull(), F.col("c")).otherwise(0)).alias("below"),
                F.sum(F.when(F.col("v").isNotNull(), F.col("c")).otherwise(0)).alias("inside"),
                F.count("v").alias("distinct"),
            )
            seen = {r[_TID]: r for r in per.collect()}
            held = {i: t for i, t in open_targets.items() if i in seen and seen[i]["below"] < t.ranks[0] and t.ranks[1] <= seen[i]["below"] + seen[i]["inside"]}
            wanted = sorted({(i, k - int(seen[i]["below"])) for i, t in held.items() for k in t.ranks})
            got = _values_at(counts, wanted, {i: int(seen[i]["distinct"]) for i in held}) if wanted else {}
        finally:
            counts.unpersist()
        for i, t in held.items():
            lo, hi = (got[i, k - int(seen[i]["below"])] for k in t.ranks)
            share = t.position - t.position // 1
            out[t.group][t.p] = lo if lo == hi or share == 0 else lo + (hi - lo) * share
        # a rank outside its window, by the sketch's bad luck: the whole range holds it
        open_targets = {i: _Target(t.group, t.p, t.n, float("-inf"), float("inf")) for i, t in open_targets.items() if i not in held}
    return out, counted
