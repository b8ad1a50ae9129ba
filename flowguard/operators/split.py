"""Exact, seeded, stratified train/test split (W4, W5), plus per-file heads and samples.

Rows are ordered inside each stratum by ``md5(key | seed)``. The test share is
``ceil(share * n)`` rows; the train share is given to strata by floor plus largest remainder
(ties to the lower stratum value), and each stratum's test quota is the rest of it. The
first ``quota`` rows of a stratum in md5 order are test rows. The cut value is found with
:func:`rank_cut` (histogram refinement), so no task ever sorts a whole stratum. Rows that share
the cut's key are cut again by an md5 of the whole row (refined in the same way), and rows equal
in everything by their number, so sizes are exact whatever repeats.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.functions.columns import md5_order_key, md5_prefix_long
from flowguard.operators.order_stats import cut_table, prefix_histogram, rank_cut, start_from_histogram

_OKH = "__order_h"
_TIE = "__order_tie"
_NTH = "__order_nth"


def allocate_test_quota(counts: dict, test_share: float) -> dict:
    """Per-stratum test rows: train is shared by floor + largest remainder, test is the rest."""
    n = sum(counts.values())
    if n == 0:
        return {}
    n_test = int(math.ceil(test_share * n))
    n_train = n - n_test
    keys = sorted(counts, key=lambda k: tuple("" if x is None else x for x in k))
    cont = {k: counts[k] * n_train / n for k in keys}
    floored = {k: int(math.floor(cont[k])) for k in keys}
    need = n_train - sum(floored.values())
    order = sorted(keys, key=lambda k: -(cont[k] - floored[k]))  # stable: ties keep stratum order
    for k in order[:need]:
        floored[k] += 1
    return {k: counts[k] - floored[k] for k in keys}


def stratified_split(
    df: DataFrame,
    key_col: str,
    strata_col: str = "y",
    test_share: float = 0.25,
    seed: int = 42,
    split_col: str = "split",
    test_value: str = "test",
    train_value: str = "train",
    tie_cols: list[str] | None = None,
) -> DataFrame:
    """Label each row ``train`` / ``test``.

    ``df`` should be cached by the caller: it is read by the count pass, the refinement
    passes and the final labelling. ``tie_cols`` (default: all columns) order the rows of a
    repeated key; they are hashed only where the cut falls on such a key.
    """
    d = df.withColumn(_OKH, md5_prefix_long(md5_order_key(F.coalesce(F.col(f"`{key_col}`").cast("string"), F.lit("")), seed)))
    # One pass gives the stratum sizes and the first refinement level: the md5 prefix is a
    # uniform 60-bit number, so its top 12 bits make 4096 even buckets.
    hist = prefix_histogram(d, _OKH, [strata_col], 48)
    counts = {gk: sum(c for _b, c, _l, _h in v) for gk, v in hist.items()}
    quotas = allocate_test_quota(counts, test_share)
    stats, start = start_from_histogram(hist, [(gk, q) for gk, q in quotas.items() if q > 0])
    cuts = rank_cut(d, _OKH, quotas, [strata_col], stats=stats, start=start)
    d = _with_cut(d, {gk: c[0] for gk, c in cuts.items()}, strata_col, "__cut")
    is_test = F.col(_OKH) <= F.col("__cut")
    # strata whose cut falls inside the rows of one key
    left = {gk: quotas[gk] - below for gk, (_v, below, equal) in cuts.items() if quotas[gk] - below < equal}
    if left:
        cols = tie_cols if tie_cols is not None else df.columns
        tie = md5_prefix_long(F.md5(F.concat_ws("|", F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols])), F.lit(str(seed)))))
        at_cut = F.col(_OKH) == F.col("__cut")
        d = d.withColumn(_TIE, F.when(at_cut, tie))
        ties = rank_cut(d.where(at_cut), _TIE, left, [strata_col])
        d = _with_cut(d, {gk: c[0] for gk, c in ties.items()}, strata_col, "__tie_cut")
        tied = at_cut & F.col("__tie_cut").isNotNull()
        last = {gk: left[gk] - below for gk, (_v, below, equal) in ties.items() if left[gk] - below < equal}
        if last:  # rows equal in every column: any of them, by number
            d = _with_cut(d, last, strata_col, "__last")
            equal = tied & (F.col(_TIE) == F.col("__tie_cut")) & F.col("__last").isNotNull()
            d = d.withColumn("__equal", F.coalesce(equal, F.lit(False)))
            number = F.row_number().over(Window.partitionBy(strata_col).orderBy(_TIE))
            some = d.where("`__equal`").withColumn(_NTH, number)
            d = d.where("not `__equal`").withColumn(_NTH, F.lit(None).cast("int")).unionByName(some)
            below = F.when(F.col("__equal"), F.col(_NTH) <= F.col("__last")).otherwise(F.col(_TIE) <= F.col("__tie_cut"))
        else:
            below = F.col(_TIE) <= F.col("__tie_cut")
        is_test = F.when(tied, below).otherwise(is_test)
    label = F.when(F.coalesce(is_test, F.lit(False)), F.lit(test_value)).otherwise(F.lit(train_value))
    return d.withColumn(split_col, label).drop(_OKH, "__cut", _TIE, "__tie_cut", "__last", "__equal", _NTH)


def _with_cut(d: DataFrame, cuts: dict, strata_col: str, name: str) -> DataFrame:
    """A stratum's cut on each of its rows (one row per stratum is broadcast); null without one."""
    table = cut_table(d, cuts, [strata_col], name).withColumnRenamed(strata_col, "__stratum")
    return d.join(F.broadcast(table), F.col(strata_col).eqNullSafe(F.col("__stratum")), "left").drop("__stratum")


def fit_validation_split(
    train: DataFrame,
    key_col: str,
    strata_col: str = "y",
    valid_share: float = 0.2,
    seed: int = 42,
    split_col: str = "fit_split",
) -> DataFrame:
    """Split the train rows again into ``fit`` / ``valid``, ordered by ``md5(key | seed+1)``."""
    return stratified_split(
        train, key_col, strata_col, valid_share, seed=seed + 1,
        split_col=split_col, test_value="valid", train_value="fit",
    )


def head_per_group(df: DataFrame, group_col: str, order_cols: list, k: int) -> DataFrame:
    """First ``k`` rows of each group (file) in a fixed order.

    ``row_number() <= k`` is planned as a per-partition group limit before the shuffle, so
    each map task sends at most ``k`` rows per group.
    """
    w = Window.partitionBy(group_col).orderBy(*order_cols)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= k).drop("__rn")


def rows_per_file(max_rows: int, n_files: int) -> int:
    """Per-file cap ``ceil(max_rows / files)``, at least 1."""
    return max(1, math.ceil(max_rows / max(n_files, 1)))


def seeded_sample(df: DataFrame, key: str | Column, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, chosen by seeded md5 order (TakeOrdered, no full sort)."""
    return df.orderBy(md5_order_key(key, seed)).limit(n)
