"""Exact quantiles from a sketch and one table of counts."""

import math
import random

import numpy as np
import pytest

from flowguard.operators import quantile_sketch as S
from flowguard.operators.clean import column_medians

PROBS = [0.0, 0.05, 0.5, 0.95, 0.99, 1.0]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = [("normal", rng.gauss(0, 1)) for _ in range(30_000)]
    out += [("hot", 7.0 if rng.random() < 0.4 else rng.random() * 14) for _ in range(20_000)]
    out += [("skew", math.exp(rng.gauss(0, 20))) for _ in range(20_000)]
    out += [("few", float(k)) for k in range(3)] + [("one", -0.0), (None, 1.0), (None, 2.0), (None, None), ("none", None), ("none", math.nan)]
    out += [("ends", math.inf)] * 600 + [("ends", -math.inf)] * 600 + [("ends", 1.0)] * 10
    return out


def want(rows, group, p):
    v = np.sort(np.array([x for g, x in rows if g == group and x is not None and not math.isnan(x)]))
    at = p * (len(v) - 1)
    lo, hi = v[int(at)], v[min(int(at) + 1, len(v) - 1)]
    return float(lo if lo == hi or at == int(at) else lo + (hi - lo) * (at - int(at)))


def check(found, rows):
    assert set(found) == {("normal",), ("hot",), ("skew",), ("few",), ("one",), (None,), ("ends",)}
    for (g,), values in found.items():
        for p in PROBS:
            assert values[p] == pytest.approx(want(rows, g, p), rel=1e-15, abs=0), (g, p)


@pytest.mark.parametrize("ranked", [100_000, 40])
def test_equal_to_sorting(spark, rows, monkeypatch, ranked):
    """With 40, windows are narrowed by histograms first."""
    monkeypatch.setattr(S, "RANKED_VALUES", ranked)
    found, n = S.sketched_quantiles(spark.createDataFrame(rows, "g string, x double"), "x", PROBS, ["g"])
    check(found, rows)
    assert n[("normal",)] == 30_000 and n[("one",)] == 1 and ("none",) not in n


def test_a_rank_outside_its_window(spark, rows, monkeypatch):
    """Windows that miss their ranks are noticed by the counts and widened."""
    real = S._windows

    def shifted(*args):
        out = real(*args)
        for t in out[::2]:
            t.lo, t.hi = (t.lo + 0.5, t.hi + 0.5) if math.isfinite(t.lo) else (t.lo, t.hi)
        return out

    monkeypatch.setattr(S, "_windows", shifted)
    check(S.sketched_quantiles(spark.createDataFrame(rows, "g string, x double"), "x", PROBS, ["g"])[0], rows)


def test_two_passes_over_the_data(spark, rows, out_dir):
    """The rows are read by the sketches and by the counts, and by nothing else."""
    spark.createDataFrame(rows, "g string, x double").write.parquet(f"{out_dir}/v")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.read.parquet(f"{out_dir}/v").mapInArrow(count, "g string, x double")
    S.sketched_quantiles(df, "x", [0.5, 0.99], ["g"])
    assert read.value <= 2 * len(rows)


def test_window_is_a_small_share(spark):
    df = spark.range(400_000).selectExpr("cast((id * 7919) % 400009 AS double) AS x")
    targets = S._windows(S._sketches(df, "x", []), [], [0.5], S.WIDTH * S.SKETCH_EPS)
    table = S._window_counts(df, "x", [], dict(enumerate(targets)))
    assert table.count() < 0.012 * 400_000
    assert S.sketched_quantiles(df, "x", [0.5])[0][()][0.5] == float(np.median((np.arange(400_000) * 7919) % 400009))


def test_empty(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert S.sketched_quantiles(empty, "a", [0.5]) == ({}, {})
    assert column_medians(empty, ["a", "b"], with_counts=True) == ({"a": 0.0, "b": 0.0}, {"a": 0, "b": 0})
