"""Exact top-k by way of a bounded summary."""

import random

import pytest
from pyspark.sql import functions as F

from flowguard.operators import heavy_hitters as H
from flowguard.operators.quality import top_counts


def plain(values, k):
    n = {}
    for v in values:
        n[v] = n.get(v, 0) + 1
    return sorted(n.items(), key=lambda x: (-x[1], x[0]))[:k]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string").repartition(6)


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(9)
    out = [f"v{int(rng.paretovariate(0.9))}" for _ in range(60_000)] + [f"single {i}" for i in range(20_000)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("tracked", [200, 2000])
def test_proven_top_is_exact(spark, skewed, tracked):
    got = H.proven_top(frame(spark, skewed), "value", 5, tracked)
    assert [tuple(r) for r in got.collect()] == plain(skewed, 5)


def test_ties_by_value(spark):
    values = ["b", "a", "c"] * 500 + ["d"] * 499 + [f"x{i}" for i in range(500)]
    assert [tuple(r) for r in H.proven_top(frame(spark, values), "value", 3, 1000).collect()] == [("a", 500), ("b", 500), ("c", 500)]


def test_flat_counts_are_not_decided_by_the_summary(spark):
    values = [f"u{i % 5000}" for i in range(20_000)]
    df = frame(spark, values)
    assert H.proven_top(df, "value", 10, 200) is None
    assert [tuple(r) for r in H.top_values(df, "value", 10, True, 200).collect()] == plain(values, 10)


def test_unnamed_values_keep_to_the_bound(spark, skewed):
    """The bound against the counts themselves, for several sizes."""
    df = frame(spark, skewed)
    exact = dict(plain(skewed, len(skewed)))
    for tracked in (50, 200, 1000):
        named = {r["item"] for r in df.agg(F.expr(f"approx_top_k(value, {tracked}, {tracked})").alias("t")).first()["t"]}
        assert max(n for v, n in exact.items() if v not in named) <= H.unnamed_share(tracked) * len(skewed)


def test_top_counts_of_odd_values(spark):
    values = [None, None, " a ", "a", "", "", "", "b"] * 300
    df = frame(spark, values)
    want = plain(["nan" if v is None else v.strip() for v in values], 4)
    for first in (True, False, None):
        assert [tuple(r) for r in top_counts(df, F.col("value"), 4, summary_first=first).collect()] == want
    assert top_counts(df.where("false"), F.col("value"), 4, summary_first=True).count() == 0
    assert len(top_counts(df, F.col("value"), 100, summary_first=True).collect()) == 4


def test_slots():
    assert [H.summary_slots(n) for n in (6, 7, 10_000, 12_288, 12_289)] == [8, 16, 16_384, 16_384, 32_768]
