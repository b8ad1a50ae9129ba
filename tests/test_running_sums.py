"""Running sums over scores: by buckets, and by cells where a bucket is full."""

import math
import random

import pytest

from flowguard.operators.metrics import cumulative_by_score, curve_table, roc_auc
from flowguard.operators.threshold import strategy_thresholds


def scores(rng):
    base = [rng.gauss(0, 1) * 10.0 ** rng.randint(-6, 6) for _ in range(400)] + [1.0 + k / 1000 for k in range(300)] + [1.0 + k * 1e-12 for k in range(100)]
    return sorted(set(base)) + [math.inf, -math.inf, 0.0]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("bucket_scores", [200_000, 7])
def test_running_sums(spark, descending, bucket_scores):
    rng = random.Random(6)
    rows = [(g, s, rng.randint(0, 5), rng.randint(0, 10**12)) for g in ("a", None) for s in scores(rng)] + [("nan", math.nan, 1, 2), ("nan", 3.0, 4, 5)]
    df = spark.createDataFrame(rows, "g string, score double, pos bigint, neg bigint").repartition(5)
    got = {(r.g, str(r.score)): (r.cum_pos, r.cum_neg) for r in cumulative_by_score(df, ["pos", "neg"], descending, ["g"], bucket_scores).collect()}
    assert len(got) == len(rows)
    rank = lambda s: math.inf if math.isnan(s) else s  # noqa: E731  NaN stands last
    for g in ("a", None, "nan"):
        total = [0, 0]
        for _, s, p, n in sorted((r for r in rows if r[0] == g), key=lambda r: (rank(r[1]), math.isnan(r[1])), reverse=descending):
            total = [total[0] + p, total[1] + n]
            assert got[g, str(s)] == tuple(total), (g, s)


def test_few_jobs_and_no_window_over_all_rows(spark):
    df = spark.range(5000).selectExpr("cast(id % 977 AS double) AS score", "cast(id % 3 = 0 AS int) AS y")
    plan = curve_table(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "windowspecdefinition(__b#" in plan
    empty = df.where("false")
    assert curve_table(empty).count() == 0 and roc_auc(empty).collect() in ([], [(None,)])


def test_lowest_threshold_wins_ties(spark):
    """Every threshold from 1 to 3 has the same F1: no row lies between them."""
    df = spark.createDataFrame([(3.0, 1), (3.0, 1), (0.5, 0), (0.5, 0), (0.25, 0)], "score double, y int")
    best = dict(strategy_thresholds(df))
    assert best["best_f1"] == 3.0 and best["target_recall_0.90"] == 3.0
    tied = spark.createDataFrame([(2.0, 1), (1.0, 0), (1.0, 1)], "score double, y int")
    assert dict(strategy_thresholds(tied))["best_f1"] == 1.0
