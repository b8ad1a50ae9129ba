"""Thresholds, orientation, per-attack metrics, mask-ratio parsing."""

import pytest
from pyspark.sql import functions as F

from flowguard.functions.columns import parse_mask_ratios, parse_mask_ratios_col
from flowguard.operators.metrics import attack_type_metrics
from flowguard.operators.threshold import (
    apply_orientation,
    orient_scores,
    threshold_analysis,
    threshold_for_f1,
    threshold_for_recall,
)


def _scores(spark, ys, ss):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(ys, ss)], "y INT, score DOUBLE")


def test_strategies_on_separable_and_overlapping_scores(spark):
    apart = _scores(spark, [0] * 8 + [1] * 4, [*range(8), 20, 21, 22, 23])
    later = _scores(spark, [0, 0, 0, 1, 1], [3, 19.5, 20.5, 20, 40])
    rows = {r["strategy"]: r for r in threshold_analysis(apart, later, "any").collect()}
    assert {"best_f1", "normal_95_percentile", "normal_99_percentile", "target_recall_0.90"} <= set(rows)
    assert rows["best_f1"]["threshold"] == 20.0
    assert (rows["best_f1"]["precision"], rows["best_f1"]["recall"]) == (pytest.approx(2 / 3), 1.0)
    assert rows["normal_95_percentile"]["threshold"] == pytest.approx(6.65)
    mixed = _scores(spark, [0, 1, 0, 1, 1, 0], [1, 2, 3, 4, 5, 6])
    best = threshold_for_f1(mixed)
    assert type(best) is float and best == 2.0  # 3 hits, 2 false alarms


def test_ties_pick_lowest_threshold_and_single_class_uses_quantile(spark):
    # the best F1 (1.0) is reached at 0.6 only; lower thresholds add false positives
    df = _scores(spark, [0, 1, 1, 0], [0.1, 0.6, 0.6, 0.2])
    assert threshold_for_f1(df) == 0.6
    one = _scores(spark, [0, 0, 0, 0, 0], [1, 2, 3, 4, 5])
    assert abs(threshold_for_f1(one) - 4.8) < 1e-12
    assert abs(threshold_for_recall(one) - 4.8) < 1e-12


def test_orientation_follows_validation_auc(spark):
    falling = _scores(spark, [1, 1, 1, 0, 0], [0, 1, 3, 2, 5])
    inverted, auc = orient_scores(falling)
    assert inverted and auc == pytest.approx(1 / 6)
    assert sorted(r["score"] for r in apply_orientation(falling, inverted).collect()) == [-5, -3, -2, -1, 0]
    rising = falling.withColumn("score", -F.col("score"))
    inverted, auc = orient_scores(rising)
    assert not inverted and auc == pytest.approx(5 / 6)
    assert apply_orientation(rising, inverted).collect() == rising.collect()


def test_each_attack_type_meets_all_benign_rows(spark):
    rows = [("ok", 0, 0)] * 6 + [("OK ", 0, 1)] * 2 + [("scan", 1, 1)] * 3 + [("worm", 1, 0)] * 4 + [(" ", 1, 1)]
    df = spark.createDataFrame([("BENIGN" if n.strip().lower() == "ok" else n, y, p) for n, y, p in rows], "kind STRING, y INT, pred INT")
    got = {r["attack_type"]: r for r in attack_type_metrics(df, "kind", "y", "pred").collect()}
    assert sorted(got) == ["scan", "worm"]
    assert all(r["benign_samples"] == 8 for r in got.values())
    assert (got["scan"]["precision"], got["scan"]["recall"]) == (pytest.approx(3 / 5), 1.0)
    assert (got["worm"]["f1"], got["worm"]["attack_samples"]) == (0.0, 4)


@pytest.mark.parametrize("text, want", [("0.5", [0.5]), (" .25 ,, 0 ,0.999", [0.25, 0.0, 0.999]), ("1e-1,\t", [0.1])])
def test_mask_ratio_lists(spark, text, want):
    assert parse_mask_ratios(text) == want
    assert spark.range(1).select(parse_mask_ratios_col(F.lit(text)).alias("r")).first()["r"] == want


@pytest.mark.parametrize("text", ["", ",", "1", "-0.1", "0.2;0.3", "nan", "x"])
def test_bad_mask_ratio_lists(text):
    with pytest.raises(ValueError):
        parse_mask_ratios(text)


def test_benign_values_as_a_table(spark):
    from flowguard.functions.columns import binary_label_from_table

    df = spark.createDataFrame([(" benign ",), ("Normal",), ("quiet",), ("DDoS",), (None,)], "Label STRING")
    ben = spark.createDataFrame([("BENIGN",), ("normal",), ("Quiet",)], "v STRING")
    got = [r["y"] for r in binary_label_from_table(df, "Label", ben).orderBy(F.col("Label").asc_nulls_last()).collect()]
    # ' benign ', 'DDoS', 'Normal', 'quiet', null
    assert got == [0, 1, 0, 0, 1]


def test_best_model_tie_goes_to_first_run(spark):
    from flowguard.operators.metrics import best_by_f1

    m = spark.createDataFrame([("A", 0, 0.9), ("B", 1, 0.95), ("C", 2, 0.95)], "model STRING, run_order INT, f1 DOUBLE")
    assert best_by_f1(m).collect()[0]["model"] == "B"


def test_threshold_analysis_with_single_class_validation(spark):
    valid = _scores(spark, [0, 0, 0, 0, 0], [1, 2, 3, 4, 5])
    test = _scores(spark, [0, 1], [4.9, 5.0])
    rows = {r["strategy"]: r for r in threshold_analysis(valid, test, "Demo").collect()}
    assert rows["best_f1"]["threshold"] == pytest.approx(4.8)
    assert rows["target_recall_0.90"]["threshold"] == pytest.approx(4.8)
    assert rows["normal_99_percentile"]["threshold"] == pytest.approx(4.96)
    assert rows["best_f1"]["recall"] == 1.0
