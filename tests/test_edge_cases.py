"""Edge cases of SURVEY 1.1 and brute-force checks of the scale-form operators."""

import math
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowguard.functions.columns import binary_label, to_number
from flowguard.operators import metrics, order_stats, split, threshold
from flowguard.plans.prepare import prepare_flows
from flowguard.schema import trim_headers
from flowguard.sources.csv import find_csv_files, load_traffic_csvs


def test_number_text_coercion(spark):
    texts = ["Infinity", "-inf", "NaN", " 5 ", "5d", "0x10", "", "1e5", "1_000", "1f", "True", "-.5", None]
    want = [None, None, None, 5.0, None, None, None, 100000.0, None, None, None, -0.5, None]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    got = [r["v"] for r in df.select(to_number(F.col("t")).alias("v")).collect()]
    assert got == want


def test_labels_missing_lowercase_numeric(spark):
    df = spark.createDataFrame([(" benign ",), ("Normal",), (None,), ("0",), ("DDoS",)], "l STRING")
    assert [r[0] for r in df.select(binary_label("l")).collect()] == [0, 0, 1, 1, 1]


def test_header_trim_and_repeats(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` A` INT, B INT, `A ` INT")
    assert trim_headers(df).columns == ["A", "B", "A.1"]


def test_csv_files_read_trimmed_with_na_texts_and_caps(spark, tmp_path):
    d = tmp_path / "data" / "sub"
    d.mkdir(parents=True)
    (d / "a.csv").write_text(" Flow Duration, Label,Source IP\n10,BENIGN,1.1.1.1\nNA,DDoS,1.1.1.2\n20,BENIGN,1.1.1.1\n")
    (tmp_path / "data" / "b.csv").write_bytes(" Label,Extra\nPortScan,caf\xe9\nBENIGN,x\n".encode("latin1"))
    assert [os.path.basename(r["path"]) for r in find_csv_files(spark, str(tmp_path / "data")).collect()] == ["b.csv", "a.csv"]
    df = load_traffic_csvs(spark, str(tmp_path / "data"))
    assert set(df.columns) == {"Flow Duration", "Label", "Source IP", "Extra", "__source_csv"}
    rows = df.collect()
    assert len(rows) == 5
    assert sum(1 for r in rows if r["Flow Duration"] is None) == 3  # NA text + 2 rows of b.csv
    assert {r["Extra"] for r in rows if r["__source_csv"] == "b.csv"} == {"café", "x"}
    capped = load_traffic_csvs(spark, str(tmp_path / "data"), max_rows=2)
    assert capped.count() == 2


def test_train_only_missing_column_and_absent_test_column(spark):
    rows = [(f"k{i}", None if i < 80 else float(i), float(i % 7), "BENIGN" if i % 3 else "DDoS") for i in range(100)]
    df = spark.createDataFrame(rows, "`Flow ID` STRING, late DOUBLE, x DOUBLE, Label STRING")
    out, fit = prepare_flows(df, key_col="Flow ID", seed=1)
    train_non_null = out.where("split='train'").count()
    assert "x" in fit.feature_names
    # 'late' has values in some rows; it is dropped only if every train value is missing
    n_late_train = df.join(out.where("split='train'").select(F.col("row_key").alias("Flow ID")), "Flow ID").where("late IS NOT NULL").count()
    assert ("late" in fit.feature_names) == (n_late_train > 0) and train_non_null == 75
    new = spark.createDataFrame([("n1", 3.0, "BENIGN")], "`Flow ID` STRING, x DOUBLE, Label STRING")
    row = fit.transform(new).collect()[0]
    if "late" in fit.feature_names:
        assert row["late"] == pytest.approx((fit.medians["late"] - fit.means["late"]) / (fit.stds["late"] or 1.0))


@pytest.mark.parametrize("n,share", [(120, 0.25), (101, 0.25), (37, 0.2), (10, 0.5)])
def test_split_sizes_are_exact(spark, n, share):
    df = spark.createDataFrame([(f"r{i}", int(i % 3 == 0)) for i in range(n)], "k STRING, y INT")
    s = split.stratified_split(df, "k", "y", share, 9)
    got = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    counts = {(0,): sum(1 for i in range(n) if i % 3), (1,): sum(1 for i in range(n) if i % 3 == 0)}
    quota = split.allocate_test_quota(counts, share)
    assert sum(got.get((y, "test"), 0) for y in (0, 1)) == math.ceil(share * n)
    for (y,), q in quota.items():
        assert got.get((y, "test"), 0) == q
    assert s.count() == n


def test_rank_cut_counts_below_and_equal(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000), "v": rng.integers(0, 50, 3000).astype("int64")})
    quotas = {(0,): 17, (1,): 500, (2,): 900}
    got = order_stats.rank_cut(spark.createDataFrame(pdf), "v", quotas, ["g"], bins=4, final_rows=20)
    for (g,), q in quotas.items():
        v = np.sort(pdf[pdf.g == g].v.to_numpy())
        assert got[(g,)] == (v[q - 1], (v < v[q - 1]).sum(), (v == v[q - 1]).sum())


def test_split_is_exact_when_keys_repeat(spark):
    from flowguard.operators.split import stratified_split

    one_key = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").alias("row"), F.lit(1).alias("y"))
    ten_keys = spark.range(1200).select((F.col("id") % 10).cast("string").alias("k"), F.col("id").alias("row"), F.lit(1).alias("y"))
    hot = spark.range(2000).select(F.when(F.col("id") < 600, None).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("row"), (F.col("id") % 2).cast("int").alias("y"))
    equal = spark.range(800).select(F.lit("k").alias("k"), (F.col("id") % 2).alias("row"), F.lit(0).alias("y"))
    for df, n in ((one_key, 1000), (ten_keys, 1200), (hot, 2000), (equal, 800)):
        out = stratified_split(df, "k", "y", 0.25, 42)
        assert out.columns == [*df.columns, "split"]
        rows = out.groupBy("split").count().collect()
        assert {r["split"]: r["count"] for r in rows} == {"test": n // 4, "train": n - n // 4}
    again = {r["row"] for r in stratified_split(hot.repartition(3), "k", "y", 0.25, 42).where("split = 'test'").collect()}
    assert again == {r["row"] for r in stratified_split(hot, "k", "y", 0.25, 42).where("split = 'test'").collect()}


def test_quantiles_with_infinite_and_nan_scores(spark):
    values = [1.0, 2.0, float("inf"), float("-inf"), float("nan"), 3.0, None]
    df = spark.createDataFrame([(v,) for v in values], "s DOUBLE")
    got = {r["q"]: r["value"] for r in order_stats.exact_quantiles(df, "s", [0.0, 0.5, 0.75, 1.0]).collect()}
    assert got == {0.0: float("-inf"), 0.5: 2.0, 0.75: 3.0, 1.0: float("inf")}


def test_whole_numbers_keep_their_digits(spark):
    from flowguard.functions.columns import key_text, number_spelling
    from flowguard.operators.clean import canonical_numbers, drop_duplicate_rows

    text = ["9007199254740992", "9007199254740993", " 080", "80.0", "+80", "-0", "-007.00", "1e3", "1000", "2.50", "2.5", None]
    df = spark.createDataFrame([(t,) for t in text], "v STRING")
    assert [r["s"] for r in df.select(number_spelling("v").alias("s")).collect()] == [
        "9007199254740992", "9007199254740993", "80", "80", "80", "0", "-7", "1000", "1000", "2.5", "2.5", None]
    assert drop_duplicate_rows(canonical_numbers(df)).count() == 8
    ids = spark.createDataFrame([(9007199254740992,), (9007199254740993,)], "v BIGINT")
    assert [r["k"] for r in ids.select(key_text("v", ids.schema["v"].dataType).alias("k")).collect()] == text[:2]
    ports = spark.createDataFrame([("80.0",), ("080",), ("10.0.0.1",), ("",), (None,)], "v STRING")
    assert [r["k"] for r in ports.select(key_text("v", ports.schema["v"].dataType).alias("k")).collect()] == ["80", "80", "10.0.0.1", "", "unknown"]


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(0, 1, 2000), np.full(1500, 0.25), rng.exponential(3, 500)])
    pdf = pd.DataFrame({"g": np.arange(len(x)) % 2, "v": x})
    df = spark.createDataFrame(pdf)
    q = order_stats.exact_quantiles(df, "v", [0.0, 0.1, 0.5, 0.95, 0.99, 1.0], ["g"])
    for r in q.collect():
        want = np.quantile(pdf[pdf.g == r["g"]].v.to_numpy(), r["q"])
        assert r["value"] == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_auc_and_curves_against_brute_force(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.normal(y * 0.7, 1.0), 1)  # many ties
    df = spark.createDataFrame(pd.DataFrame({"y": y.astype("int32"), "score": s}))
    pos, neg = s[y == 1], s[y == 0]
    brute = np.mean([(p > n_) + 0.5 * (p == n_) for p in pos for n_ in neg])
    assert metrics.roc_auc(df).collect()[0]["roc_auc"] == pytest.approx(brute, rel=1e-12)
    pr = {r["threshold"]: (r["tp"], r["fp"]) for r in metrics.pr_curve(df).collect()}
    for t in np.unique(s):
        assert pr[t] == (int(((s >= t) & (y == 1)).sum()), int(((s >= t) & (y == 0)).sum()))


def test_cumulative_sums_cross_range_partitions(spark):
    pdf = pd.DataFrame({"score": np.arange(1000, dtype=float), "pos": np.ones(1000, dtype="int64")})
    out = metrics.cumulative_by_score(spark.createDataFrame(pdf), ["pos"], descending=True)
    got = {r["score"]: r["cum_pos"] for r in out.collect()}
    assert all(got[float(i)] == 1000 - i for i in range(1000))


def test_histogram_of_constant_class_and_no_benign_threshold(spark):
    df = spark.createDataFrame([(0, 2.0), (0, 2.0), (1, 1.0), (1, 3.0)], "y INT, score DOUBLE")
    h = {(r["y"], r["bin"]): r for r in metrics.score_histogram(df).collect()}
    assert len(h) == 70
    assert h[(0, 17)]["count"] == 2 and h[(0, 0)]["bin_lo"] == 1.5 and h[(1, 34)]["count"] == 1
    attacks = spark.createDataFrame([(1, float(i)) for i in range(1, 6)], "y INT, score DOUBLE")
    assert threshold.normal_quantile_threshold(attacks, q=0.95) == pytest.approx(4.8)


def test_graph_join_with_hot_keys_salted_equals_broadcast(spark):
    from flowguard.operators.graph import apply_graph, fit_graph
    from flowguard.schema import FlowSchema

    # one source host sends a third of all flows
    rows = [("10.0.0.1" if i % 3 == 0 else f"10.0.1.{i % 50}", f"192.168.0.{i % 7}", i % 5, 80 + i % 4, "BENIGN") for i in range(3000)]
    df = spark.createDataFrame(rows, "`Source IP` STRING, `Destination IP` STRING, `Source Port` BIGINT, `Destination Port` BIGINT, Label STRING")
    schema = FlowSchema.resolve(df.columns)
    g = fit_graph(df, schema)
    names = schema.graph_feature_names
    want = sorted(tuple(r) for r in apply_graph(df, g).select(*names).collect())
    try:
        spark.conf.set("flowguard.graph.broadcastMaxRows", "0")
        spark.conf.set("flowguard.skew.hotRows", "500")
        salted = apply_graph(df, g)
        plan = salted._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in salted.select(*names).collect())
    finally:
        spark.conf.unset("flowguard.graph.broadcastMaxRows")
        spark.conf.unset("flowguard.skew.hotRows")
    assert got == want
    assert "__salt" in plan


def test_csv_repeated_headers_and_number_spellings_dedup(spark, tmp_path):
    (tmp_path / "f.csv").write_text(" A,B, A,Label\n1,x,2,BENIGN\n1.0,x,2.00,BENIGN\n3,y,4,DDoS\n")
    df = load_traffic_csvs(spark, str(tmp_path))
    assert [c for c in df.columns if c != "__source_csv"] == ["A", "B", "A.1", "Label"]
    out, fit = prepare_flows(df, fit_scope="all")
    assert out.count() == 2          # '1,x,2' and '1.0,x,2.00' are one row once parsed
    from flowguard.operators.quality import inspect_flows

    r = inspect_flows(df).collect()[0]
    assert r["duplicate_rows"] == 1 and r["benign_samples"] == 1


def test_cumulative_sums_of_close_and_extreme_scores(spark):
    # 3000 distinct scores inside one narrow interval share a bucket and differ in their cells
    close = 1.0 + np.arange(3000) * 1e-9
    wild = np.array([-np.inf, -1e300, -2.5, -1e-300, 0.0, 1e-300, 2.5, 1e300, np.inf])
    for scores in (close, wild):
        pdf = pd.DataFrame({"score": scores, "pos": np.ones(len(scores), dtype="int64")})
        for down in (False, True):
            out = metrics.cumulative_by_score(spark.createDataFrame(pdf), ["pos"], descending=down)
            got = [r["cum_pos"] for r in out.orderBy("score").collect()]
            want = list(range(1, len(scores) + 1))
            assert got == (want[::-1] if down else want)


def test_graph_join_narrow_path_equals_broadcast(spark):
    from flowguard.operators.graph import apply_graph, fit_graph
    from flowguard.schema import FlowSchema

    rows = [(f"r{i}", "10.0.0.1" if i % 3 == 0 else f"10.0.1.{i % 50}", f"192.168.0.{i % 7}", i % 5, 80 + i % 4, "BENIGN")
            for i in range(2000)]
    df = spark.createDataFrame(rows, "rk STRING, `Source IP` STRING, `Destination IP` STRING, `Source Port` BIGINT, `Destination Port` BIGINT, Label STRING")
    schema = FlowSchema.resolve(df.columns)
    g = fit_graph(df, schema)
    names = schema.graph_feature_names
    want = sorted(tuple(r) for r in apply_graph(df, g).select("rk", *names).collect())
    try:
        spark.conf.set("flowguard.graph.broadcastMaxRows", "0")
        spark.conf.set("flowguard.skew.hotRows", "400")
        got = sorted(tuple(r) for r in apply_graph(df, g, row_key="rk").select("rk", *names).collect())
    finally:
        spark.conf.unset("flowguard.graph.broadcastMaxRows")
        spark.conf.unset("flowguard.skew.hotRows")
    assert got == want


def test_load_or_build_falls_back_to_demo_only_when_allowed(spark, tmp_path):
    from flowguard.sources.csv import load_or_build

    empty = tmp_path / "none"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        load_or_build(spark, str(empty))
    df, source = load_or_build(spark, str(empty), demo_data=True, demo_samples=200)
    assert source == "demo" and df.count() == 200
    counts = {r["Label"]: r["count"] for r in df.groupBy("Label").count().collect()}
    assert counts == {"BENIGN": 130, "Attack": 70}
    (tmp_path / "real.csv").write_text("Label,x\nBENIGN,1\n")
    df2, source2 = load_or_build(spark, str(tmp_path), demo_data=True)
    assert source2 == "files" and df2.count() == 1


def test_unreachable_folder_is_an_error_and_jobs_follow_headers(spark, tmp_path):
    from flowguard.sources.csv import file_groups, load_or_build

    with pytest.raises(Exception, match="nosuchscheme"):
        load_or_build(spark, "nosuchscheme://x/y", demo_data=True)
    (tmp_path / "d").mkdir()
    for i in range(12):
        head = "Label,a" if i % 3 else " Label , caf\xe9"
        (tmp_path / "d" / f"f {i:02d}+.csv").write_bytes(f"{head}\nBENIGN,{i}\nX,{i}\n".encode("latin1"))
    files = sorted(str(p) for p in (tmp_path / "d").iterdir())
    groups = file_groups(spark, files)
    assert sorted((names, enc, len(paths)) for names, enc, paths in groups) == [(["Label", "a"], "UTF-8", 8), (["Label", "caf\xe9"], "ISO-8859-1", 4)]
    df = load_traffic_csvs(spark, str(tmp_path / "d"))
    assert df.columns == ["Label", "caf\xe9", "a", "__source_csv"] and df.count() == 24
    assert {r["__source_csv"] for r in df.collect()} == {f"f {i:02d}+.csv" for i in range(12)}
    capped = load_traffic_csvs(spark, str(tmp_path / "d"), max_rows=12)
    assert capped.count() == 12 and {r["Label"] for r in capped.collect()} == {"BENIGN"}
