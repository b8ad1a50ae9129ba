"""Preparation of typed and text tables, graph features, report tables."""

import math
import os

import pytest
from pyspark.sql import functions as F

from flowguard.operators.graph import apply_graph, fit_graph
from flowguard.plans.experiment import dataset_summary, report_table
from flowguard.plans.prepare import prepare_flows
from flowguard.schema import FlowSchema
from flowguard.sources import sinks
from flowguard.sources.demo import build_demo_flows
from flowguard.sources.tables import flows_lineitem
from tests.conftest import SF_SMALL

FLOWS = "`Src IP` STRING, `Dst IP` STRING, `Src Port` STRING, `Dst Port` STRING, Bytes STRING, Class STRING"


def net(spark, rows, schema=FLOWS):
    return spark.createDataFrame(rows, schema)


def rounded(df, meta=("split",)):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.drop(*meta).collect())


@pytest.mark.parametrize("scope, labels", [("all", {"BENIGN", "Attack"}), ("train", {"BENIGN", "Attack"})])
def test_prepared_demo_rows_are_complete(spark, scope, labels):
    out, fit = prepare_flows(build_demo_flows(spark, 200, 3), test_share=0.3, seed=3, fit_scope=scope)
    rows = out.collect()
    assert sum(r["split"] == "test" for r in rows) == 60 and len(rows) == 200
    assert {r["label_raw"] for r in rows} == labels and {r["y"] for r in rows} == {0, 1}
    assert list(out.columns) == ["row_key", "split", "y", "label_raw", *fit.feature_names]
    for i, _ in enumerate(fit.feature_names, 4):
        train = [r[i] for r in rows if r["split"] == "train"]
        assert all(v is not None and math.isfinite(v) for v in train)
        assert abs(sum(train) / len(train)) < 1e-9  # centred on the training rows


def test_lookups_of_unseen_and_seen_keys(spark):
    seen = net(spark, [("a", "x", "1", "53", "9", "benign"), ("a", "y", "2", "53.0", "8", "benign"), ("b", "x", "1", "080", "7", "flood")])
    g = fit_graph(seen, FlowSchema.resolve(seen.columns))
    new = net(spark, [("a", "x", "7", "80", "1", None), ("zz", "zz", "9", "9", "1", None), (None, "x", None, "53", "1", None)])
    rows = {r["Src IP"]: r for r in apply_graph(new, g, log1p=False).collect()}
    names = ["src_out_count", "dst_in_count", "edge_count", "src_unique_dst", "dst_unique_src", "dst_port_count", "src_dst_port_count", "src_port_count"]
    assert [rows["a"][f"graph_{n}"] for n in names] == [2, 2, 1, 2, 2, 1, 0, 0]
    assert [rows["zz"][f"graph_{n}"] for n in names] == [0] * 8
    assert [rows[None][f"graph_{n}"] for n in names] == [0, 2, 0, 0, 2, 2, 0, 0]


def text_flows(spark):
    """The line-item flows as a CSV reader would bring them: all columns text, ports spelled in
    several ways, ids above 2**53."""
    f = flows_lineitem(spark, SF_SMALL)
    f = f.select(*[F.col(c).cast("string").alias(c) for c in f.columns])
    odd = F.crc32("Flow ID") % 3
    port = F.col("Destination Port")
    f = f.withColumn("Destination Port", F.when(odd == 0, F.concat(port, F.lit(".0"))).when(odd == 1, F.concat(F.lit("0"), port)).otherwise(port))
    return f.withColumn("Session", (F.lit(9007199254740992) + F.crc32("Flow ID") % 4096).cast("string"))


@pytest.mark.parametrize("scope", ["train", "all"])
def test_transform_of_the_fitted_rows_equals_the_prepared_table(spark, scope):
    raw = text_flows(spark)
    out, fit = prepare_flows(raw, key_col="Flow ID", fit_scope=scope)
    again = fit.transform(raw.dropDuplicates())
    part = "split = 'train'" if scope == "train" else "true"
    keys = out.where(part).select("row_key")
    assert rounded(again.join(keys, "row_key", "left_semi")) == rounded(out.where(part))
    assert out.agg(F.count_distinct(F.round("graph_dst_port_count", 6))).first()[0] > 3


def test_transform_needs_no_label(spark):
    raw = text_flows(spark).limit(400)
    _, fit = prepare_flows(raw, key_col="Flow ID")
    got = fit.transform(raw.drop("Label"))
    assert got.where("y is null and label_raw is null").count() == raw.count()
    assert rounded(got, ("split", "y", "label_raw")) == rounded(fit.transform(raw), ("split", "y", "label_raw"))
    fewer = fit.transform(raw.drop("Label", "Source Port", "Tax"))
    assert fewer.columns == got.columns and fewer.count() == raw.count()


def test_graph_features_need_the_roles(spark):
    _, plain = prepare_flows(build_demo_flows(spark, 60, 5))
    hosts = build_demo_flows(spark, 60, 5).withColumns({"Source IP": F.concat(F.lit("h"), F.monotonically_increasing_id() % 7), "Destination IP": F.lit("sink")})
    _, with_hosts = prepare_flows(hosts, fit_scope="all")
    assert plain.graph_feature_count == 0 and with_hosts.graph_feature_count == 5


def test_report_artifact_can_be_written(spark, out_dir):
    raw = build_demo_flows(spark, 120, 11)
    out, fit = prepare_flows(raw, seed=11, fit_scope="all")
    summary = dataset_summary(out, fit)
    assert {r["split"] for r in summary.collect()} == {"train", "test"}
    metrics = spark.createDataFrame([(0, "RandomForest", 0.95, 0.93, 0.97, 0.95, 0.98)],
                                    "run_order INT, model STRING, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, f1 DOUBLE, roc_auc DOUBLE")
    path = os.path.join(out_dir, "experiment_report")
    sinks.save_table(report_table(metrics), path)
    text = "".join(open(os.path.join(path + ".csv", f)).read() for f in os.listdir(path + ".csv") if f.endswith(".csv"))
    assert "RandomForest" in text and "0.9500" in text


def test_checkpointed_preparation_equals_cached(spark):
    from flowguard.sources.tables import flows_events

    raw = flows_events(spark, "/root/testdata/sf0.001")
    a, _ = prepare_flows(raw, key_col="Flow ID", persist="cache")
    b, _ = prepare_flows(raw, key_col="Flow ID", persist="checkpoint")
    ra = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in a.collect())
    rb = sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in b.collect())
    assert ra == rb
