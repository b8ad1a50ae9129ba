"""Quality report (A15) on demo data with network columns, and its JSON sink."""

import json
import os

from pyspark.sql import functions as F

from flowguard.operators.quality import inspect_flows
from flowguard.sources import sinks
from flowguard.sources.demo import build_demo_flows


def test_inspection_report_can_be_written(spark, out_dir):
    raw = build_demo_flows(spark, 20, 5)
    raw = (
        raw.withColumn("__i", F.monotonically_increasing_id())
        .withColumn("Source IP", F.concat(F.lit("10.0.0."), (F.col("__i") % 3).cast("string")))
        .withColumn("Destination IP", F.concat(F.lit("192.168.1."), (F.col("__i") % 4).cast("string")))
        .withColumn("Source Port", (F.col("__i") % 5 + 5000).cast("long"))
        .withColumn("Destination Port", (F.col("__i") % 2 * 363 + 80).cast("long"))
        .drop("__i")
    )
    rep = inspect_flows(raw, data_source="demo")
    r = rep.collect()[0]
    assert r["label_column"] == "Label"
    assert r["raw_rows"] == 20 and r["raw_columns"] == 15
    assert r["graph_feature_count"] == 8
    assert r["network_columns"]["destination_port"] == "Destination Port"
    assert "demo_data" in r["recommendation_codes"]
    assert r["benign_samples"] + r["attack_samples"] == 20 - r["duplicate_rows"]
    path = os.path.join(out_dir, "data_inspection.json")
    sinks.save_report(rep, path)
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    doc = json.loads(open(os.path.join(path, files[0])).read())
    assert doc["label_column"] == "Label" and doc["graph_feature_count"] == 8


def test_report_counts_missing_infinite_and_duplicates(spark):
    rows = [(" 1 ", "Infinity", "BENIGN"), (" 1 ", "Infinity", "BENIGN"), ("NaN", "5d", "DDoS"), (None, "0x10", None)]
    df = spark.createDataFrame(rows, "` a` STRING, b STRING, Label STRING")
    r = inspect_flows(df).collect()[0]
    assert r["raw_rows"] == 4 and r["duplicate_rows"] == 1
    assert r["missing_cells"] == 2            # a null cell and a null label; 'NaN' text is not missing here
    assert r["infinite_cells"] == 2
    assert r["attack_type_count"] == 2        # DDoS and the missing label ('nan')
    assert r["benign_samples"] == 1 and r["attack_samples"] == 2
