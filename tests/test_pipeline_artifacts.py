"""A small end-to-end pipeline run writes every table, the manifest and the checklist."""

import json
import math
import os

import pytest

from flowguard.plans.experiment import load_prepared_data, run_pipeline, run_research, write_outputs
from flowguard.sources import sinks
from flowguard.sources.demo import build_demo_flows


def test_pipeline_writes_manifest_and_checklist(spark, out_dir):
    raw = build_demo_flows(spark, 400, 3)
    out = run_pipeline(spark, raw, out_dir=out_dir, data_source="demo", epochs=1, ablation_epochs=1,
                       mask_ratios="0,0.3", persist="cache")
    models = [r["model"] for r in out["metrics"].orderBy("run_order").collect()]
    assert models == ["RandomForest", "MLP", "Vanilla Autoencoder", "Transformer Autoencoder", "Masked Transformer Autoencoder"]
    assert out["mask_ratio_ablation"].count() == 2
    mdir = os.path.join(out_dir, "pipeline_manifest.json")
    text = "".join(open(os.path.join(mdir, f)).read() for f in os.listdir(mdir) if f.startswith("part-"))
    manifest = json.loads(text)
    assert manifest["data_source"] == "demo" and manifest["mask_ablation_count"] == 2
    check = {r["name"]: r["present"] for r in out["metrics"].sparkSession.read.option("header", True).csv(os.path.join(out_dir, "checklist.csv")).collect()}
    assert check and all(v == "true" for v in check.values())
    assert manifest["pipeline_args"]["mask_ratios"] == "0,0.3" and manifest["pipeline_args"]["test_size"] == 0.25
    read = lambda name: [f for f in os.listdir(os.path.join(out_dir, name)) if f.startswith("part-")]
    for model in ("randomforest", "mlp", "vanilla_autoencoder"):
        assert read(f"roc_curve_{model}.csv") and read(f"confusion_matrix_{model}.csv")
    config = json.loads(open(os.path.join(out_dir, "run_config.json", read("run_config.json")[0])).read())
    assert config == manifest["pipeline_args"] and set(manifest["tables"]) >= set(check)
    report = json.loads(open(os.path.join(out_dir, "experiment_report.json", read("experiment_report.json")[0])).read())
    assert report["best_model"] in models and [m["model"] for m in report["metrics"]] == models
    assert report["train_samples"] + report["test_samples"] == sum(report[f"{s}_label_summary"][c] for s in ("train", "test") for c in ("BENIGN", "Attack"))
    assert sinks.complete(spark, out_dir) == manifest
    stop_between_tables(spark, out, out_dir)


def stop_between_tables(spark, out, out_dir):
    """A writer that fails after some tables leaves no manifest; the next one writes it again."""
    real, calls = sinks.save_table, []

    def failing(*args, **kw):
        calls.append(args)
        if len(calls) == 4:
            raise OSError("the store is gone")
        return real(*args, **kw)

    with pytest.MonkeyPatch.context() as m, pytest.raises(OSError, match="gone"):
        m.setattr(sinks, "save_table", failing)
        write_outputs(spark, out, out_dir)
    assert sinks.complete(spark, out_dir) is None
    write_outputs(spark, out | {"results": {}, "mask_ratio_ablation": None}, out_dir)
    assert sinks.complete(spark, out_dir)["mask_ablation_count"] == 0


def test_run_from_files(spark, out_dir):
    """Files are listed, loaded and named in the report; arguments reach the steps."""
    build_demo_flows(spark, 300, 4).coalesce(1).write.option("header", True).csv(f"{out_dir}/in")
    kw = dict(epochs=1, run_ablation=False, baselines=False, persist="cache", unmasked_transformer=False, attack_tables=False, test_size=0.4, use_graph_features=False, batch_size=32)
    out = run_research(spark, f"{out_dir}/in", **kw)
    report = out["report"].first()
    assert report["csv_file_count"] == 1 and report["data_source"] == "files" and report["graph_feature_count"] == 0
    n = {r["split"]: r["count"] for r in out["prepared"].groupBy("split").count().collect()}
    assert n["test"] == math.ceil(0.4 * (n["test"] + n["train"])) and out["fitted"].graph is None
    assert out["config"]["max_rows"] is None and out["config"]["batch_size"] == 32
    prepared, fitted, source = load_prepared_data(spark, f"{out_dir}/in", test_size=0.4, use_graph_features=False)
    assert source == "files" and fitted.feature_names == out["fitted"].feature_names and prepared.count() == sum(n.values())
    _p, _f, source = load_prepared_data(spark, f"{out_dir}/none", demo_data=True, demo_samples=200)
    assert source == "demo"
    with pytest.raises(FileNotFoundError):
        load_prepared_data(spark, f"{out_dir}/none")


def test_short_pipeline_form(spark, out_dir):
    raw = build_demo_flows(spark, 300, 4)
    out = run_pipeline(spark, raw, out_dir=out_dir, data_source="demo", epochs=1, run_ablation=False, baselines=False,
                       persist="cache", inspect=False, unmasked_transformer=False, attack_tables=False)
    models = [r["model"] for r in out["metrics"].orderBy("run_order").collect()]
    assert models == ["Vanilla Autoencoder", "Masked Transformer Autoencoder"]
    assert out["report"] is None and out["attack_type_metrics"] is None
