"""Sinks (S9-S14): metric tables as CSV + JSON, one-row JSON summaries, output checklist."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.session import path_exists


def save_table(df: DataFrame, path: str, csv: bool = True, json_twin: bool = True) -> None:
    """A (small) result table as one CSV file with header and a JSON twin."""
    one = df.coalesce(1)
    if csv:
        one.write.mode("overwrite").option("header", "true").csv(f"{path}.csv")
    if json_twin:
        one.write.mode("overwrite").json(f"{path}.json")


def save_json_row(spark: SparkSession, data: dict, path: str) -> None:
    """One dict as a one-row JSON output (numpy values made plain)."""
    plain = json.loads(json.dumps(data, default=_plain))
    spark.createDataFrame([(json.dumps(plain, ensure_ascii=False),)], "value STRING").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def save_report(df: DataFrame, path: str) -> None:
    """A one-row nested report (maps, arrays, structs) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def _plain(v):
    if hasattr(v, "item"):
        return v.item()
    if hasattr(v, "tolist"):
        return v.tolist()
    return str(v)


REQUIRED_OUTPUTS = (
    "data_inspection", "experiment_report", "run_config", "metrics", "attack_type_metrics", "dataset_summary",
    "label_distribution", "model_comparison", "feature_importance_randomforest",
    *(f"{table}_{model}" for table in ("confusion_matrix", "score_histogram", "threshold_analysis", "roc_curve", "pr_curve")
      for model in ("transformer_autoencoder", "masked_transformer_autoencoder")),
)


def remove(spark: SparkSession, path: str) -> None:
    """Remove an output of an earlier run, if there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def complete(spark: SparkSession, out_dir: str) -> dict | None:
    """The manifest of a run whose outputs are all written, else None."""
    path = f"{out_dir.rstrip('/')}/pipeline_manifest.json"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    return json.loads(spark.read.text(path).first()[0])


def output_checklist(spark: SparkSession, out_dir: str, include_mask_ablation: bool = True) -> DataFrame:
    """Required output names left-joined to the listing of the output folder."""
    names = list(REQUIRED_OUTPUTS) + (["mask_ratio_ablation"] if include_mask_ablation else [])
    expected = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos INT, name STRING")
    if path_exists(spark, out_dir):
        listing = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(out_dir)
            .select(F.regexp_extract("path", r"/([^/]+)\.(csv|json)/[^/]+$", 1).alias("name"))
            .where(F.col("name") != "").distinct()
        )
    else:
        listing = spark.createDataFrame([], "name STRING")
    return (
        expected.join(listing.withColumn("present", F.lit(True)), "name", "left")
        .select("pos", "name", F.coalesce("present", F.lit(False)).alias("present"))
        .orderBy("pos")
    )
