"""Scoring new flows as a stream with the fitted state (optional extension of SURVEY 2.10).

Everything fitted by a batch run is static: medians and moments are literals, the graph
count tables are small/large static DataFrames, the autoencoder weights a broadcast vector,
the threshold a number. So the same plan runs on ``readStream``: stream-static left joins
for the graph counts, a ``mapInPandas`` for the reconstruction error, a comparison for the
alert. The query keeps no state, so it needs no watermark; the checkpoint location makes
it restartable after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowguard.functions.columns import predict
from flowguard.operators.autoenc import TrainedAE, score_rows
from flowguard.plans.prepare import META, FittedPrep


def read_flow_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", max_files: int = 1) -> DataFrame:
    """New flow files arriving under ``path`` (parquet or CSV with header)."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if fmt == "csv":
        reader = reader.option("header", "true")
    return reader.format(fmt).load(path)


def score_flows(flows: DataFrame, fitted: FittedPrep, model: TrainedAE, threshold: float,
                inverted: bool = False) -> DataFrame:
    """Batch or stream: fitted preparation -> reconstruction error -> alert flag."""
    prepared = fitted.transform(flows, split_value="stream")
    prepared = prepared.withColumn(
        model.feature_col, F.array(*[F.col(f"`{c}`").cast("double") for c in fitted.feature_names])
    )
    scored = score_rows(prepared, model, META)
    if inverted:
        scored = scored.withColumn("score", -F.col("score"))
    return scored.withColumn("alert", predict("score", threshold))


def start_alert_stream(scored: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                       trigger_seconds: int | None = None) -> StreamingQuery:
    """Append scored flows to a file sink (exactly once through the checkpoint)."""
    w = scored.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start(sink_path)
