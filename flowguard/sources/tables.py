"""Flow views over the driver's parquet tables.

The driver's tables hold no network flows, so two views give every operator real rows:

* ``flows_lineitem``: one flow per line item. Source host from the supplier, destination host
  from the part, source port from the line number, destination port from the quantity;
  the return flag gives the label (N benign, R DDoS, A PortScan). Tax is missing on line 7
  and ``Price Rate`` (price / discount) is infinite where the discount is 0, so the cleaning
  steps meet real missing and infinite cells.
* ``flows_events``: one flow per event; user to event type, destination port from the
  ``k`` field of ``props``; errors are DDoS, sign-ups PortScan, the rest benign.

Plus two scored sets for the metric operators: ``scored_lineitem`` (y = not N,
score = extended price) and ``scored_documents`` (y = toxic, score = n_chars).
All are plain projections: Catalyst prunes the columns and pushes filters to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def flows_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    flow_id = F.concat_ws(
        "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_shipdate").cast("date").cast("string"),
    )
    label = (
        F.when(F.col("l_returnflag") == "N", F.lit("BENIGN"))
        .when(F.col("l_returnflag") == "R", F.lit("DDoS"))
        .otherwise(F.lit("PortScan"))
    )
    rate = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(
        F.col("l_extendedprice") / F.col("l_discount")
    )
    return li.select(
        flow_id.alias("Flow ID"),
        F.concat(F.lit("10.0."), F.col("l_suppkey").cast("string")).alias("Source IP"),
        F.concat(F.lit("192.168."), F.col("l_partkey").cast("string")).alias("Destination IP"),
        F.col("l_linenumber").cast("long").alias("Source Port"),
        F.col("l_quantity").cast("int").cast("long").alias("Destination Port"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_extendedprice").alias("Extended Price"),
        F.col("l_discount").alias("Discount"),
        F.when(F.col("l_linenumber") != 7, F.col("l_tax")).alias("Tax"),
        rate.alias("Price Rate"),
        label.alias("Label"),
    )


def flows_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    label = (
        F.when(F.col("event_type") == "error", F.lit("DDoS"))
        .when(F.col("event_type") == "signup", F.lit("PortScan"))
        .otherwise(F.lit("BENIGN"))
    )
    return ev.select(
        F.col("event_id").cast("string").alias("Flow ID"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("Source IP"),
        F.col("event_type").alias("Destination IP"),
        F.get_json_object("props", "$.k").alias("Destination Port"),
        F.col("value").alias("Value"),
        label.alias("Label"),
    )


def scored_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, y, score, raw_label, split) with the split by md5(key|42) in each class."""
    li = table(spark, sf_dir, "lineitem")
    key = F.concat_ws(
        "|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_shipdate").cast("date").cast("string"),
    )
    raw = (
        F.when(F.col("l_returnflag") == "N", F.lit("BENIGN"))
        .when(F.col("l_returnflag") == "R", F.lit("DDoS"))
        .otherwise(F.lit("PortScan"))
    )
    return li.select(
        key.alias("key"),
        F.when(F.col("l_returnflag") == "N", 0).otherwise(1).alias("y"),
        F.col("l_extendedprice").alias("score"),
        raw.alias("raw_label"),
    )


def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, y, score): toxic flag against document length, a small imbalanced set."""
    lab = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return lab.join(docs, "doc_id").select(
        F.col("doc_id").cast("string").alias("key"),
        F.col("toxic").cast("int").alias("y"),
        F.col("n_chars").cast("double").alias("score"),
    )


def embedding_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-wide float vectors as a flow table: label 0 is the attack class."""
    emb = table(spark, sf_dir, "embeddings")
    cols = [F.col("embedding")[i].cast("double").alias(f"e{i:02d}") for i in range(64)]
    return emb.select(
        F.col("vec_id").cast("string").alias("Flow ID"),
        *cols,
        F.when(F.col("label") == 0, F.lit("Attack")).otherwise(F.lit("BENIGN")).alias("Label"),
    )
