"""Plan checks: the scale forms are what Spark runs."""

from pyspark.sql import functions as F

from flowguard.functions.columns import format_bytes
from flowguard.operators import metrics
from flowguard.sources.csv import csv_file_table
from flowguard.sources.tables import flows_lineitem, scored_lineitem
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_curves_sum_by_bucket_and_broadcast_no_offsets(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = metrics.score_table(scored_lineitem(spark, SF_SMALL))
        plain = _plan(metrics.cumulative_by_score(table, ["pos", "neg"]))
        cells = _plan(metrics.cumulative_by_score(table, ["pos", "neg"], bucket_scores=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for plan, count in ((plain, 1), (cells, 2)):  # rows of a bucket; cells of a full bucket, rows of a cell
        windows = [line.split("windowspecdefinition")[1].split("ASC")[0].split("DESC")[0] for line in plan.splitlines() if "Window [" in line]
        assert len(windows) == count and all("__b#" in w for w in windows)
        assert "BroadcastExchange" not in plan and "SinglePartition" not in plan
    assert "__cell" in cells


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    df = flows_lineitem(spark, SF_SMALL).where(F.col("Quantity") > 10).select("Quantity", "Label")
    plan = _plan(df)
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan
    assert "GreaterThan(l_quantity,10.0)" in plan


def test_file_sizes_are_formatted(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Label\nBENIGN\n")
    rows = csv_file_table(spark, str(tmp_path)).collect()
    assert rows[0]["size"] == "13.00 B"
    got = spark.range(1).select(format_bytes(F.lit(5 * 1024 * 1024)).alias("s")).collect()[0]["s"]
    assert got == "5.00 MB"
