"""Count tables stored in buckets: the same features, and no shuffle on the tables' side."""

import re

import pytest
from pyspark.sql import functions as F

from flowguard.operators import graph
from flowguard.schema import FlowSchema


def flows(spark, n=400):
    r = spark.range(n)
    host = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("h"), (F.col("id") % 17).cast("string")))
    return r.select(
        F.col("id"), host.alias("Source IP"), F.concat(F.lit("d"), (F.col("id") % 5).cast("string")).alias("Destination IP"),
        (F.col("id") % 7).alias("Source Port"), F.when(F.col("id") % 11 != 0, F.col("id") % 4).alias("Destination Port"), F.lit("BENIGN").alias("Label"),
    )


@pytest.fixture()
def fitted(spark, out_dir):
    f = flows(spark)
    g = graph.fit_graph(f.where("id < 300"), FlowSchema.resolve(f.columns))
    return f, g, f"{out_dir}/counts"


def rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("hot_rows", [1, 20, 10**6])
def test_same_features(spark, fitted, hot_rows):
    f, g, folder = fitted
    want = rows(graph.apply_graph(f, g))
    stored = graph.store_lookups(g, folder, buckets=8)
    assert stored.sizes == g.sizes and stored.feature_names == g.feature_names
    assert rows(graph.apply_graph(f, stored, broadcast_rows=0, hot_rows=hot_rows)) == want
    assert rows(graph.apply_graph(f, stored, broadcast_rows=0, hot_rows=hot_rows, row_key="id")) == want
    assert rows(graph.apply_graph(f, stored)) == want


def test_second_run_shuffles_flows_only(spark, fitted):
    f, g, folder = fitted
    graph.store_lookups(g, folder, buckets=8)
    for name, *_ in g.tables():  # as in a new session
        spark.sql(f"DROP TABLE {graph._bucket_table(f'{folder}/{name}')}")
    stored = graph.load_lookups(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = graph.apply_graph(f, stored, broadcast_rows=0)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = plan.count("SortMergeJoin")
    assert joins == len(stored.tables())
    shuffled = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert shuffled == ["__j"] * joins  # the flow rows' keys, once a join; never a table's
    assert plan.count("Bucketed: true") >= joins
    assert rows(graph.apply_graph(f, stored, broadcast_rows=0)) == rows(graph.apply_graph(f, g))


def test_new_rows_and_odd_keys(spark, fitted):
    """Unseen keys count 0; null keys are one key; an empty input stays empty."""
    f, g, folder = fitted
    stored = graph.store_lookups(g, folder, buckets=8)
    new = spark.createDataFrame([(1, "nobody", "nobody", 9, None, "x"), (2, None, "d1", None, 1, "x")], f.schema.simpleString()[7:-1].replace(":", " ").replace("Source IP", "`Source IP`").replace("Destination IP", "`Destination IP`").replace("Source Port", "`Source Port`").replace("Destination Port", "`Destination Port`"))
    assert rows(graph.apply_graph(new, stored, broadcast_rows=0, hot_rows=5)) == rows(graph.apply_graph(new, g))
    assert graph.apply_graph(new.where("id > 5"), stored, broadcast_rows=0).count() == 0
