"""Merged count tables equal one fit; merged sketches keep to their error."""

import pytest
from pyspark.sql import functions as F

from flowguard.operators import graph, graph_state
from flowguard.schema import FlowSchema


def flows(spark, n=600):
    f = spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("h"), (F.col("id") % 13).cast("string"))).alias("Source IP"),
        F.when(F.col("id") % 10 != 0, F.concat(F.lit("d"), (F.col("id") % 29).cast("string"))).alias("Destination IP"),
        (F.col("id") % 5).alias("Source Port"), F.when(F.col("id") % 7 != 0, F.col("id") % 4).alias("Destination Port"), F.lit("x").alias("Label"),
    )
    return f, FlowSchema.resolve(f.columns)


def rows(t):
    return sorted(str(tuple(r)) for r in t.collect())


def test_merged_periods_equal_one_fit(spark, out_dir):
    f, schema = flows(spark)
    for k, part in enumerate(("id < 200", "id >= 200 and id < 210", "id >= 210")):
        graph_state.save_period(f.where(part), schema, f"{out_dir}/g", f"p{k}")
    graph_state.save_period(f.where("id < 200"), schema, f"{out_dir}/g", "p0")  # run twice, counted once
    one, merged = graph.fit_graph(f, schema), graph_state.fit_periods(spark, schema, f"{out_dir}/g", ["p0", "p1", "p2"])
    assert merged.sizes == one.sizes
    for (name, a, keys, values), (_, b, *_x) in zip(one.tables(), merged.tables(), strict=True):
        assert rows(a.select(*keys, *values)) == rows(b.select(*keys, *values)), name
    assert rows(graph.apply_graph(f, one)) == rows(graph.apply_graph(f, merged))
    later = graph_state.fit_periods(spark, schema, f"{out_dir}/g", ["p1", "p2"])
    assert rows(later.src) == rows(graph.fit_graph(f.where("id >= 200"), schema).src)


def test_an_empty_period_adds_nothing(spark, out_dir):
    f, schema = flows(spark)
    graph_state.save_period(f, schema, f"{out_dir}/g", "a")
    graph_state.save_period(f.where("false"), schema, f"{out_dir}/g", "b")
    assert rows(graph_state.fit_periods(spark, schema, f"{out_dir}/g", ["a", "b"]).edge) == rows(graph.fit_graph(f, schema).edge)


def test_sketches_merge(spark):
    f, schema = flows(spark, 20_000)
    f = f.withColumn("Destination IP", F.when(F.col("Source IP") == "hot", F.col("id").cast("string")).otherwise(F.col("Destination IP")))
    halves = [graph_state.host_sketches(f.where(F.col("id") % 2 == k), schema) for k in (0, 1)]
    merged = {(r.role, r.host): r for r in graph_state.host_degrees(graph_state.merge_host_sketches(halves)).collect()}
    whole = {(r.role, r.host): r for r in graph_state.host_degrees(graph_state.host_sketches(f, schema)).collect()}
    g = graph.fit_graph(f, schema)
    exact = {("src", r[0]): (r[1], r[2]) for r in g.src.collect()} | {("dst", r[0]): (r[1], r[2]) for r in g.dst.collect()}
    assert set(merged) == set(whole) == set(exact)
    for key, (n, peers) in exact.items():
        assert merged[key].rows == whole[key].rows == n
        assert abs(merged[key].distinct_peers - peers) <= 5 * graph_state.SKETCH_ERROR * peers + 0.5


def test_columns_that_are_not_there(spark, out_dir):
    f = spark.createDataFrame([("x",)], "Label string")
    schema = FlowSchema.resolve(f.columns)
    with pytest.raises(ValueError, match="host"):
        graph_state.save_period(f, schema, out_dir, "a")
    with pytest.raises(ValueError, match="host"):
        graph_state.host_sketches(f, schema)
    assert graph.fit_graph(f, schema).tables() == []
