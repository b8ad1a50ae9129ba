"""A large table is prepared through stored steps: same rows, nothing left behind but what is read."""

import glob

import pytest
from pyspark.sql import functions as F

from flowguard.plans import prepare
from flowguard.session import ensure_checkpoint_dir, stored


def flows(spark, n=900):
    i = F.col("id")
    return spark.range(n).select(
        F.concat(F.lit("f"), (i % 700).cast("string")).alias("Flow ID"),
        F.concat(F.lit("10.0.0."), (i % 13).cast("string")).alias("Source IP"),
        F.when(i % 17 != 0, F.concat(F.lit("10.0.1."), (i % 29).cast("string"))).alias("Destination IP"),
        (i % 7).alias("Source Port"),
        F.when(i % 11 != 0, i % 5).alias("Destination Port"),
        ((i * 37) % 101).cast("double").alias("Bytes"),
        F.when(i % 3 == 0, F.lit("DDoS")).otherwise(F.lit("BENIGN")).alias("Label"),
    )


def folders(spark):
    return set(glob.glob(ensure_checkpoint_dir(spark).replace("file:", "").rstrip("/") + "/flowguard-tables/*"))


@pytest.mark.parametrize("key", ["Flow ID", None])
def test_stored_steps_give_the_cached_rows(spark, monkeypatch, key):
    raw = flows(spark).unionByName(flows(spark, 40))  # rows that come twice
    rows = lambda df: sorted(map(str, df.collect()))
    cached, fit = prepare.prepare_flows(raw, key_col=key)
    assert fit.kept is None
    before = folders(spark)
    monkeypatch.setattr(prepare, "HASH_FIRST_BYTES", 0)
    out, large = prepare.prepare_flows(raw, key_col=key)
    assert rows(out) == rows(cached)
    assert len(folders(spark) - before) == 2  # the prepared rows and the count tables; no step between
    new = flows(spark, 50)
    expected = rows(fit.transform(new))
    kept = stored(out)
    large.release()
    assert rows(kept) == rows(cached) and rows(large.transform(new)) == expected


def test_large_joins_shuffle_only_columns_that_are_read(spark):
    from flowguard.operators import graph
    from flowguard.schema import FlowSchema

    raw = flows(spark)
    g = graph.fit_graph(raw, FlowSchema.resolve(raw.columns))
    large = graph.apply_graph(raw, g, broadcast_rows=0, hot_rows=60).select("Flow ID", *g.feature_names)
    small = graph.apply_graph(raw, g).select("Flow ID", *g.feature_names)
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    last_join = [x for x in large._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in x]
    assert last_join
    # no raw host or port column is carried past the keys made of it
    projects = [x for x in large._jdf.queryExecution().optimizedPlan().toString().splitlines() if "__salt" in x and "Project" in x]
    assert projects and not any("Source IP#" in x.split(" AS __salt")[-1] for x in projects)


def test_small_tables_counts_are_not_shuffled_for_large_joins(spark):
    """The counts that are broadcast are joined after the shuffles, and columns stay in their order."""
    from flowguard.operators import graph
    from flowguard.schema import FlowSchema

    raw = flows(spark)
    g = graph.fit_graph(raw, FlowSchema.resolve(raw.columns))
    g.sizes = {n: 10**9 if n == "edge" else 1 for n in g.sizes}
    mixed = graph.apply_graph(raw, g, broadcast_rows=10)
    plan = [x for x in mixed._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    on = [x for x in plan if "__salt" in x]
    assert len(on) == 1 and plan.index(on[0]) > len(plan) - 3  # above it only the hot keys of its own table
    g.sizes = {n: 1 for n in g.sizes}
    small = graph.apply_graph(raw, g, broadcast_rows=10)
    assert sorted(mixed.columns) == sorted(small.columns) and mixed.columns[: len(raw.columns)] == small.columns[: len(raw.columns)]
    assert sorted(map(str, mixed.select(small.columns).collect())) == sorted(map(str, small.collect()))


def test_stored_tables_are_packed(spark):
    kept = stored(flows(spark))
    files = glob.glob(kept._flowguard_path.replace("file:", "") + "/*.parquet")
    assert files and all(".zstd." in f for f in files)
