"""Graph state kept by period and merged, so new flows don't mean counting old ones again.

The count tables of a period (a day, a batch of files) are sums, so tables of several periods merge by
adding counts of equal keys; distinct neighbours follow from the merged edges, exactly. A lookup over
any choice of periods is thus fitted from count tables, which are far smaller than flows.

Where edges are too many to keep, :func:`host_sketches` keeps a HyperLogLog sketch of the neighbours
per host instead. Sketches merge the same way; their estimates of distinct neighbours have a relative
standard error of :data:`SKETCH_ERROR`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.operators.graph import K_DST, K_SRC, GraphLookups, key_counts, key_sets, lookups_of_counts, with_graph_keys
from flowguard.schema import FlowSchema

#: log2 of a sketch's registers, and the relative standard error that follows.
SKETCH_LG = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LG / 2)


def merge_counts(tables: list[DataFrame]) -> DataFrame:
    """Count tables of several periods as one: counts of equal keys are added (null keys of a set that
    lacks a column are told apart by ``gid``)."""
    keys = [c for c in tables[0].columns if c != "n"]
    return reduce(DataFrame.unionByName, tables).groupBy(*keys).agg(F.sum("n").alias("n"))


def save_period(flows: DataFrame, schema: FlowSchema, folder: str, period: str) -> None:
    """Count a period's flows and write the counts below ``folder``; a period written again is
    replaced, so a batch that is run twice counts once."""
    if not key_sets(schema):
        raise ValueError("no host or port columns to count")
    key_counts(flows, schema).write.mode("overwrite").parquet(f"{folder}/period={period}")


def fit_periods(spark: SparkSession, schema: FlowSchema, folder: str, periods: list[str], persist: str = "cache") -> GraphLookups:
    """Lookups over the flows of the given periods, from their stored counts."""
    from flowguard.session import materialize

    if not periods:
        raise ValueError("no periods to fit")
    counts = merge_counts([spark.read.parquet(f"{folder}/period={p}") for p in periods])
    return lookups_of_counts(materialize(counts, persist), schema)


def host_sketches(flows: DataFrame, schema: FlowSchema) -> DataFrame:
    """``(role, host, rows, peers)``: rows per source and destination host, and a sketch of the hosts at
    the other end. One shuffle of partial sketches; a hot host is one row a task."""
    if not (schema.src_ip and schema.dst_ip):
        raise ValueError("both host columns are needed")
    k = with_graph_keys(flows, schema).select(K_SRC, K_DST)
    ends = F.inline(F.array(
        F.struct(F.lit("src").alias("role"), F.col(K_SRC).alias("host"), F.col(K_DST).alias("peer")),
        F.struct(F.lit("dst").alias("role"), F.col(K_DST).alias("host"), F.col(K_SRC).alias("peer")),
    ))
    return k.select(ends).groupBy("role", "host").agg(F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg("peer", F.lit(SKETCH_LG)).alias("peers"))


def merge_host_sketches(tables: list[DataFrame]) -> DataFrame:
    both = reduce(DataFrame.unionByName, tables).groupBy("role", "host")
    return both.agg(F.sum("rows").alias("rows"), F.hll_union_agg("peers").alias("peers"))


def host_degrees(sketches: DataFrame) -> DataFrame:
    """``(role, host, rows, distinct_peers)``, the last being an estimate."""
    return sketches.select("role", "host", "rows", F.hll_sketch_estimate("peers").alias("distinct_peers"))
