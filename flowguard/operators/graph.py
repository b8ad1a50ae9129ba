"""Host/port graph features.

Each flow row is a directed edge ``src -> dst``. Only degree-like counts are kept:

=========================  ==========================================
graph_src_out_count        rows per source host
graph_dst_in_count         rows per destination host
graph_edge_count           rows per (source, destination)
graph_src_unique_dst       distinct destinations per source
graph_dst_unique_src       distinct sources per destination
graph_dst_port_count       rows per destination port
graph_src_dst_port_count   rows per (source, destination port)
graph_src_port_count       rows per source port
=========================  ==========================================

Plan: one shuffle builds the edge table ``(src, dst, n)``; the source and destination
tables are roll-ups of it (``sum(n)`` = out/in count, ``count(*)`` = distinct neighbours), so
the three host counts share one exchange of the raw rows. Partial aggregation runs before
every shuffle, so a host that sends a third of all flows is a single partial row per map
task. Lookups are joined left with ``coalesce(n, 0)`` (an unseen key counts 0). The count
tables are measured when fitted: one under a row cap is broadcast; a larger one is
sort-merge joined with its hot keys (known exactly from the counts) broadcast and the flow
rows of those keys salted, so no hot key lands in a single task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.columns import key_text
from flowguard.schema import FlowSchema

K_SRC, K_DST, K_SPORT, K_DPORT = "__k_src", "__k_dst", "__k_sport", "__k_dport"


def with_graph_keys(df: DataFrame, schema: FlowSchema) -> DataFrame:
    """P10: text keys for the roles present."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = {}
    for key, role in ((K_SRC, schema.src_ip), (K_DST, schema.dst_ip), (K_SPORT, schema.src_port), (K_DPORT, schema.dst_port)):
        if role in types and key not in types:
            cols[key] = key_text(F.col(f"`{role}`"), types[role])
    return df.withColumns(cols) if cols else df


@dataclass
class GraphLookups:
    """Train-only count tables (the fitted graph state)."""

    schema: FlowSchema
    src: DataFrame | None = None        # (K_SRC, graph_src_out_count, graph_src_unique_dst)
    dst: DataFrame | None = None        # (K_DST, graph_dst_in_count, graph_dst_unique_src)
    edge: DataFrame | None = None       # (K_SRC, K_DST, graph_edge_count)
    dport: DataFrame | None = None      # (K_DPORT, graph_dst_port_count)
    src_dport: DataFrame | None = None  # (K_SRC, K_DPORT, graph_src_dst_port_count)
    sport: DataFrame | None = None      # (K_SPORT, graph_src_port_count)
    sizes: dict | None = None           # rows per table, measured when fitted
    stored: bool = False                # tables are stored in buckets of their keys

    @property
    def feature_names(self) -> list[str]:
        return self.schema.graph_feature_names

    @property
    def key_columns(self) -> list[str]:
        """All key columns that the lookups join on."""
        return sorted({k for _name, _table, keys, _values in self.tables() for k in keys})

    def tables(self) -> list[tuple[DataFrame, list[str], list[str]]]:
        """(lookup, join keys, value columns) in feature order."""
        out = []
        if self.src is not None:
            out.append(("src", self.src, [K_SRC], ["graph_src_out_count", "graph_src_unique_dst"]))
            out.append(("dst", self.dst, [K_DST], ["graph_dst_in_count", "graph_dst_unique_src"]))
            out.append(("edge", self.edge, [K_SRC, K_DST], ["graph_edge_count"]))
        if self.dport is not None:
            out.append(("dport", self.dport, [K_DPORT], ["graph_dst_port_count"]))
        if self.src_dport is not None:
            out.append(("src_dport", self.src_dport, [K_SRC, K_DPORT], ["graph_src_dst_port_count"]))
        if self.sport is not None:
            out.append(("sport", self.sport, [K_SPORT], ["graph_src_port_count"]))
        return out


def fit_graph(train: DataFrame, schema: FlowSchema, persist: str = "cache", count_sizes: bool = True) -> GraphLookups:
    """A1 + A2: count tables over the (training) rows.

    One grouping-sets aggregate (one shuffle, partial aggregation first) gives the edge,
    destination-port, (source, destination-port) and source-port counts; the host tables are
    roll-ups of the edge table (``sum`` = out/in count, ``count`` = distinct neighbours). The
    tables are the fitted state, so they are kept (``persist``) and their row counts recorded
    for the join strategy in :func:`apply_graph`.
    """
    from flowguard.session import materialize

    if not key_sets(schema):
        return GraphLookups(schema)
    return lookups_of_counts(materialize(key_counts(train, schema), persist), schema, count_sizes)


def key_sets(schema: FlowSchema) -> dict[str, list[str]]:
    """The keys that are counted, by name of their table; host tables follow from the edges."""
    sets = {}
    if schema.src_ip and schema.dst_ip:
        sets["edge"] = [K_SRC, K_DST]
    if schema.dst_port:
        sets["dport"] = [K_DPORT]
    if schema.src_ip and schema.dst_port:
        sets["src_dport"] = [K_SRC, K_DPORT]
    if schema.src_port:
        sets["sport"] = [K_SPORT]
    return sets


def key_counts(flows: DataFrame, schema: FlowSchema) -> DataFrame:
    """``(key columns, n, gid)``: rows per key of every set, one shuffle after partial counts."""
    sets = key_sets(schema)
    cols = sorted({c for st in sets.values() for c in st})
    k = with_graph_keys(flows, schema)
    return k.groupingSets([[F.col(c) for c in st] for st in sets.values()], *[F.col(c) for c in cols]).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")
    )


def lookups_of_counts(counts: DataFrame, schema: FlowSchema, count_sizes: bool = True) -> GraphLookups:
    """The lookup tables of a kept table of :func:`key_counts` (or of several, merged)."""
    g = GraphLookups(schema)
    sets = key_sets(schema)
    cols = sorted({c for st in sets.values() for c in st})

    def gid_of(st):
        return sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in st)

    parts = {nm: counts.where(F.col("gid") == gid_of(st)).select(*st, "n") for nm, st in sets.items()}
    if "edge" in parts:
        edge = parts["edge"].withColumnRenamed("n", "graph_edge_count")
        g.edge = edge
        g.src = edge.groupBy(K_SRC).agg(
            F.sum("graph_edge_count").alias("graph_src_out_count"),
            F.count(F.lit(1)).alias("graph_src_unique_dst"),
        )
        g.dst = edge.groupBy(K_DST).agg(
            F.sum("graph_edge_count").alias("graph_dst_in_count"),
            F.count(F.lit(1)).alias("graph_dst_unique_src"),
        )
    if "dport" in parts:
        g.dport = parts["dport"].withColumnRenamed("n", "graph_dst_port_count")
    if "src_dport" in parts:
        g.src_dport = parts["src_dport"].withColumnRenamed("n", "graph_src_dst_port_count")
    if "sport" in parts:
        g.sport = parts["sport"].withColumnRenamed("n", "graph_src_port_count")
    if count_sizes:
        # One job over the kept aggregate: exact rows per table, and for the host roll-ups an
        # HLL estimate with a 10% margin (never above the exact edge count, a hard bound).
        agg = counts.groupBy("gid").agg(
            F.count(F.lit(1)).alias("c"),
            *([F.approx_count_distinct(K_SRC, 0.02).alias("us"), F.approx_count_distinct(K_DST, 0.02).alias("ud")]
              if "edge" in parts else []),
        ).collect()
        by_gid = {r["gid"]: r for r in agg}
        g.sizes = {nm: int(by_gid[gid_of(st)]["c"]) if gid_of(st) in by_gid else 0 for nm, st in sets.items()}
        if "edge" in parts and gid_of(sets["edge"]) in by_gid:
            r = by_gid[gid_of(sets["edge"])]
            g.sizes["src"] = min(g.sizes["edge"], int(r["us"] * 1.1) + 1)
            g.sizes["dst"] = min(g.sizes["edge"], int(r["ud"] * 1.1) + 1)
    return g


def graph_key_columns(df: DataFrame) -> list[str]:
    return [c for c in (K_SRC, K_DST, K_SPORT, K_DPORT) if c in df.columns]


def _salted_left_join(k: DataFrame, table: DataFrame, keys: list[str], values: list[str], count_col: str,
                      hot_rows: int, salts: int, by: list[str]) -> DataFrame:
    """Left join of a large count table with hot keys split off.

    Keys whose count reaches ``hot_rows`` are at most ``train_rows / hot_rows`` rows (a proven
    bound), so they are broadcast. The other keys are sort-merge joined on ``(keys, salt)``:
    flow rows of a hot key get a salt in ``1..salts`` (they have no partner on that side and
    are spread over ``salts`` partitions instead of one), every other row salt 0. The salt is a hash
    of the columns ``by``, so that the others needn't be shuffled when nothing after the join reads them.
    """
    hot = table.where(F.col(count_col) >= hot_rows).select(*keys, *[F.col(v).alias(f"__hot_{v}") for v in values])
    cold = table.where(F.col(count_col) < hot_rows).withColumn("__salt", F.lit(0))
    k = k.join(F.broadcast(hot), keys, "left")
    is_hot = F.col(f"__hot_{values[0]}").isNotNull()
    salt = F.when(is_hot, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by]), F.lit(salts)) + 1).otherwise(F.lit(0))
    k = k.withColumn("__salt", salt).join(cold, [*keys, "__salt"], "left")
    k = k.withColumns({v: F.coalesce(F.col(f"__hot_{v}"), F.col(v)) for v in values})
    return k.drop("__salt", *[f"__hot_{v}" for v in values])


def _bucketed_left_join(k: DataFrame, table: DataFrame, keys: list[str], values: list[str], hot_rows: int, salts: int, by: list[str]) -> DataFrame:
    """Left join of a count table that is stored in buckets of its keys, which is read bucket by
    bucket and never shuffled.

    Hot keys are broadcast as in :func:`_salted_left_join`. The flow rows of a hot key get a key text
    that no table holds, one of ``salts``, so they are spread and meet nothing in the buckets.
    """
    hot = table.where(F.col(values[0]) >= hot_rows).select(*keys, *[F.col(v).alias(f"__hot_{v}") for v in values])
    cold = table.where(F.col(values[0]) < hot_rows).select(*[F.col(c).alias(f"__t{c}") for c in keys], *values)
    k = k.join(F.broadcast(hot), keys, "left")
    is_hot = F.col(f"__hot_{values[0]}").isNotNull()
    salt = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in by]), F.lit(salts)).cast("string"))
    k = k.withColumn("__j", F.when(is_hot, salt).otherwise(F.col(keys[0])))
    on = [F.col("__j") == F.col(f"__t{keys[0]}"), *[F.col(c) == F.col(f"__t{c}") for c in keys[1:]]]
    k = k.join(cold, on, "left").withColumns({v: F.coalesce(F.col(f"__hot_{v}"), F.col(v)) for v in values})
    return k.drop("__j", *[f"__t{c}" for c in keys], *[f"__hot_{v}" for v in values])


def store_lookups(g: GraphLookups, folder: str, buckets: int = 200) -> GraphLookups:
    """Write the fitted count tables below ``folder``, each as Parquet in ``buckets`` of its keys, and
    a manifest; the returned lookups read them.

    The folder must be one that all executors see. Choose ``buckets`` for the largest table, and not
    below ``spark.sql.shuffle.partitions``: a scoring run shuffles its rows into as many partitions.
    """
    import json

    spark = None
    told = {"schema": g.schema.__dict__, "buckets": buckets, "sizes": g.sizes or {}, "tables": []}
    for name, table, keys, values in g.tables():
        spark = table.sparkSession
        t = _bucket_table(f"{folder}/{name}")
        rows = table.select(*keys, *values).repartition(buckets, *keys)
        rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{folder}/{name}").format("parquet").saveAsTable(t)
        told["tables"].append({"name": name, "keys": keys, "values": values, "columns": rows.schema.simpleString()[len("struct<"):-1]})
    if spark is None:
        raise ValueError("no count table to store: the flows have no host or port columns")
    spark.createDataFrame([(json.dumps(told),)], "manifest string").coalesce(1).write.mode("overwrite").text(f"{folder}/_lookups")
    return load_lookups(spark, folder)


def load_lookups(spark, folder: str) -> GraphLookups:
    """Lookups over the tables that :func:`store_lookups` wrote, in this or an earlier session."""
    import json

    told = json.loads(spark.read.text(f"{folder}/_lookups").first()[0])
    g = GraphLookups(FlowSchema(**told["schema"]), sizes=told["sizes"], stored=True)
    for t in told["tables"]:
        name, by = _bucket_table(f"{folder}/{t['name']}"), ", ".join(f"`{k}`" for k in t["keys"])
        if not spark.catalog.tableExists(name):
            columns = ", ".join("`{}` {}".format(*c.split(":", 1)) for c in t["columns"].split(","))
            spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {told['buckets']} BUCKETS LOCATION '{folder}/{t['name']}'")
        setattr(g, t["name"], spark.table(name))
    return g


def _bucket_table(path: str) -> str:
    """The session's name for the table in a folder."""
    import hashlib

    return f"flowguard_counts_{hashlib.md5(path.encode()).hexdigest()[:16]}"


def apply_graph(
    df: DataFrame, lookups: GraphLookups, log1p: bool = True, row_key: str | None = None, broadcast_rows: int | None = None, hot_rows: int | None = None
) -> DataFrame:
    """J1-J8 + P12: left-join the count tables; unseen keys count 0; ``log1p`` of the counts.

    A table whose measured row count is at most ``flowguard.graph.broadcastMaxRows`` (default
    2,000,000) is broadcast, so the flow rows are not shuffled for it. A larger table is
    sort-merge joined with its hot keys (count >= ``flowguard.skew.hotRows``, default
    1,000,000 train rows) broadcast and the rest salted (:func:`_salted_left_join`), so a key
    holding a third of all flows does not end up in one task; tables stored by :func:`store_lookups`
    are joined in their buckets, without a shuffle of their own. ``broadcast_rows`` and ``hot_rows``
    stand in for the two settings. With a unique ``row_key`` and two
    or more large tables, those joins run on a narrow key table joined back once.
    """
    from flowguard.session import row_cap_for_broadcast

    spark = df.sparkSession
    cap = row_cap_for_broadcast(spark, "flowguard.graph.broadcastMaxRows", 2_000_000) if broadcast_rows is None else broadcast_rows
    hot_rows = row_cap_for_broadcast(spark, "flowguard.skew.hotRows", 1_000_000) if hot_rows is None else hot_rows
    salts = row_cap_for_broadcast(spark, "flowguard.skew.salts", 64)
    k = with_graph_keys(df, lookups.schema)
    sizes = lookups.sizes or {}

    # Key and role columns are read up to their own join only.
    roles = {lookups.schema.src_ip, lookups.schema.dst_ip, lookups.schema.src_port, lookups.schema.dst_port, K_SRC, K_DST, K_SPORT, K_DPORT}
    own = [c for c in df.columns if c not in roles] or list(df.columns)

    def large_join(rows: DataFrame, table: DataFrame, keys: list[str], values: list[str], by: list[str]) -> DataFrame:
        if lookups.stored:
            return _bucketed_left_join(rows, table, keys, values, hot_rows, salts, by)
        return _salted_left_join(rows, table, keys, values, values[0], hot_rows, salts, by)

    small = [t for t in lookups.tables() if sizes.get(t[0]) is not None and sizes[t[0]] <= cap]
    large = [t for t in lookups.tables() if t not in small]
    # The large tables come first, so that the small ones' counts aren't shuffled with the flow rows.
    order = [c for c in k.columns if c not in graph_key_columns(k)]
    if len(large) >= 2 and row_key:
        # Several large tables: join them on a narrow (row_key, keys) table, so the wide flow
        # rows are shuffled once (the join back on the unique row key) instead of per table.
        key_cols = sorted({c for _n, _t, ks, _v in large for c in ks})
        narrow = k.select(row_key, *key_cols)
        for _name, table, keys, values in large:
            narrow = large_join(narrow, table, keys, values, [row_key])
        vals = [v for _n, _t, _k, vs in large for v in vs]
        k = k.join(narrow.select(row_key, *vals), row_key, "left")
    else:
        for _name, table, keys, values in large:
            k = large_join(k, table, keys, values, own)
    for _name, table, keys, _values in small:
        k = k.join(F.broadcast(table), keys, "left")
    names = lookups.feature_names
    vals = {}
    for n in names:
        c = F.coalesce(F.col(n).cast("double"), F.lit(0.0))
        vals[n] = F.log1p(c) if log1p else c
    k = k.withColumns(vals)
    return k.select(*[F.col(f"`{c}`") for c in order], *[v for _n, _t, _k, vs in small + large for v in vs])


def in_sample_graph(df: DataFrame, schema: FlowSchema, log1p: bool = True) -> DataFrame:
    """Counts over the same table, added to every row (aggregate + join, not windows)."""
    return apply_graph(df, fit_graph(df, schema), log1p=log1p)
