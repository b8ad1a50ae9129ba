"""Registered queries: one per operator of the inventory, over the driver's tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column names match the
SQL twin in ``oracle_queries.py``. Doubles are rounded to 6 decimals (and ``-0.0`` folded to
``0.0``) so that sums formed in another order compare equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.functions.columns import (
    binary_label,
    format_number4,
    label_text,
    mask_cell,
    predict,
    to_number,
)
from flowguard.operators import clean, graph, metrics, quality, split, threshold
from flowguard.plans.prepare import prepare_flows
from flowguard.schema import FlowSchema
from flowguard.session import materialize
from flowguard.sources.tables import (
    flows_events,
    flows_lineitem,
    scored_documents,
    scored_lineitem,
    table,
)

LINEITEM_FEATURES = ["Source Port", "Destination Port", "Quantity", "Extended Price", "Discount", "Tax", "Price Rate"]


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6) + F.lit(0.0)


def _round_all(df: DataFrame, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") if c in keep else r6(F.col(f"`{c}`")).alias(c) for c in df.columns])


def _labelled_lineitem(spark, sf_dir) -> DataFrame:
    return flows_lineitem(spark, sf_dir).withColumn("y", binary_label(F.col("Label")))


def _split_scored_lineitem(spark, sf_dir) -> DataFrame:
    s = materialize(scored_lineitem(spark, sf_dir))
    return split.stratified_split(s, "key", "y", 0.25, 42)


# ---------------------------------------------------------------- scans, projections
def q_p5_to_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    txt = (
        F.when(ln == 1, F.col("l_extendedprice").cast("string"))
        .when(ln == 2, F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")))
        .when(ln == 3, F.lit("Infinity"))
        .when(ln == 4, F.lit("-inf"))
        .when(ln == 5, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("d")))
        .when(ln == 6, F.lit("NaN"))
        .otherwise(F.lit("0x10"))
    )
    v = to_number(txt)
    return li.groupBy(ln.alias("l_linenumber")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(v).alias("n_numeric"),
        r6(F.coalesce(F.sum(v), F.lit(0.0))).alias("sum_value"),
    )


def _event_lines(spark, sf_dir):
    """The events as lines of a CSV file, with a quoted field; some lines have a field too many, some
    end early."""
    e = table(spark, sf_dir, "events")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(text("props"), F.lit('"'), F.lit('""')), F.lit('"'))
    whole = F.concat_ws(",", text("event_id"), text("user_id"), quoted, text("event_type"))
    line = F.when(F.col("event_id") % 97 == 0, F.concat(whole, F.lit(","))).when(F.col("event_id") % 89 == 0, text("event_id")).otherwise(whole)
    return e.select(line.alias("line"))


EVENT_LINE_COLUMNS = ["event_id", "user_id", "props", "event_type"]


def q_s2_csv_lines(spark, sf_dir):
    """Lines through the loader's parser: quoted fields, short lines filled up, long ones left out."""
    from flowguard.sources.csv import flow_rows, parse_lines

    parsed = parse_lines(_event_lines(spark, sf_dir), "line", len(EVENT_LINE_COLUMNS))
    return flow_rows(parsed, EVENT_LINE_COLUMNS, "skip")


def q_s2_quarantine(spark, sf_dir):
    """The lines that the loader leaves out."""
    from flowguard.sources.csv import has_more_fields

    return _event_lines(spark, sf_dir).where(has_more_fields(F.col("line"), len(EVENT_LINE_COLUMNS)))


def q_p8_binary_label(spark, sf_dir):
    f = flows_events(spark, sf_dir)
    return f.groupBy(label_text(F.col("Label")).alias("label_raw"), binary_label(F.col("Label")).alias("y")).agg(
        F.count(F.lit(1)).alias("n")
    )


def q_s4_head_per_group(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("k")
    )
    cap = split.rows_per_file(300, 3)
    return split.head_per_group(li, "l_returnflag", [F.md5(F.col("k"))], cap).select("l_returnflag", "k")


def q_s5_seeded_sample(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir)
    return split.seeded_sample(f, "Flow ID", 500, 42).select(F.col("Flow ID").alias("flow_id"), "Label")


def q_u1_union_by_name(spark, sf_dir):
    a = flows_lineitem(spark, sf_dir).select("Flow ID", "Source IP", "Destination IP", "Destination Port", "Quantity", "Label")
    b = flows_events(spark, sf_dir).select("Flow ID", "Source IP", "Destination IP", "Destination Port", "Value", "Label")
    u = a.withColumn("Destination Port", F.col("Destination Port").cast("string")).unionByName(b, allowMissingColumns=True)
    return u.groupBy("Label").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("Quantity").alias("n_quantity"),
        F.count("Value").alias("n_value"),
        F.count_distinct("Destination Port").alias("n_dst_ports"),
    )


def q_p20_mask_twin(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir)
    cols = ["Quantity", "Extended Price", "Discount", "Tax"]
    m = f.select(
        *[mask_cell(F.coalesce(F.col(c), F.lit(0.0)), 0.15, F.col("Flow ID"), F.lit(c), F.lit("42")).alias(c) for c in cols]
    )
    long = m.unpivot([], cols, "feature", "value")
    return long.groupBy("feature").agg(
        F.count_if(F.col("value") == 0).alias("n_zero"), r6(F.sum("value")).alias("sum_value")
    )


# ---------------------------------------------------------------- cleaning
def q_a3_dedup(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir).select("Source Port", "Destination Port", "Label")
    return clean.drop_duplicate_rows(f)


def _repeating_flows(spark, sf_dir):
    """All columns of the line-item flows; suppliers whose number ends in 7 sent theirs twice."""
    f = flows_lineitem(spark, sf_dir)
    return f.unionByName(f.where(F.col("Source IP").endswith("7")))


def q_a3_dedup_wide(spark, sf_dir):
    """Whole flows, told apart by row hashes first."""
    return _round_all(clean.drop_duplicate_rows(_repeating_flows(spark, sf_dir), hash_first=True), ["Flow ID", "Source IP", "Destination IP", "Source Port", "Destination Port", "Label"])


def q_a4_duplicate_rows_wide(spark, sf_dir):
    """Duplicates and label mix after dedup of whole flows, by row hashes first."""
    return quality.dedup_stats(_repeating_flows(spark, sf_dir), "Label", hash_first=True)


def q_a4_duplicate_rows(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir).select("Source Port", "Destination Port", "Label")
    return clean.duplicate_row_count(f)


def q_a5_medians(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir)
    num = materialize(clean.numeric_frame(f, LINEITEM_FEATURES))
    med = clean.column_medians(num, LINEITEM_FEATURES)
    rows = [(k, float(v)) for k, v in med.items()]
    return spark.createDataFrame(rows, "feature STRING, median DOUBLE").select("feature", r6("median").alias("median"))


def q_a6_moments(spark, sf_dir):
    num = materialize(clean.numeric_frame(flows_lineitem(spark, sf_dir), LINEITEM_FEATURES))
    n = clean.non_null_counts(num, LINEITEM_FEATURES)
    means, stds = clean.column_moments(num, LINEITEM_FEATURES)
    rows = [(c, int(n[c]), float(means[c]), float(stds[c])) for c in LINEITEM_FEATURES]
    out = spark.createDataFrame(rows, "feature STRING, n BIGINT, mean DOUBLE, std DOUBLE")
    return out.select("feature", "n", r6("mean").alias("mean"), r6("std").alias("std"))


def q_p7_usable_columns(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir).withColumn("Empty", F.lit(None).cast("string"))
    cols = LINEITEM_FEATURES + ["Empty"]
    num = clean.numeric_frame(f, cols)
    counts = clean.non_null_counts(num, cols)
    return spark.createDataFrame([(c, int(n), n > 0) for c, n in counts.items()], "feature STRING, non_null BIGINT, usable BOOLEAN")


def q_m20_prepare(spark, sf_dir):
    out, _fit = prepare_flows(flows_lineitem(spark, sf_dir), key_col="Flow ID")
    return _round_all(out, ["row_key", "split", "y", "label_raw"])


def text_flows(spark, sf_dir):
    """The line-item flows as a CSV reader brings them: all columns text, ports as ``7``, ``07`` and
    ``7.0``, and a session id above 2**53."""
    f = flows_lineitem(spark, sf_dir)
    f = f.select(*[F.col(c).cast("string").alias(c) for c in f.columns])
    kind, port = F.crc32("Flow ID") % 3, F.col("Destination Port")
    spelled = F.when(kind == 0, F.concat(port, F.lit(".0"))).when(kind == 1, F.concat(F.lit("0"), port)).otherwise(port)
    return f.withColumn("Destination Port", spelled)


def q_m20_prepare_text(spark, sf_dir):
    out, _fit = prepare_flows(text_flows(spark, sf_dir), key_col="Flow ID")
    return _round_all(out, ["row_key", "split", "y", "label_raw"])


def q_m20_transform_new_rows(spark, sf_dir):
    """Fit on the typed rows, transform the same rows as text and without a label."""
    _out, fit = prepare_flows(flows_lineitem(spark, sf_dir), key_col="Flow ID")
    fit.release()  # only the fitted state is read
    new = fit.transform(clean.drop_duplicate_rows(text_flows(spark, sf_dir).drop("Label")))
    return _round_all(new.drop("split", "y", "label_raw"), ["row_key"])


def q_a3_dedup_text_ids(spark, sf_dir):
    """Rows told apart by 64-bit ids in text, spelled with and without ``.0``."""
    li = table(spark, sf_dir, "lineitem")
    big = (F.lit(9007199254740992) + F.col("l_orderkey") % 64).cast("string")
    rows = li.select(F.when(F.col("l_linenumber") % 2 == 0, F.concat(big, F.lit(".0"))).otherwise(big).alias("id"), F.col("l_returnflag").alias("flag"))
    return clean.drop_duplicate_rows(clean.canonical_numbers(rows))


def q_m21_prepare_all(spark, sf_dir):
    out, _fit = prepare_flows(flows_events(spark, sf_dir), key_col="Flow ID", fit_scope="all")
    return _round_all(out, ["row_key", "split", "y", "label_raw"])


# ---------------------------------------------------------------- graph
def q_a1_edge_counts(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir)
    g = graph.fit_graph(f, FlowSchema.resolve(f.columns))
    return g.edge.select(F.col(graph.K_SRC).alias("src"), F.col(graph.K_DST).alias("dst"), F.col("graph_edge_count").alias("n"))


def q_a2_host_degrees(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir).select("Source IP", "Destination IP", "Label")  # hosts alone: ports aren't counted
    g = graph.fit_graph(f, FlowSchema.resolve(f.columns))
    s = g.src.select(F.lit("src").alias("role"), F.col(graph.K_SRC).alias("host"),
                     F.col("graph_src_out_count").alias("rows"), F.col("graph_src_unique_dst").alias("distinct_peers"))
    d = g.dst.select(F.lit("dst").alias("role"), F.col(graph.K_DST).alias("host"),
                     F.col("graph_dst_in_count").alias("rows"), F.col("graph_dst_unique_src").alias("distinct_peers"))
    return s.unionByName(d)


def _monthly_counts(spark, sf_dir):
    """Lookups over the line-item flows, from the stored counts of three parts of the year by ship month."""
    import uuid

    from flowguard.operators import graph_state
    from flowguard.session import ensure_checkpoint_dir

    f = flows_lineitem(spark, sf_dir).withColumn("month", F.substring(F.split("Flow ID", r"\|")[4], 6, 2))
    schema = FlowSchema.resolve(f.columns)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/periods-{uuid.uuid4().hex[:12]}"
    parts = {"q1": ["01", "02", "03"], "q2": ["04", "05", "06"], "rest": [f"{m:02d}" for m in range(7, 13)]}
    for name, months in parts.items():
        graph_state.save_period(f.where(F.col("month").isin(months)), schema, folder, name)
    return graph_state.fit_periods(spark, schema, folder, list(parts))


def q_a2_merged_periods(spark, sf_dir):
    """Host counts and distinct neighbours from merged count tables of three periods."""
    g = _monthly_counts(spark, sf_dir)
    s = g.src.select(F.lit("src").alias("role"), F.col(graph.K_SRC).alias("host"), F.col("graph_src_out_count").alias("rows"), F.col("graph_src_unique_dst").alias("distinct_peers"))
    d = g.dst.select(F.lit("dst").alias("role"), F.col(graph.K_DST).alias("host"), F.col("graph_dst_in_count").alias("rows"), F.col("graph_dst_unique_src").alias("distinct_peers"))
    return s.unionByName(d)


def q_a2_sketched_degrees(spark, sf_dir):
    """Rows per host, and whether the merged sketches' neighbour counts keep to five standard errors."""
    from flowguard.operators import graph_state

    f = flows_lineitem(spark, sf_dir)
    schema = FlowSchema.resolve(f.columns)
    halves = [graph_state.host_sketches(f.where(F.col("Source Port") % 2 == k), schema) for k in (0, 1)]
    got = graph_state.host_degrees(graph_state.merge_host_sketches(halves))
    exact = q_a2_host_degrees(spark, sf_dir).select("role", "host", F.col("distinct_peers").alias("exact"))
    near = F.abs(F.col("distinct_peers") - F.col("exact")) <= 5 * graph_state.SKETCH_ERROR * F.col("exact") + 0.5
    return got.join(exact, ["role", "host"]).select("role", "host", "rows", near.alias("within_error"))


def q_a1_port_counts(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir)
    g = graph.fit_graph(f, FlowSchema.resolve(f.columns))
    a = g.dport.select(F.lit("dst_port").alias("kind"), F.col(graph.K_DPORT).alias("key"), F.lit(None).cast("string").alias("src"), F.col("graph_dst_port_count").alias("n"))
    b = g.sport.select(F.lit("src_port").alias("kind"), F.col(graph.K_SPORT).alias("key"), F.lit(None).cast("string").alias("src"), F.col("graph_src_port_count").alias("n"))
    c = g.src_dport.select(F.lit("src_dst_port").alias("kind"), F.col(graph.K_DPORT).alias("key"), F.col(graph.K_SRC).alias("src"), F.col("graph_src_dst_port_count").alias("n"))
    return a.unionByName(b).unionByName(c)


def _lookup_columns(s: DataFrame, schema: FlowSchema) -> DataFrame:
    """What a lookup query reads of the split flows: no more than that is shuffled."""
    return s.select("Flow ID", "split", *[F.col(f"`{c}`") for c in (schema.src_ip, schema.dst_ip, schema.src_port, schema.dst_port) if c])


def q_j_graph_lookup(spark, sf_dir):
    f = _labelled_lineitem(spark, sf_dir)  # not kept: every pass reads a few columns of the table
    s = split.stratified_split(f, "Flow ID", "y", 0.25, 42)
    schema = FlowSchema.resolve(f.columns)
    g = graph.fit_graph(s.where(F.col("split") == "train"), schema)
    out = graph.apply_graph(_lookup_columns(s, schema), g)
    return out.select(F.col("Flow ID").alias("flow_id"), "split", *[r6(n).alias(n) for n in schema.graph_feature_names])


def _stored_lookups(spark, sf_dir):
    """Split flows, and the count tables of the training rows, written in buckets and read back."""
    import uuid

    from flowguard.session import ensure_checkpoint_dir

    f = _labelled_lineitem(spark, sf_dir)
    s = split.stratified_split(f, "Flow ID", "y", 0.25, 42)
    g = graph.fit_graph(s.where(F.col("split") == "train"), FlowSchema.resolve(f.columns))
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lookups-{uuid.uuid4().hex[:12]}"
    return s, graph.store_lookups(g, folder, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))


def q_j_graph_lookup_large(spark, sf_dir):
    """The lookups against stored, bucketed count tables, none of them broadcast; keys of 200 and more
    training rows are hot."""
    s, g = _stored_lookups(spark, sf_dir)
    out = graph.apply_graph(_lookup_columns(s, g.schema), g, broadcast_rows=0, hot_rows=200)
    return out.select(F.col("Flow ID").alias("flow_id"), "split", *[r6(n).alias(n) for n in g.feature_names])


def q_w3_in_sample_graph(spark, sf_dir):
    f = flows_events(spark, sf_dir)
    schema = FlowSchema.resolve(f.columns)
    out = graph.in_sample_graph(f, schema)
    return out.select(F.col("Flow ID").alias("flow_id"), *[r6(n).alias(n) for n in schema.graph_feature_names])


# ---------------------------------------------------------------- split
def q_w4_split(spark, sf_dir):
    f = materialize(_labelled_lineitem(spark, sf_dir).select("Flow ID", "y"))
    s = split.stratified_split(f, "Flow ID", "y", 0.25, 42)
    return s.select(F.col("Flow ID").alias("flow_id"), "y", "split")


def q_w4_split_repeated_keys(spark, sf_dir):
    """Keys that repeat (order numbers, null for a third of the rows): exact shares all the same."""
    f = materialize(_labelled_lineitem_keys(spark, sf_dir))
    s = split.stratified_split(f, "k", "y", 0.25, 42)
    rows = s.groupBy("y", "split").agg(F.count(F.lit(1)).alias("n"))
    return rows


def _labelled_lineitem_keys(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_linenumber") % 3 != 0, (F.col("l_orderkey") % 50).cast("string"))
    return li.select(key.alias("k"), "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "N", 0).otherwise(1).alias("y"))


def q_w5_fit_valid_split(spark, sf_dir):
    f = materialize(_labelled_lineitem(spark, sf_dir).select("Flow ID", "y"))
    s = split.stratified_split(f, "Flow ID", "y", 0.25, 42)
    train = materialize(s.where(F.col("split") == "train"))
    v = split.fit_validation_split(train, "Flow ID", "y", 0.2, 42)
    return v.select(F.col("Flow ID").alias("flow_id"), "y", "fit_split")


# ---------------------------------------------------------------- quality
def q_a8_raw_label_counts(spark, sf_dir):
    s = _split_scored_lineitem(spark, sf_dir)
    return quality.raw_label_counts(s, "raw_label", ["split"])


def q_a9_top_values(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return quality.top_counts(ev, F.col("user_id"), 10, "value")


def q_a9_top_words(spark, sf_dir):
    """The most frequent words of all documents, found by a bounded summary and counted exactly."""
    docs = table(spark, sf_dir, "documents")
    words = docs.select(F.explode(F.split("text", r"[\x20\x09-\x0D]+")).alias("w")).where("w != ''")
    return quality.top_counts(words, F.col("w"), 25, "word", summary_first=True)


def q_a10_cell_stats(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir)
    c = quality.cell_stats(f, "Label")
    n_cols = len(f.columns)
    return c.select(
        "raw_rows", "missing_cells", "infinite_cells", r6("binary_attack_ratio").alias("binary_attack_ratio"),
        r6(F.col("missing_cells") / (F.col("raw_rows") * n_cols)).alias("missing_value_ratio"),
    )


def q_a15_inspection(spark, sf_dir):
    rep = quality.inspect_flows(flows_lineitem(spark, sf_dir), data_source="files")
    return rep.select(
        "raw_rows", "raw_columns", "duplicate_rows", "label_column", "attack_type_count", "attack_type_count_exact",
        "benign_samples", "attack_samples", r6("binary_attack_ratio").alias("binary_attack_ratio"), "missing_cells",
        r6("missing_value_ratio").alias("missing_value_ratio"), "infinite_cells", "feature_count_after_preprocess",
        "graph_feature_count",
    )


def q_p26_recommendations(spark, sf_dir):
    f = flows_events(spark, sf_dir).select("Source IP", "Destination IP", "Label")
    rep = quality.inspect_flows(f, data_source="files")
    return rep.select(F.concat_ws(",", "recommendation_codes").alias("codes"), "attack_type_count", "feature_count_after_preprocess")


def q_a14_dataset_summary(spark, sf_dir):
    from flowguard.plans.experiment import dataset_summary

    out, fit = prepare_flows(flows_lineitem(spark, sf_dir), key_col="Flow ID")
    pairs = F.transform(F.array_sort(F.map_entries("attack_type_summary")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return dataset_summary(out, fit).select(
        "split", "samples", F.col("BENIGN").alias("benign"), F.col("Attack").alias("attack"),
        F.size("attack_type_summary").cast("long").alias("label_kinds"), F.array_join(pairs, ",").alias("labels"),
        F.col("feature_count").cast("long").alias("feature_count"), F.col("graph_feature_count").cast("long").alias("graph_feature_count"),
    )


def q_a7_label_summary(spark, sf_dir):
    f = flows_events(spark, sf_dir).withColumn("y", binary_label(F.col("Label")))
    return quality.label_summary(f)


def q_a13_attack_labels(spark, sf_dir):
    f = flows_lineitem(spark, sf_dir)
    att = f.where(binary_label(F.col("Label")) == 1)
    top = quality.top_counts(att, F.col("Label"), quality.TOP_K_ATTACK_LABELS, "label")
    exact = att.agg(F.count_distinct(label_text(F.col("Label"))).alias("attack_type_count_exact"))
    return metrics.attach_one_row(top, exact)


def q_a12_attack_ratio(spark, sf_dir):
    f = flows_events(spark, sf_dir)
    return f.agg(r6(F.avg(binary_label(F.col("Label")))).alias("binary_attack_ratio"))


def q_p22_p23_formats(spark, sf_dir):
    from flowguard.functions.columns import safe_name

    s = scored_lineitem(spark, sf_dir).withColumn("pred", predict("score", CUT))
    m = metrics.confusion_counts(s, group_cols=["raw_label"])
    mc = metrics.metric_columns(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    name = F.concat(F.col("raw_label"), F.lit(" Model/v1"))
    return m.select(
        safe_name(name).alias("file_tag"),
        *[format_number4(v).alias(k) for k, v in mc.items()],
    )


def q_c1_label_distribution(spark, sf_dir):
    s = _split_scored_lineitem(spark, sf_dir)
    return metrics.label_distribution(s)


# ---------------------------------------------------------------- metrics
CUT = 50000.0


def q_a16_confusion(spark, sf_dir):
    s = scored_lineitem(spark, sf_dir).withColumn("pred", predict("score", CUT))
    return metrics.confusion_counts(s)


def q_a17_metrics(spark, sf_dir):
    s = scored_lineitem(spark, sf_dir).withColumn("pred", predict("score", CUT))
    m = metrics.classification_metrics(s, score="score", model="price_cut")
    return _round_all(m.select("model", "accuracy", "precision", "recall", "f1", "roc_auc"), ["model"])


def q_a18_roc_auc(spark, sf_dir):
    a = metrics.roc_auc(scored_documents(spark, sf_dir)).select(F.lit("documents").alias("dataset"), r6("roc_auc").alias("roc_auc"))
    b = metrics.roc_auc(scored_lineitem(spark, sf_dir)).select(F.lit("lineitem").alias("dataset"), r6("roc_auc").alias("roc_auc"))
    return a.unionByName(b)


def q_a19_quantiles(spark, sf_dir):
    s = scored_lineitem(spark, sf_dir)
    q = metrics.score_quantiles(s, "score", [0.95, 0.99], ["y"])
    return q.select("y", "q", r6("value").alias("value"))


def q_a21_histogram(spark, sf_dir):
    h = metrics.score_histogram(scored_documents(spark, sf_dir))
    return h.select("y", "bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "count")


def q_a22_attack_types(spark, sf_dir):
    s = scored_lineitem(spark, sf_dir).withColumn("pred", predict("score", CUT))
    m = metrics.attack_type_metrics(s, "raw_label", "y", "pred")
    return _round_all(m, ["attack_type", "benign_samples", "attack_samples"])


def _score_models(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    cols = [("quantity", "l_quantity"), ("price", "l_extendedprice"), ("discount", "l_discount"), ("tax", "l_tax")]
    y = F.when(F.col("l_returnflag") == "N", 0).otherwise(1)
    parts = []
    for i, (name, c) in enumerate(cols):
        means = li.agg(F.avg(c).alias("__m"))
        scored = metrics.attach_one_row(li.select(y.alias("y"), F.col(c).alias("score")), means)
        scored = scored.withColumn("pred", predict("score", F.col("__m")))
        cm = metrics.confusion_counts(scored)
        mc = metrics.metric_columns(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
        parts.append(cm.select(F.lit(name).alias("model"), F.lit(i).alias("run_order"), *[v.alias(k) for k, v in mc.items()]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_a20_best_model(spark, sf_dir):
    m = _score_models(spark, sf_dir)
    best = metrics.best_by_f1(m)
    return best.select("model", "run_order", r6("f1").alias("f1"), format_number4(F.col("f1")).alias("f1_text"))


def q_m18_model_comparison(spark, sf_dir):
    from flowguard.plans.experiment import report_table

    m = _score_models(spark, sf_dir).withColumn("roc_auc", F.lit(None).cast("double"))
    text = report_table(m).select("model", F.col("precision").alias("precision_text"))
    return m.select("model", r6("recall").alias("recall"), r6("f1").alias("f1")).join(text, "model")


def q_w1_pr_curve(spark, sf_dir):
    c = metrics.pr_curve(scored_documents(spark, sf_dir))
    return c.select(r6("threshold").alias("threshold"), "tp", "fp", r6("precision").alias("precision"), r6("recall").alias("recall"))


def q_w1_pr_curve_lineitem(spark, sf_dir):
    c = metrics.pr_curve(scored_lineitem(spark, sf_dir))
    return c.select(r6("threshold").alias("threshold"), "tp", "fp", r6("precision").alias("precision"), r6("recall").alias("recall"))


def q_w2_roc_curve(spark, sf_dir):
    c = metrics.roc_curve(scored_documents(spark, sf_dir))
    return c.select(F.col("threshold"), r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


def q_w2_roc_chart(spark, sf_dir):
    """The drawn curve of 60,000 and more scores: its size, and its area against the whole curve's."""
    from flowguard.operators import chart_curves

    s, cells = scored_lineitem(spark, sf_dir), 200
    small = chart_curves.chart_area(chart_curves.roc_chart(s, cells=cells))
    both = metrics.attach_one_row(small, metrics.roc_auc(s))
    return both.select(
        (F.col("points") <= 2 * cells + 1).alias("bounded"), (F.abs(F.col("area") - F.col("roc_auc")) < 1.0 / cells).alias("close"), r6("roc_auc").alias("roc_auc")
    )


# ---------------------------------------------------------------- thresholds
def _valid_test(spark, sf_dir):
    s = materialize(_split_scored_lineitem(spark, sf_dir))
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


def q_m10_orient(spark, sf_dir):
    d = materialize(scored_documents(spark, sf_dir))
    s = split.stratified_split(d, "key", "y", 0.25, 42)
    valid = s.where(F.col("split") == "train").withColumn("score", -F.col("score"))
    inverted, auc = threshold.orient_scores(valid)
    oriented = threshold.apply_orientation(valid, inverted)
    auc2 = metrics.roc_auc(oriented).collect()[0]["roc_auc"]
    return spark.createDataFrame(
        [(threshold.direction_name(inverted), float(auc), float(auc2))],
        "score_direction STRING, raw_validation_roc_auc DOUBLE, oriented_roc_auc DOUBLE",
    ).select("score_direction", r6("raw_validation_roc_auc").alias("raw_validation_roc_auc"), r6("oriented_roc_auc").alias("oriented_roc_auc"))


def q_m11_m13_thresholds(spark, sf_dir):
    valid, _test = _valid_test(spark, sf_dir)
    rows = threshold.strategy_thresholds(valid, "y", "score", 0.9)
    return spark.createDataFrame([(n, float(t)) for n, t in rows], "strategy STRING, threshold DOUBLE").select(
        "strategy", r6("threshold").alias("threshold")
    )


def q_m14_threshold_analysis(spark, sf_dir):
    valid, test = _valid_test(spark, sf_dir)
    t = threshold.threshold_analysis(valid, test, "price_score")
    return _round_all(t, ["model", "strategy_order", "strategy", "tn", "fp", "fn", "tp"])


# ---------------------------------------------------------------- learned models (rows-only checks)
def _prepared(spark, sf_dir, source=flows_lineitem):
    out, fit = prepare_flows(source(spark, sf_dir), key_col="Flow ID")
    return _kept_instead(out, fit), fit


def _kept_instead(out: DataFrame, fit) -> DataFrame:
    """A prepared table, kept; a large one is stored in place of the rows that it was made of."""
    kept = materialize(out, "cache" if fit.kept is None else "store")
    fit.release()
    return kept


def q_m1_random_forest(spark, sf_dir):
    from flowguard.operators import models

    prep, fit = _prepared(spark, sf_dir, flows_events)
    return models.train_random_forest(prep, fit.feature_names).metrics


def q_t1_feature_importance(spark, sf_dir):
    from flowguard.operators import models

    prep, fit = _prepared(spark, sf_dir, flows_events)
    return models.top_importances(models.train_random_forest(prep, fit.feature_names).importances)


def q_m2_mlp(spark, sf_dir):
    from flowguard.operators import models

    prep, fit = _prepared(spark, sf_dir, flows_events)
    return models.train_mlp(prep, fit.feature_names).metrics


def _metric_frame(spark, m: dict) -> DataFrame:
    from flowguard.plans.experiment import METRIC_SCHEMA, metric_row

    return spark.createDataFrame([metric_row(m, "main", 0)], METRIC_SCHEMA)


def q_m6_vanilla_autoencoder(spark, sf_dir):
    from flowguard.plans.experiment import run_vanilla_autoencoder

    prep, fit = _prepared(spark, sf_dir)
    return _metric_frame(spark, run_vanilla_autoencoder(prep, fit.feature_names, epochs=10, tables=False).metrics)


def q_m6_embeddings_autoencoder(spark, sf_dir):
    """Vanilla autoencoder on the 64-wide embedding vectors (label 0 is the attack class)."""
    from flowguard.plans.experiment import run_vanilla_autoencoder
    from flowguard.sources.tables import embedding_flows

    out, fit = prepare_flows(embedding_flows(spark, sf_dir), key_col="Flow ID")
    prep = materialize(out)
    return _metric_frame(spark, run_vanilla_autoencoder(prep, fit.feature_names, epochs=10, tables=False).metrics)


def q_m5_masked_transformer_autoencoder(spark, sf_dir):
    from flowguard.plans.experiment import run_transformer_autoencoder

    prep, fit = _prepared(spark, sf_dir, flows_events)
    res = run_transformer_autoencoder(prep, fit.feature_names, mask_ratio=0.15, epochs=10, tables=False)
    return _metric_frame(spark, res.metrics)


def q_m16_mask_ratio_ablation(spark, sf_dir):
    from flowguard.plans.experiment import mask_ratio_ablation

    prep, fit = _prepared(spark, sf_dir, flows_events)
    return mask_ratio_ablation(prep, fit.feature_names, "0,0.15,0.3,0.45", epochs=6)


def q_m7_linear_reconstruction(spark, sf_dir):
    from flowguard.operators.autoenc import linear_reconstruction_score

    out, fit = prepare_flows(flows_lineitem(spark, sf_dir), key_col="Flow ID")
    p = _kept_instead(_round_all(out, ["row_key", "split", "y", "label_raw"]), fit)
    feats = [c for c in p.columns if c not in ("row_key", "split", "y", "label_raw")]
    ben = p.where((F.col("split") == "train") & (F.col("y") == 0))
    row = ben.agg(*[F.avg(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(feats)]).collect()[0]
    centre = {c: row[f"c{i}"] for i, c in enumerate(feats)}
    return linear_reconstruction_score(p, feats, centre).select("row_key", "split", "y", r6("score").alias("score"))


REGISTRY = {
    "p5_to_number": q_p5_to_number,
    "s2_csv_lines": q_s2_csv_lines,
    "s2_quarantine": q_s2_quarantine,
    "p8_binary_label": q_p8_binary_label,
    "s4_head_per_group": q_s4_head_per_group,
    "s5_seeded_sample": q_s5_seeded_sample,
    "u1_union_by_name": q_u1_union_by_name,
    "p20_mask_twin": q_p20_mask_twin,
    "a3_dedup": q_a3_dedup,
    "a3_dedup_text_ids": q_a3_dedup_text_ids,
    "a4_duplicate_rows": q_a4_duplicate_rows,
    "a3_dedup_wide": q_a3_dedup_wide,
    "a4_duplicate_rows_wide": q_a4_duplicate_rows_wide,
    "a5_medians": q_a5_medians,
    "a6_moments": q_a6_moments,
    "p7_usable_columns": q_p7_usable_columns,
    "m20_prepare": q_m20_prepare,
    "m20_prepare_text": q_m20_prepare_text,
    "m20_transform_new_rows": q_m20_transform_new_rows,
    "m21_prepare_all": q_m21_prepare_all,
    "a1_edge_counts": q_a1_edge_counts,
    "a2_host_degrees": q_a2_host_degrees,
    "a2_merged_periods": q_a2_merged_periods,
    "a2_sketched_degrees": q_a2_sketched_degrees,
    "a1_port_counts": q_a1_port_counts,
    "j_graph_lookup": q_j_graph_lookup,
    "j_graph_lookup_large": q_j_graph_lookup_large,
    "w3_in_sample_graph": q_w3_in_sample_graph,
    "w4_stratified_split": q_w4_split,
    "w4_split_repeated_keys": q_w4_split_repeated_keys,
    "w5_fit_valid_split": q_w5_fit_valid_split,
    "a8_raw_label_counts": q_a8_raw_label_counts,
    "a9_top_values": q_a9_top_values,
    "a9_top_words": q_a9_top_words,
    "a10_cell_stats": q_a10_cell_stats,
    "a15_inspection": q_a15_inspection,
    "p26_recommendations": q_p26_recommendations,
    "a14_dataset_summary": q_a14_dataset_summary,
    "c1_label_distribution": q_c1_label_distribution,
    "a7_label_summary": q_a7_label_summary,
    "a13_attack_labels": q_a13_attack_labels,
    "a12_attack_ratio": q_a12_attack_ratio,
    "p22_p23_formats": q_p22_p23_formats,
    "a16_confusion": q_a16_confusion,
    "a17_metrics": q_a17_metrics,
    "a18_roc_auc": q_a18_roc_auc,
    "a19_quantiles": q_a19_quantiles,
    "a21_histogram": q_a21_histogram,
    "a22_attack_types": q_a22_attack_types,
    "a20_best_model": q_a20_best_model,
    "m18_model_comparison": q_m18_model_comparison,
    "w1_pr_curve": q_w1_pr_curve,
    "w1_pr_curve_lineitem": q_w1_pr_curve_lineitem,
    "w2_roc_curve": q_w2_roc_curve,
    "w2_roc_chart": q_w2_roc_chart,
    "m10_orient": q_m10_orient,
    "m11_m13_thresholds": q_m11_m13_thresholds,
    "m14_threshold_analysis": q_m14_threshold_analysis,
    "m7_linear_reconstruction": q_m7_linear_reconstruction,
    "m1_random_forest": q_m1_random_forest,
    "t1_feature_importance": q_t1_feature_importance,
    "m2_mlp": q_m2_mlp,
    "m6_vanilla_autoencoder": q_m6_vanilla_autoencoder,
    "m6_embeddings_autoencoder": q_m6_embeddings_autoencoder,
    "m5_masked_transformer_autoencoder": q_m5_masked_transformer_autoencoder,
    "m16_mask_ratio_ablation": q_m16_mask_ratio_ablation,
}
