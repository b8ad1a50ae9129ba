"""Detection metrics.

Curves and AUC work on the distinct-score table ``(score, pos, neg)``: one aggregate with
map-side combine, so a score shared by a third of all rows is one row. Running sums over
score order use :func:`cumulative_by_score`, a two-pass prefix sum over deterministic
order-preserving score buckets (bounded totals per bucket, then a window inside the bucket), never an
unpartitioned window over all scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.functions.columns import is_benign, label_text


def attach_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row DataFrame to every row (broadcast equi-join on a constant)."""
    return df.withColumn("__one", F.lit(1)).join(F.broadcast(one_row.withColumn("__one", F.lit(1))), "__one").drop("__one")


def _safe_div(num: Column, den: Column) -> Column:
    """zero_division=0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion_counts(df: DataFrame, y: str = "y", pred: str = "pred", group_cols=()) -> DataFrame:
    """Tn, fp, fn, tp with fixed labels [0, 1] (one row per group)."""
    yc, pc = F.col(y), F.col(pred)
    aggs = [
        F.count_if((yc == 0) & (pc == 0)).alias("tn"),
        F.count_if((yc == 0) & (pc == 1)).alias("fp"),
        F.count_if((yc == 1) & (pc == 0)).alias("fn"),
        F.count_if((yc == 1) & (pc == 1)).alias("tp"),
    ]
    g = df.groupBy(*group_cols) if group_cols else df.groupBy()
    return g.agg(*aggs)


def metric_columns(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Accuracy, precision, recall, F1 from confusion counts (zero_division=0)."""
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    return {
        "accuracy": _safe_div(tp + tn, tp + tn + fp + fn),
        "precision": precision,
        "recall": recall,
        "f1": f1,
    }


def classification_metrics(df: DataFrame, y: str = "y", pred: str = "pred", score: str | None = None,
                           model: str | None = None, group_cols=()) -> DataFrame:
    """One metric row (per group); ``roc_auc`` is null unless both classes are present."""
    cm = confusion_counts(df, y, pred, group_cols)
    m = metric_columns(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    out = cm.select(*group_cols, *[v.alias(k) for k, v in m.items()], "tn", "fp", "fn", "tp")
    if score is not None:
        auc = roc_auc(df, y, score, group_cols)
        out = out.join(auc, list(group_cols), "left") if group_cols else attach_one_row(out, auc)
    else:
        out = out.withColumn("roc_auc", F.lit(None).cast("double"))
    if model is not None:
        out = out.withColumn("model", F.lit(model))
    return out


def score_table(df: DataFrame, y: str = "y", score: str = "score", group_cols=()) -> DataFrame:
    """Distinct scores with their positive and negative row counts (rows without a score are
    left out)."""
    return df.where(F.col(score).isNotNull()).groupBy(*group_cols, F.col(score).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )


#: Buckets per binade. A DOUBLE has some 2,100 binades of either sign, so there are at most 270,000
#: buckets in all, and a few hundred for scores of one magnitude.
BUCKETS_PER_BINADE = 64
#: Distinct scores of a bucket that one running sum goes over; a fuller bucket is cut into cells.
BUCKET_SCORES = 200_000


def score_bucket(score: Column, sub: int = BUCKETS_PER_BINADE) -> Column:
    """Deterministic, order-preserving bucket of a score (log scale, ``sub`` per binade); +-inf and
    NaN get the outermost buckets."""
    from flowguard.operators.order_stats import value_bucket

    return value_bucket(score, sub)


def cumulative_by_score(table: DataFrame, sum_cols: list[str], descending: bool = True, group_cols=(), bucket_scores: int = BUCKET_SCORES) -> DataFrame:
    """Running sums of ``sum_cols`` over score order (inclusive), per group.

    One aggregate counts the distinct scores and sums of each bucket; a bucket follows from the score
    itself, so a recomputed partition (lost executor) lands in the same place. Buckets are bounded by
    the range of a DOUBLE (and the caller's groups), so their totals are summed on the driver and
    come back as a small table. Inside a bucket the running sum is a window. A bucket with more
    than ``bucket_scores`` distinct scores is cut into as many equal cells of its own range as keep to
    that number when scores are spread; the cells' sums are added up by a window over cells.
    """
    spark, groups = table.sparkSession, list(group_cols)
    t = table.withColumn("__b", score_bucket(F.col("score")))
    sums = [F.sum(c).alias(f"__s{i}") for i, c in enumerate(sum_cols)]
    found = t.groupBy(*groups, "__b").agg(F.count(F.lit(1)).alias("__d"), F.min("score").alias("__lo"), F.max("score").alias("__hi"), *sums).collect()
    ahead: dict[tuple, list[int]] = {}
    rows = []
    for r in sorted(found, key=lambda r: r["__b"], reverse=descending):
        key = tuple(r[g] for g in groups)
        before = ahead.setdefault(key, [0] * len(sum_cols))
        cells = -(-r["__d"] // bucket_scores)
        lo, hi = float(r["__lo"]), float(r["__hi"])
        rows.append((*key, r["__b"], cells if lo < hi else 1, lo, hi, *before))
        ahead[key] = [n + int(r[f"__s{i}"]) for i, n in enumerate(before)]
    schema = T.StructType(
        [T.StructField(f"__g{i}", table.schema[g].dataType) for i, g in enumerate(groups)]
        + [T.StructField("__at", T.LongType()), T.StructField("__cells", T.LongType()), T.StructField("__lo", T.DoubleType()), T.StructField("__hi", T.DoubleType())]
        + [T.StructField(f"__o{i}", T.LongType()) for i in range(len(sum_cols))]
    )
    buckets = spark.createDataFrame(rows, schema)  # Spark knows its size, and broadcasts it where it is small
    same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(groups)]
    order = F.col("score").desc() if descending else F.col("score").asc()
    whole = t.join(buckets, [F.col("__b") == F.col("__at"), *same])
    keys = [*groups, "__b"]
    offsets = [F.col(f"__o{i}") for i in range(len(sum_cols))]
    if any(r[len(groups) + 1] > 1 for r in rows):
        share = (F.col("score") - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))
        cell = F.when(F.col("__cells") > 1, F.least(F.col("__cells") - 1, F.floor(share * F.col("__cells")))).otherwise(0)
        whole = whole.withColumn("__cell", cell)
        cells = whole.groupBy(*keys, "__cell").agg(*sums)
        w = Window.partitionBy(*keys).orderBy(F.col("__cell").desc() if descending else F.col("__cell").asc()).rowsBetween(Window.unboundedPreceding, -1)
        names = {c: f"__k{i}" for i, c in enumerate([*keys, "__cell"])}
        cells = cells.select(*[F.col(c).alias(n) for c, n in names.items()], *[F.coalesce(F.sum(f"__s{i}").over(w), F.lit(0)).alias(f"__c{i}") for i in range(len(sum_cols))])
        whole = whole.join(cells, [F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()])
        keys.append("__cell")
        offsets = [o + F.col(f"__c{i}") for i, o in enumerate(offsets)]
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return whole.select(*table.columns, *[(F.sum(c).over(inside) + o).alias(f"cum_{c}") for c, o in zip(sum_cols, offsets, strict=True)])


def curve_table(df: DataFrame, y: str = "y", score: str = "score", group_cols=()) -> DataFrame:
    """W1 + W2 base: for each distinct threshold t, tp/fp of ``score >= t`` and the totals."""
    st = score_table(df, y, score, group_cols)
    cum = cumulative_by_score(st, ["pos", "neg"], descending=True, group_cols=group_cols)
    totals = st.groupBy(*group_cols).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    cum = cum.join(F.broadcast(totals), list(group_cols)) if group_cols else attach_one_row(cum, totals)
    return cum.select(
        *group_cols,
        F.col("score").alias("threshold"),
        F.col("cum_pos").alias("tp"),
        F.col("cum_neg").alias("fp"),
        "P", "N",
    )


def pr_curve(df: DataFrame, y: str = "y", score: str = "score", group_cols=()) -> DataFrame:
    """Precision and recall of ``score >= t`` for every distinct score t."""
    c = curve_table(df, y, score, group_cols)
    precision = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.col("P"))
    return c.select(*group_cols, "threshold", "tp", "fp", precision.alias("precision"), recall.alias("recall"))


def roc_curve(df: DataFrame, y: str = "y", score: str = "score", group_cols=()) -> DataFrame:
    """(fpr, tpr) for every distinct score, plus the (0, 0) start (threshold +inf)."""
    c = curve_table(df, y, score, group_cols)
    pts = c.select(
        *group_cols, "threshold",
        _safe_div(F.col("fp"), F.col("N")).alias("fpr"),
        _safe_div(F.col("tp"), F.col("P")).alias("tpr"),
    )
    start_src = c.select(*group_cols).distinct() if group_cols else df.sparkSession.range(1).select()
    start = start_src.select(*group_cols, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def roc_auc(df: DataFrame, y: str = "y", score: str = "score", group_cols=()) -> DataFrame:
    """Area under the ROC curve with ties counted half (Mann-Whitney).

    ``sum(pos * (neg below + neg tied / 2)) / (P * N)``; null when a class is absent.
    """
    st = score_table(df, y, score, group_cols)
    cum = cumulative_by_score(st, ["neg"], descending=False, group_cols=group_cols)
    part = cum.select(*group_cols, (F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)).alias("w"), "pos", "neg")
    agg = part.groupBy(*group_cols).agg(F.sum("w").alias("w"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0), F.col("w") / (F.col("P").cast("double") * F.col("N")))
    return agg.select(*group_cols, auc.alias("roc_auc"))


def score_quantiles(df: DataFrame, score: str, probs: list[float], group_cols=()) -> DataFrame:
    """Exact linear quantiles of the scores (numpy's default method)."""
    from flowguard.operators.order_stats import exact_quantiles

    return exact_quantiles(df, score, probs, group_cols)


def best_by_f1(metrics: DataFrame, order_col: str = "run_order") -> DataFrame:
    """The metric row with the highest F1; the earliest row wins a tie."""
    return metrics.orderBy(F.col("f1").desc_nulls_last(), F.col(order_col).asc()).limit(1)


def score_histogram(df: DataFrame, y: str = "y", score: str = "score", bins: int = 35) -> DataFrame:
    """Per class, ``bins`` equal bins over that class's own min..max (all bins listed).

    A class whose scores are all equal uses the range min-0.5 .. min+0.5, as numpy does.
    """
    rng = df.groupBy(F.col(y).alias("y")).agg(F.min(score).alias("lo0"), F.max(score).alias("hi0"))
    rng = rng.select(
        "y",
        F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
        F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"),
    )
    # One row per class: a bounded side table.
    j = df.select(F.col(y).alias("y"), F.col(score).alias("s")).join(F.broadcast(rng), "y")
    b = F.least(F.lit(bins - 1), F.floor((F.col("s") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins).cast("int"))
    counts = j.groupBy("y", b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select("y", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counts, ["y", "bin"], "left").select(
        "y", "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce(F.col("count"), F.lit(0)).alias("count"),
    )


def attack_type_metrics(df: DataFrame, label: str = "raw_label", y: str = "y", pred: str = "pred",
                        model: str | None = None, benign_values=None) -> DataFrame:
    """A22 + J10: each attack type against all benign rows.

    One grouped pass gives per-label prediction counts; the benign totals (one row) are
    crossed with every attack type. Blank labels are not a type.
    """
    lab = label_text(F.col(label))
    benign = is_benign(F.col(label)) if benign_values is None else is_benign(F.col(label), benign_values)
    per = df.groupBy(lab.alias("attack_type"), benign.alias("__benign")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(pred) == 1).alias("n_pos"),
        F.count_if(F.col(y) == 1).alias("n_y1"),
        F.count_if((F.col(y) == 1) & (F.col(pred) == 1)).alias("n_tp"),
        F.count_if((F.col(y) == 0) & (F.col(pred) == 1)).alias("n_fp"),
    )
    ben = per.where(F.col("__benign")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("benign_samples"),
        F.coalesce(F.sum("n_y1"), F.lit(0)).alias("b_y1"),
        F.coalesce(F.sum("n_tp"), F.lit(0)).alias("b_tp"),
        F.coalesce(F.sum("n_fp"), F.lit(0)).alias("b_fp"),
        F.coalesce(F.sum("n_pos"), F.lit(0)).alias("b_pos"),
    )
    att = per.where(~F.col("__benign") & (F.col("attack_type") != ""))
    j = attach_one_row(att, ben)
    tp = F.col("n_tp") + F.col("b_tp")
    fp = F.col("n_fp") + F.col("b_fp")
    pos = F.col("n_y1") + F.col("b_y1")
    total = F.col("n") + F.col("benign_samples")
    fn = pos - tp
    tn = total - pos - fp
    m = metric_columns(tn, fp, fn, tp)
    out = j.select(
        "attack_type",
        F.col("benign_samples").cast("long").alias("benign_samples"),
        F.col("n").alias("attack_samples"),
        *[v.alias(k) for k, v in m.items()],
    )
    if model is not None:
        out = out.withColumn("model", F.lit(model))
    return out.orderBy("attack_type")  # T4: attack types in sorted order (a few rows)


def label_distribution(df: DataFrame, split: str = "split", y: str = "y") -> DataFrame:
    """Rows per split and class."""
    return df.groupBy(split, y).agg(F.count(F.lit(1)).alias("count"))
