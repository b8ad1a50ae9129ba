import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowguard.llm import labelled, quality, toxicity
from flowguard.llm.queries import op5_quality, op6_toxicity

SF = "/root/testdata/sf0.01"


def rates(spark, result, column):
    got = result.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    y, s, p = (np.array([r[c] for r in got]) for c in (column, "score", "predicted"))
    order = s.argsort().argsort() + 1
    # ties count half
    ranks = np.array([np.mean(order[s == v]) for v in s])
    auc = (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / max((y == 1).sum() * (y == 0).sum(), 1)
    return auc, np.mean(p == y), len(y)


def test_held_out_accuracy_of_quality(spark):
    auc, right, n = rates(spark, op5_quality(spark, SF), "quality")
    assert n > 50 and auc > 0.97 and right > 0.95


def test_held_out_accuracy_of_toxicity(spark):
    auc, right, n = rates(spark, op6_toxicity(spark, SF), "toxic")
    assert n > 50 and auc > 0.95 and right > 0.95


def test_held_out_rule(spark):
    df = spark.createDataFrame([(i,) for i in [*range(50), -3, 10**15]], "doc_id long").select("doc_id", labelled.held_out().alias("h"))
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in df.collect())
    assert spark.createDataFrame([(None,)], "doc_id long").select(labelled.held_out().alias("h")).first().h is False


def test_convolution_gradient_and_chunks():
    texts = ["abc " * 100, "x", "", "Hello, wörld! " * 60]
    data, off = quality.text_buffer(pa.array(texts, pa.large_string()))
    begin, first = quality.chunk_rows(data, off)
    end = np.repeat(off[1:], np.diff(first))
    seen = np.zeros(len(data), bool)
    for b, e in zip(begin, end, strict=True):
        seen[b : min(b + quality.CHUNK, e)] = True
    assert seen.all() and np.diff(first).min() == 1
    x = quality.chunk_part(data, begin, end)
    net, y = quality.fresh(3), np.array([1.0, 0, 1, 0])
    _, g = quality.gradients(net, x, first, y)
    rng = np.random.default_rng(1)
    for name in quality.NAMES:
        p = getattr(net, name)
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in p.shape)
            old, vals = p[at], []
            for step in (1e-3, -1e-3):
                p[at] = old + step
                vals.append(quality.gradients(net, x, first, y)[0])
            p[at] = old
            assert (vals[0] - vals[1]) / 2e-3 == pytest.approx(getattr(g, name)[at], abs=2e-3, rel=0.1)


def test_features_and_trees():
    texts = pa.array(["You are a SCUM, really!", "s.c.u.m and sc0m", "", None, "plain words only", "a b c d"])
    w = toxicity.Words(pa.array(["scum"]), toxicity.ALNUM)
    f = toxicity.features_of(texts, w.hashes(), np.array([5.0]))
    name = {n: i for i, n in enumerate(toxicity.FEATURES)}
    assert f[0, name["strong_density"]] == pytest.approx(1 / 5) and f[0, name["near_second"]] == pytest.approx(1 / 5) and f[0, name["shouted"]] > 0
    assert f[1, name["masked"]] > 0 and f[1, name["masked_hits"]] > 0 and f[1, name["strong_density"]] == 0
    assert not f[2].any() and not f[3].any() and f[5, name["spaced"]] > 0
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    m = toxicity.boost(x[:600], y[:600], np.ones(600))
    assert np.mean((m.margin(x[600:]) > 0) == y[600:]) > 0.95
    s, p = toxicity.isotonic(np.array([1.0, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 1]), np.ones(5))
    assert list(p) == [0, 0.5, 1] and (np.diff(s) > 0).all()


@pytest.mark.parametrize("module, column", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_cases(spark, module, column):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "x"), (3, None), (4, "")], "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("y", F.lit(1)).withColumn("fold", F.lit("z"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], f"doc_id long, {column} int")
    for lab in (labels, labels.where("false")):
        got = module.classify(docs, lab).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert module.classify(docs.where("false"), labels).count() == 0


def test_clean_documents_keeps_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = toxicity.clean_documents(docs, labels)
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in op6_toxicity(spark, SF).where("predicted = 1").collect()}
    assert bad and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - bad
