import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import lm_score as x


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    return [w for w in low.split(" ") if w]


def brute(rows):
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 10 == 0
    c = collections.Counter()
    for d, t in rows:
        if not held(d):
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    return sorted((d or -1, held(d), len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words(t), None]), 6)) for d, t in rows)


def tuples(df):
    return sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect())


@pytest.fixture(scope="module")
def model(spark):
    return x.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_counts_and_base_equal_brute_force(spark, model):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = x.scored(df, model, block_bytes=60_000)
    assert tuples(got) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_held_out_texts_score_above_the_base(spark, model):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = x.scored(df, model).where("held_out").collect()
    assert len(rows) > 50 and all(r.score < 0 and math.isfinite(r.score) for r in rows)
    tokens = sum(r.n_tokens for r in rows)
    assert sum(r.score for r in rows) / tokens > sum(r.base_score for r in rows) / tokens


def test_windows_score_each_place_once():
    first = np.array([0, 1, 1 + 32, 33 + 33, 66 + 57, 123 + 500])
    ids = np.arange(1, first[-1] + 1)
    inputs, targets, place = x.windows_of(ids, first)
    scored = place[place >= 0]
    assert sorted(scored.tolist()) == list(range(first[-1]))
    rows, cols = np.nonzero(place >= 0)
    for r, c in zip(rows, cols):
        at = place[r, c]
        assert targets[r, c] == ids[at] and inputs[r, c] == (x.END if at in first else ids[at - 1])
        assert c >= x.CONTEXT or at < first[np.searchsorted(first, at, "right") - 1] + x.WINDOW


def test_later_windows_see_eight_ids_before_a_scored_one():
    """And leaving out the outputs of the context changes no score."""
    rng = np.random.default_rng(3)
    ids, first = rng.integers(0, 1024, 700), np.array([0, 10, 42, 75, 700])
    inputs, targets, place = x.windows_of(ids, first)
    rows, cols = np.nonzero(place >= 0)
    begin = first[np.searchsorted(first, place[rows, cols], "right") - 1]
    assert (cols >= np.minimum(place[rows, cols] - begin, 8)).all()
    form = x.scoring_form(x.fresh(1), 5)
    model = x.Model(type("V", (), {"start_classes": 5})(), x.fresh(1), None)
    logs, begins = x.token_logs(model, ids, first)
    a, b = x.window_probabilities(form, inputs, targets)
    assert np.allclose(logs[place[place >= 0]], a[place >= 0], atol=1e-5) and np.allclose(begins[place[place >= 0]], b[place >= 0], atol=1e-5)


def test_attention_is_causal_and_gradient_is_right():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in x.fresh(1).items()}
    ids, t = rng.integers(0, 1024, (3, x.WINDOW)), rng.integers(0, 1024, (3, x.WINDOW))
    w = rng.integers(0, 2, (3, x.WINDOW))
    form = x.scoring_form(p, 5)
    a, _ = x.window_probabilities(form, ids, t)
    other = ids.copy()
    other[:, 20:] = 7
    b, _ = x.window_probabilities(form, other, t)
    assert np.allclose(a[:, :20], b[:, :20], atol=1e-4) and not np.allclose(a[:, 20:], b[:, 20:])
    loss, g = x.gradients(p, ids, t, w)
    assert loss == pytest.approx(-(a * w).sum() / w.sum(), rel=1e-4)  # scoring and training agree
    for name in p:
        flat = p[name].reshape(-1)
        for at in np.argsort(-np.abs(g[name].reshape(-1)))[:3]:
            old, vals = flat[at], []
            for step in (1e-4, -1e-4):
                flat[at] = old + step
                vals.append(x.gradients(p, ids, t, w)[0])
            flat[at] = old
            assert (vals[0] - vals[1]) / 2e-4 == pytest.approx(g[name].reshape(-1)[at], rel=2e-2, abs=1e-4)


def test_probabilities_of_next_ids_and_words_add_up(model):
    v = model.vocabulary
    ids = np.zeros((1024, x.WINDOW), np.int64)
    ids[:, 1:4] = [40, 900, 300]
    t = np.zeros_like(ids)
    t[:, 3] = np.arange(1024)
    a, begin = x.window_probabilities(x.scoring_form(model.weights, v.start_classes), ids, t)
    p = np.exp(a[:, 3])
    assert p.sum() == pytest.approx(1, abs=1e-3)
    assert p[: v.start_classes * x.SIZE].sum() == pytest.approx(math.exp(begin[0, 3]), abs=1e-3)


def test_vocabulary_spells_anything(model):
    v = model.vocabulary
    some = ["the", "é", "日本", "a" * 300, "▁x", "\x00", "x y", "<s>", "<unk>"]
    ids, off = v.encode(some)
    start = v.start_classes * x.SIZE
    for k in range(len(some)):
        own = ids[off[k] : off[k + 1]]
        assert len(own) and 1 <= own[0] < start and (own[1:] >= start).all() and own.max() < 1024
    assert len({tuple(ids[off[k] : off[k + 1]]) for k in range(len(some))}) == len(some)


def test_edge_cases(spark, model):
    rows = [(1, "a b"), (1, "a b"), (None, "a"), (3, None), (4, ""), (5, "x" * 30000), (6, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("block", F.lit("x")).withColumn("held", F.lit(2))
    got = x.scored(df, model)
    assert tuples(got) == brute(rows)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got.collect())
    assert x.scored(df.where("false"), model).count() == 0
    none = x.scored(df.where("doc_id = 999 or doc_id = 4").withColumn("doc_id", F.lit(26).cast("long")), model).collect()
    assert len(none) == 1


def test_the_model_learns_from_every_text(spark, monkeypatch):
    """Two texts of 4.2 MB: a fit on 6 MB of text would leave one of them out."""
    monkeypatch.setattr(x, "STEPS", 10)
    ids = [d for d in range(1, 99) if zlib.crc32(str(d).encode()) % 10][:2]
    some = ["about", "или"]
    df = spark.createDataFrame([(d, (w + " ") * ((42 << 17) // 10 * 8 // len((w + " ").encode()))) for d, w in zip(ids, some)], "doc_id long, text string")
    vocabulary = x.fit(df).vocabulary
    _, off = vocabulary.encode(some)
    assert off.tolist() == [0, 1, 2]  # each word is an id of its own


def test_the_model_does_not_depend_on_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(x, "STEPS", 40)
    monkeypatch.setattr(x, "PART_BYTES", 100_000)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = x.fit(df.repartition(1)), x.fit(df.repartition(5))
    assert a.vocabulary.lists == b.vocabulary.lists and (a.centres == b.centres).all()
    assert all((a.weights[k] == b.weights[k]).all() for k in a.weights)
    assert not (a.weights["E"] == x.fresh()["E"]).all()


def test_stored_pieces_spell_the_same_ids(spark, model):
    sp, v = x.tokenizer_of(model.vocabulary.proto), model.vocabulary
    some = ["the", "é", "日本", "a" * 300, "▁x", "\x00", "<unk>"]
    flat, off = x.pieces_of(sp, some)
    flat[off[:-1]] |= 1 << 15
    ids, first = v.texts([flat.astype(np.uint16), np.zeros(0, np.uint16)])
    assert ids.tolist() == [*v.encode(some)[0].tolist(), x.END, x.END] and first.tolist() == [0, len(ids) - 1, len(ids)]
