import random
import re

import pytest
from pyspark.sql import functions as F

from flowguard.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for i, it in items:
            x = words(it)
            n = min(10, len(x))
            grams = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in grams:
                    hit.update(range(k, k + n))
                    found.add(str(i))
        out.append((d, len(w), len(hit), sorted(found)))
    return out


def test_matches_brute_force_on_planted_text(spark):
    rng = random.Random(3)
    voc = [f"w{i}" for i in range(30)] + ["É", "a-b", "x9"]
    line = lambda n: rng.choice([" ", "\n", ", "]).join(rng.choice(voc) for _ in range(n))
    items = [(i, line(rng.randint(0, 30))) for i in range(25)] + [(100, "w1 W2"), (101, "!!"), (102, None)]
    docs = []
    for d in range(80):
        t = line(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            t += " " + rng.choice(items[:25])[1] + "; " + line(4)
        docs.append((d, t))
    docs += [(200, None), (201, ""), (202, "w1   w2 w1 w2"), (202, "w1   w2 w1 w2")]
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit(1)).withColumn("block_key", F.lit("x"))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    got = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in decontam.contaminated(a, b).collect())
    assert got == sorted(brute(docs, items))


def test_query_blocks_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = sorted(map(str, decontam.contaminated(docs, items).collect()))
    monkeypatch.setattr(decontam, "QUERY_WINDOWS", 150)
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 20_000)
    assert sorted(map(str, decontam.contaminated(docs, items).collect())) == one
    assert any(r.n_hit for r in decontam.contaminated(docs, items).collect())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x b c d"), (2, "b a"), (3, "a x y z b c d"), (4, "a b c d")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c d")], "item_id long, text string")
    index = decontam.stored_index(docs)
    exact = {(r.doc_id, r.first_word, r.last_word) for r in decontam.phrase_matches(index, items).collect()}
    near = {(r.doc_id, r.first_word, r.last_word) for r in decontam.phrase_matches(index, items, slop=1).collect()}
    assert exact == {(4, 0, 3)} and near == {(1, 0, 4), (4, 0, 3)}
    with pytest.raises(ValueError):
        decontam.phrase_matches(index, items, slop=99)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "a b"), (5, None)], "item_id long, text string")
    assert [tuple(r) for r in decontam.contaminated(docs, items).collect()] == [(1, 2, 2, [])]
    assert [tuple(r) for r in decontam.contaminated(docs, items.where("false")).collect()] == [(1, 2, 0, [])]
    assert decontam.contaminated(docs.where("false"), items).count() == 0
