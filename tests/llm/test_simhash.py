import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from flowguard.llm import simhash


def brute_fingerprint(text):
    words = (text or "").encode().translate(bytes(simhash.np.r_[0:65, 97:123, 91:256].astype(np.uint8).tolist())).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    """rows: (doc_id, fp); smallest doc_id reachable over links of at most 3 bits."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return {(d, f): least.get(find(f)) for d, f in rows}


def test_fingerprints_equal_plain_hashing():
    rng = random.Random(1)
    texts = ["", None, "one", "Two  words", "\n\tA B\x0bc\x0cD ", "é ü ß " * 9, "x" * 500 + " yy " + "z" * 40, "a b c d"]
    texts += [" ".join("".join(rng.choice("abcDEé") for _ in range(rng.randint(1, 15))) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    got = simhash.fingerprints_of(pa.array(texts))
    assert [int(x) for x in got] == [brute_fingerprint(t) for t in texts]


def test_every_choice_of_thresholds_is_complete():
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 1 << 63, 3000, dtype=np.int64).astype(np.uint64)
    fp[:1500] &= np.uint64(0xFFFF)  # many share all high bits
    plan = simhash.Plan(np.unique(fp), len(fp))
    t = plan.allocate(fp)
    assert (t.sum(1) == 3 - plan.m + 1).all() and t.min() >= -1
    cost = np.stack([plan.expected(i, simhash.part_values(fp, p)) for i, p in enumerate(plan.parts)])
    chosen = sum(cost[i][np.arange(len(fp)), t[:, i] + 1] for i in range(plan.m))
    every = np.min([sum(cost[i][:, c[i] + 1] for i in range(plan.m)) for c in plan.choices], 0)
    assert np.allclose(chosen, every)


def test_links_and_components_match_brute_force(spark):
    rng = random.Random(5)
    rows, doc = [], 0
    for size in (1, 2, 40, 150):  # groups of prints a few bits apart, chains included
        base = rng.getrandbits(64)
        for _ in range(size):
            f = base
            for _ in range(rng.randint(0, 2)):
                f ^= 1 << rng.randrange(64)
            rows.append((doc, f))
            doc += 1
    base = rng.getrandbits(64)
    for i in range(12):  # a chain, three bits a step
        rows.append((doc, base))
        doc += 1
        for b in range(3):
            base ^= 1 << (3 * i + b)
    rows += [(doc + i, rng.getrandbits(64)) for i in range(200)]
    want = brute_components(rows)
    prints = spark.createDataFrame([(d, f - (1 << 64) if f >> 63 else f) for d, f in rows], "doc_id long, fp long")
    links = simhash.fingerprint_links(prints.select("fp").distinct())
    from flowguard.llm.common import components

    roots = {r.node: r.root for r in components(links).collect()}
    least = {}
    for r in prints.collect():
        c = roots.get(r.fp, r.fp)
        least[c] = min(least.get(c, r.doc_id), r.doc_id)
    for r in prints.collect():
        assert least[roots.get(r.fp, r.fp)] == want[(r.doc_id, r.fp % (1 << 64))]


def test_a_split_group_loses_no_component(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(9)
    base = rng.getrandbits(62)
    fps = sorted({base ^ (1 << rng.randrange(62)) ^ (1 << rng.randrange(62)) for _ in range(300)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    from flowguard.llm.common import components

    got = {r.node: r.root for r in components(simhash.fingerprint_links(df)).collect()}
    want = brute_components([(f, f) for f in fps])
    for f in fps:
        assert got.get(f, f) == want[(f, f)]


def test_edge_cases(spark):
    rows = [(1, "same text here ok"), (1, "same text here ok"), (None, "same text here ok"), (None, "nothing else like this at all"), (3, None), (4, ""), (5, "   \n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(9))
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id is not None) == [(1, 1), (1, 1), (3, 3), (4, 3), (5, 3)]
    assert sorted([r.component_id is None for r in got if r.doc_id is None]) == [False, True]
    assert simhash.near_duplicates(df.where("false")).count() == 0
    assert sorted(r.doc_id for r in simhash.unique_documents(df).collect() if r.doc_id is not None) == [1, 1, 3]


def test_table_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
    want = brute_components(rows)
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (f, want[(d, f)]) for d, f in rows}


def test_early_hashes_hold_the_first_rows(spark):
    from flowguard.llm.common import early_hashes

    df, h = spark.range(3000), F.xxhash64("id")
    few = early_hashes(df, h, 50, 3000)
    assert 60 < few.count() < 160
    assert few.orderBy(h).limit(50).collect() == df.orderBy(h).limit(50).collect()
    assert early_hashes(df, h, 50, 200).count() == 3000
