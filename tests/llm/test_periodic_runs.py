"""Periodic runs against plain loops, and defined results for odd inputs."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from flowguard.llm import periodic_runs as P
from flowguard.llm import queries as Q


def plain_runs(w):
    """Every stretch of every period, by walking the words."""
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i - s + p >= max(12, 2 * p):
                out.setdefault((s, i - s + p), p)
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda x: (x[0], x[2]))


def plain_collapsed(w, runs):
    return [x for i, x in enumerate(w) if not any(s + p <= i < s + n for s, n, p in runs)]


def odd_words(rng, most=160):
    n = rng.randint(0, most)
    w = [rng.randrange(rng.choice([1, 2, 3, 60])) for _ in range(n)]
    if n and rng.random() < 0.7:
        a, p = rng.randrange(n), rng.randint(1, n)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_random_words(seed):
    rng = random.Random(seed)
    for _ in range(60):
        docs = [odd_words(rng) for _ in range(rng.randint(0, 5))]
        got = P.runs_of([np.array(w, np.int64) for w in docs])
        for w, g in zip(docs, got, strict=True):
            assert [tuple(x) for x in g.tolist()] == plain_runs(w)
            assert [w[i] for i in np.flatnonzero(P.kept_words(len(w), g))] == plain_collapsed(w, plain_runs(w))


def test_extensions_are_exact():
    rng = np.random.RandomState(3)
    words = [rng.randint(0, 2, 400), np.tile(rng.randint(0, 9, 17), 20), rng.randint(0, 2, 5)]
    t, doc, first = P.laid_out(words, 9)
    index = P.Extensions(t, doc)
    for f, w in zip(first, words, strict=True):
        i, j = rng.randint(0, len(w), (2, 300))
        i, j = i[i != j] + f, j[i != j] + f
        want = []
        for a, b in zip(i, j, strict=True):
            k = 0
            while t[a + k] == t[b + k]:
                k += 1
            want.append(k)
        assert index.words(i, j).tolist() == want


def test_one_long_text():
    """A hundred thousand words: a tail of long period, and one word alone."""
    rng = np.random.RandomState(0)
    w = rng.randint(0, 5000, 100_000)
    w[40_000:] = np.resize(w[40_000:47_000], 60_000)
    start = 40_000
    while w[start - 1] == w[start + 6_999]:
        start -= 1
    assert [tuple(x) for x in P.runs_of([w])[0].tolist()] == [(start, 100_000 - start, 7_000)]
    assert P.runs_of([np.zeros(100_000, np.int64)])[0].tolist() == [[0, 100_000, 1]]


SCHEMA = "other string, doc_id long, text string, runs string, n_words int"


def test_odd_rows(spark):
    rows = [
        ("a", 1, None, "x", 1),
        ("a", 2, "", "x", 1),
        ("a", 3, " \t\n ", "x", 1),
        ("a", None, "b " * 12, "x", 1),
        ("a", 5, "ü x " * 11, "x", 1),
        ("a", 6, "c  d\n" * 6 + "e", "x", 1),
        ("a", 6, "c  d\n" * 6 + "e", "x", 1),
    ]
    got = P.periodic_runs(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.n_words for r in got] == [0, 0, 0, 12, 11, 13, 13]
    assert [[tuple(x) for x in r.runs] for r in got] == [[], [], [], [(0, 12, 1)], [], [(0, 12, 2)], [(0, 12, 2)]]
    assert [r.collapsed for r in got] == ["", "", "", "b", " ".join(["ü x"] * 11), "c d e", "c d e"]
    assert P.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_plain_code(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(f"w{x}" for x in odd_words(rng)) for _ in range(150)]
    rows = [(None if i == 3 else i, t if i % 17 else None) for i, t in enumerate(texts)] + [(9, texts[9])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        w = (t or "").split()
        h = None if i is None else zlib.crc32(str(i).encode())
        if h is not None and h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        runs = plain_runs(w)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((
            i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{n},{p}\n" for s, n, p in runs)), digest(" ".join(plain_collapsed(w, runs))),
        ))
    got = [tuple(r) for r in Q.op13_periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in want) > 20
