import numpy as np
from pyspark.sql import functions as F

from flowguard.llm import embed_dedup


def brute(rows):
    """rows: (vec_id, embedding, label) -> {vec_id: (n_links, component)} by all cosines."""
    ok = [(i, np.array(e, float), l) for i, e, l in rows if l is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    n = len(ok)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for a in range(n):
        for b in range(a + 1, n):
            x, y = ok[a][1], ok[b][1]
            if ok[a][2] == ok[b][2] and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.98:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for a in range(n):
        least[find(a)] = min(least.get(find(a), ok[a][0]), ok[a][0])
    out = {i: (0, i) for i, _, _ in rows}
    return out | {ok[a][0]: (links[a], least[find(a)]) for a in range(n)}


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_table_matches_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = embed_dedup.near_duplicates(df)
    want = brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert result(got) == want
    assert sorted(r.vec_id for r in got.where("kept").collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_dense_group_in_split_cells(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 40)
    rng = np.random.default_rng(2)
    base = rng.normal(size=48)
    rows = [(i, [float(x) for x in (base + 0.1 * rng.normal(size=48)).astype(np.float32)], 1) for i in range(220)]
    rows += [(1000 + i, [float(x) for x in rng.normal(size=48).astype(np.float32)], i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert result(embed_dedup.near_duplicates(df)) == brute(rows)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1)]
    rows += [(9, [None, 1.0], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [-1.0, 0.0], 1), (12, [-1.0, 0.0], 1), (13, [1e-30, 0.0], 1), (14, [3e38, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit("x")).withColumn("size", F.lit(3))
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id) for r in embed_dedup.near_duplicates(df).collect())
    assert got == [(-1, 1, 12), (1, 4, 1), (1, 4, 1), (2, 4, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9), (10, 0, 10), (11, 0, 11), (12, 1, 12), (13, 4, 1), (14, 4, 1)]
    assert embed_dedup.near_duplicates(df.where("false")).count() == 0


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + 0.15 * rng.normal(size=x.shape) / 8
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    code, factor = embed_dedup.codes(x)
    bound = embed_dedup.upper_bounds(code, factor, y)
    slack = embed_dedup.SIGMAS * np.sqrt(1 - factor**2) / factor / np.sqrt(63)
    assert abs((bound - slack[:, None] - x @ y.T).mean()) < 0.01
    assert (bound >= x @ y.T).mean() > 0.999 and (np.diag(bound) >= np.sum(x * y, 1)).all()
