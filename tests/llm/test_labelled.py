import zlib

from pyspark.sql import functions as F

from flowguard.llm.labelled import sample_ids, sample_texts


def test_sample_is_the_first_ids_of_each_class_in_hashed_order(spark):
    rows = [(i, i % 3 % 2) for i in range(3000)] + [(5, 1), (None, 1), (7, None), (8, 2)]
    labels = spark.createDataFrame(rows, "doc_id long, toxic int")
    hashes = {r.doc_id: r.h for r in labels.select("doc_id", F.xxhash64("doc_id", F.lit(5)).alias("h")).collect()}
    y = {}
    for d, v in rows:
        if d is not None and v in (0, 1) and zlib.crc32(str(d).encode()) % 5:
            y[d] = max(v, y.get(d, 0))
    want = {k: set(sorted((d for d in y if y[d] == k), key=lambda d: (hashes[d], d))[:60]) for k in (0, 1)}
    got = sample_ids(labels, "toxic", 60).collect()
    assert len(got) == 120 and all({r.doc_id for r in got if r.y == k} == want[k] for k in (0, 1))
    assert sample_ids(labels.where("false"), "toxic").count() == 0
    assert sample_ids(labels.where("toxic = 1"), "toxic", 10).count() == 10


def test_repeated_rows_stay_within_the_bytes(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, "x" * 100) for i in range(40) for _ in range(20 if i == 3 else 1)] + [(4, None)], "doc_id long, text string")
    got = sample_texts(docs, labels, "quality", most_bytes=1000)
    assert sum(len(t) for t, _ in got) <= 1000 and len(got) >= 10
    assert sample_texts(docs.where("false"), labels, "quality") == []
