"""Grouping of equal rows by hashes first: the same as over whole rows, and what is shuffled."""

import math
import random

import pytest
from pyspark.sql import functions as F

from flowguard.operators import clean, row_groups
from flowguard.operators.quality import dedup_stats

SCHEMA = "i bigint, x double, t string, `a.b` int, Label string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    pick = [None, 0.0, -0.0, math.nan, math.inf, 1.5]
    out = [(rng.choice([None, 1, 2]), rng.choice(pick), rng.choice([None, "", "a", "nan"]), rng.choice([None, 0, 1]), rng.choice(["BENIGN", "DDoS"])) for _ in range(400)]
    return out + [(100 + i, float(i), str(i), i, "BENIGN") for i in range(300)] + [(7, 7.0, "hot", 7, "DDoS")] * 500


def canon(df):
    return sorted(str(tuple(r)).replace("-0.0", "0.0") for r in df.collect())


def weak(df):
    """Hashes that take four values only."""
    return F.pmod(F.xxhash64("i"), F.lit(4)).cast("long"), F.lit(0).cast("long")


@pytest.mark.parametrize("hashes", [row_groups.row_hashes, weak])
def test_equal_to_whole_rows(spark, rows, hashes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = canon(row_groups.group_rows(df, hash_first=False))
    assert canon(row_groups.group_rows(df, hash_first=True, hashes=hashes)) == want
    assert canon(clean.drop_duplicate_rows(df, hash_first=True)) == canon(df.dropDuplicates())


def test_counts(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert clean.duplicate_row_count(df, True).collect() == clean.duplicate_row_count(df, False).collect()
    assert dedup_stats(df, "Label", True).collect() == dedup_stats(df, "Label", False).collect()


def test_few_bits_and_no_copies(spark, monkeypatch):
    """With one word of bits most rows share a bit with a copy; without copies nothing is grouped."""
    monkeypatch.setattr(row_groups, "MAX_WORDS", 1)
    df = spark.range(2000).selectExpr("id % 1990 AS i", "id % 1990 AS j")
    assert canon(row_groups.group_rows(df, True)) == canon(row_groups.group_rows(df, False))
    single = row_groups.group_rows(spark.range(50).toDF("i"), True)
    assert single.count() == 50 and "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
    assert row_groups.group_rows(spark.createDataFrame([], SCHEMA), True).count() == 0


def test_only_repeated_hashes_move_whole(spark, tmp_path):
    """The shuffle of whole rows gets the copies and few others, not the 20,000 rows."""
    f = spark.range(20_000).selectExpr("id", "id * 3 AS a", "cast(id AS string) AS t")
    f = f.unionByName(f.where("id < 30"))
    f.write.parquet(f"{tmp_path}/f")
    df = spark.read.parquet(f"{tmp_path}/f")
    out = row_groups.group_rows(df, True)
    assert out.count() == 20_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    union = plan[plan.index("Union"):]
    assert union.count("Aggregate") == 1 and "__bits" in union[union.index("Aggregate"):]
    moved = out.where("__n > 1").count()
    assert moved == 30
    h1, _ = row_groups.row_hashes(df)
    again = df.select(row_groups.word_number(h1, 32).alias("w"), row_groups.bit_of(h1).alias("b"))
    copies = df.where("id < 30").select(row_groups.word_number(h1, 32).alias("w"), row_groups.bit_of(h1).alias("b")).distinct()
    assert again.join(copies, ["w", "b"]).count() < 600


def test_nested_columns_are_grouped_whole(spark):
    df = spark.sql("SELECT array(0.0D, -0.0D) AS a UNION ALL SELECT array(0.0D, -0.0D)")
    assert not row_groups.can_hash(df) and clean.drop_duplicate_rows(df).count() == 1
