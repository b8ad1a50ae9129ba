"""CSV lines with too many or too few fields, quotes, and the quarantine."""

import pytest
from pyspark.sql import functions as F

from flowguard.sources import csv as C


@pytest.fixture()
def folder(out_dir):
    with open(f"{out_dir}/a.csv", "w") as f:
        f.write(' A,B,Label\n1,2,x\n1,2,x,\n"1,5","say ""hi""",x\n7\n\n8,,nan\n1,2,3,4,5\nback\\slash,"",z\n')
    with open(f"{out_dir}/b.csv", "wb") as f:
        f.write("B,Label\n1,\xfc\n2,y,z\n".encode("latin-1"))
    return out_dir


WANT = [("1", "2", "x"), ("1,5", 'say "hi"', "x"), ("7", None, None), ("8", None, None), ("back\\slash", None, "z")]


def test_skip_and_quarantine(spark, folder):
    rows = C.load_traffic_csvs(spark, folder, malformed="skip").collect()
    key = lambda r: str(r)
    assert sorted([tuple(r)[:3] for r in rows if r["__source_csv"] == "a.csv"], key=key) == sorted(WANT, key=key)
    assert [(r.B, r.Label) for r in rows if r["__source_csv"] == "b.csv"] == [("1", "ü")]
    bad = C.quarantined_lines(spark, folder)
    assert sorted(tuple(r) for r in bad.collect()) == [("a.csv", 3, "1,2,3,4,5"), ("a.csv", 3, "1,2,x,"), ("b.csv", 2, "2,y,z")]


def test_raise_names_the_file(spark, folder):
    with pytest.raises(Exception, match="more than the 2 fields of its header: b.csv"):
        C.read_flow_csv(spark, f"{folder}/b.csv").collect()
    with pytest.raises(Exception, match="more than the"):
        C.load_traffic_csvs(spark, folder).collect()
    with pytest.raises(ValueError, match="malformed must be"):
        C.read_flow_csv(spark, f"{folder}/b.csv", malformed="keep")


def test_cut(spark, folder):
    rows = C.read_flow_csv(spark, f"{folder}/a.csv", malformed="cut").collect()
    assert [tuple(r) for r in rows] == [WANT[0], WANT[0], *WANT[1:4], ("1", "2", "3"), WANT[4]]


def test_columns_don_t_change_what_is_malformed(spark, folder):
    df = C.read_flow_csv(spark, f"{folder}/a.csv", malformed="skip")
    assert df.select("Label").count() == df.count() == df.select("A", "B").distinct().count() == 5


def test_lines_and_files_parse_alike(spark, folder):
    lines = spark.read.text(f"{folder}/a.csv").where("value not like ' A%' and value <> ''")
    parsed = C.flow_rows(C.parse_lines(lines, "value", 3), ["A", "B", "Label"], "skip")
    assert sorted(map(str, parsed.collect())) == sorted(map(str, C.read_flow_csv(spark, f"{folder}/a.csv", malformed="skip").collect()))
    assert C.parse_lines(lines, "value", 3).where(F.col("__raw_line").isNotNull()).count() == 3


def test_no_files(spark, out_dir):
    assert C.quarantined_lines(spark, f"{out_dir}/none").count() == 0
