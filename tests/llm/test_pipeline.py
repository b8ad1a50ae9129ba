"""Each stage against a plain version of itself, on its own input."""

import importlib.util
import os

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def other(name):
    path = os.path.join(os.path.dirname(os.path.abspath(__file__)), f"{name}.py")
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(name, rows before, rows after) of every stage, each written and read again."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        path = str(tmp_path_factory.mktemp("stages") / name)
        after.write.parquet(path)
        after = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns and after.dtypes == docs.dtypes
        out[name] = (docs.collect(), after.collect())
        docs = after
    return out


def test_toxicity_drops_what_it_predicts(spark, stages):
    from flowguard.llm.queries import op6_toxicity

    before, after = stages["toxicity"]
    bad = {r.doc_id for r in op6_toxicity(spark, SF).where("predicted = 1").collect()}
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == bad and {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_simhash_keeps_one_of_each_group(stages):
    brute = other("test_simhash")
    before, after = stages["simhash"]
    rows = [(r.doc_id, brute.brute_fingerprint(r.text)) for r in before]
    want = brute.brute_components(rows)
    assert {r.doc_id for r in after} == {d for d, f in rows if want[(d, f)] == d} and len(after) < len(before)


def test_substring_cuts_words_and_keeps_documents(stages):
    before, after = stages["substring"]
    old = {r.doc_id: r for r in before}
    assert sorted(old) == sorted(r.doc_id for r in after)
    words = other("test_decontam").words
    for r in after:
        assert r.n_chars == len(r.text) and (r.text == old[r.doc_id].text or len(words(r.text)) <= len(words(old[r.doc_id].text)) - 50)


def test_decontamination_drops_documents_with_windows(spark, stages):
    brute = other("test_decontam")
    before, after = stages["decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {d for d, _, n, _ in brute.brute([(r.doc_id, r.text) for r in before], items) if n}
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == hit


def test_mixing_reports_every_document(spark, stages):
    before, after = stages["mixing"]
    assert sorted(r.doc_id for r in before) == sorted(r.doc_id for r in after)
    assert all(0 <= r.taken <= 2 * r["size"] for r in after)
    again = {r.doc_id: r.taken for r in corpus_pipeline.run(spark, SF).collect()}
    assert again == {r.doc_id: r.taken for r in after}
