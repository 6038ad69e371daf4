import pytest

import corpus_pipeline
from podium.llm import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
            rows = docs.collect()
            assert {r.doc_id for r in rows} <= ids
            ids = {r.doc_id for r in rows}
        if name == "near_dedup":
            assert len({r.text for r in rows}) == len(rows)
        if name == "decontamination":
            assert not any(t in r.text for r in rows for t in items)
    assert {r.doc_id for r in docs.collect()} == ids
    assert len(ids) > 100


def test_run_equals_its_stages(spark):
    once = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select("doc_id", "start", "length", "ids_crc32").collect()))
    again = sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select("doc_id", "start", "length", "ids_crc32").collect()))
    assert {r[0] for r in once} == {r[0] for r in again}


def test_odd_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (None, "plain words that say nothing much at all here", "en", "s", 3), (2, "", "en", "s", 0), (3, "word " * 30000, "en", "s", 1), (4, "same text of some words", "en", "s", 1), (4, "same text of some words", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, FOLDER)
        if name == "near_dedup":
            assert sum(r.doc_id == 4 for r in out.collect()) == 1 and sum(r.doc_id is None for r in out.collect()) == 1
        else:
            out.collect()
        assert stage(spark, docs.where("false"), FOLDER).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    df = QUERIES[name](spark, FOLDER)
    rows = df.collect()
    assert rows and df.columns
    if name in ("op1_secret_scan", "op2_license_scan", "op3_token_counts", "op7_simhash_near_dedup", "op9_token_id_output"):
        assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
