"""Steps whose memory, driver traffic or number of tasks should not grow with the input."""

import pyarrow as pa
from podium.functions import facts, names
from podium.operators import frontier
from podium.plans import documents
from pyspark.sql import functions as F


def test_crawl_rounds_broadcast_nothing(spark, monkeypatch):
    plans, plain = [], frontier.written
    monkeypatch.setattr(frontier, "written", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, name))
    seeds = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "entity int, url string, score int")
    pages = spark.createDataFrame([("a", 1), ("b", 2)], "url string, page int")
    links = spark.createDataFrame([(1, "b", 3), (2, "a", 3)], "page int, url string, score int")
    got = sorted(tuple(r) for r in frontier.crawled(seeds, pages, links, 2, 1).collect())
    assert got == [(1, "a", 1, 1, 1), (1, "b", 2, 2, 2), (2, "a", 1, 2, 2), (2, "b", 2, 1, 1)]
    assert len(plans) > 5 and not any("Broadcast" in p for p in plans)


def test_patterns_are_tried_only_where_they_can_match(spark):
    assert set(facts.NEEDED) == {m for m, _, _ in facts.PATTERNS}
    texts = ["SET UP by some citizens in 1850, it has 1,200 Full-time Undergraduates", "It Dates Back to 1701 and has 900 postgraduate places, 40 senior lecturers", "Ratio of students: 12.5:1; Admissions rate near 30 per cent; 12% Overseas", "1,000 active full-time students and 77 Employees"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    value = lambda p: F.regexp_replace(F.regexp_extract("text", p, 1), ",", "").try_cast("double")
    want = {(r.id, m, r.v) for m, p, _ in facts.PATTERNS for r in df.select("id", value(p).alias("v")).collect() if r.v is not None}
    assert {(r.id, r.metric, r.value) for r in facts.extract_facts(df).collect()} == want and len(want) >= 9


def test_fact_texts_are_dealt(spark, tmp_path):
    spark.range(1, 2001).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    got = documents.text_fact_patterns(spark, str(tmp_path))
    assert got.select(F.spark_partition_id()).distinct().count() > 1


def test_folding_takes_slices_of_a_batch(spark, monkeypatch):
    captured = []
    monkeypatch.setattr(names.F, "arrow_udf", lambda run, kind: captured.append(run) or (lambda c: c))
    names._mapped(names._fold, F.lit("x"), F.lit(True), F.lit("y"))
    texts = ["École %d" % k if k % 3 else None for k in range(1000)]
    got = captured[0](pa.array(texts))
    assert got.to_pylist() == [None if t is None else names._fold(t) for t in texts]
    assert captured[0](pa.array([], pa.string())).to_pylist() == []
