"""All pairs of a group: the same rows as a join's, with little shuffled, written and held at once."""

from podium.functions import web
from podium.operators import matching
from podium.plans import merges
from pyspark.sql import functions as F


def written(spark) -> int:
    return sum(e.totalShuffleWrite() for e in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jsc.sc().statusStore().executorList(False)))


def settled(spark) -> int:
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    return written(spark)


def rows(df) -> list:
    return sorted((tuple(r) for r in df.collect()), key=str)


def plain(few, many):
    few, many = few.toDF("few_id", "n", "a"), many.toDF("many_id", "n", "b")
    return few.join(many, "n").select("few_id", "many_id", web.same_bare(F.col("a"), F.col("b")).alias("verdict"))


def compared(spark, monkeypatch, few, many, **sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(matching, name, value)
    few, many = (spark.createDataFrame(x, "id long, n int, value string") for x in (few, many))
    got = rows(matching.group_pairs(few, many, "n", web.same_bare, 4))
    assert got == rows(plain(few, many))
    return got


def test_missing_ids_values_and_groups(spark, monkeypatch):
    few = [(1, 0, "a.b"), (None, 0, "b"), (1, 0, "a.b"), (2, None, "b"), (3, 7, "b"), (4, 1, None)]
    many = [(1, 0, "b"), (None, 0, None), (5, 0, "c"), (5, 0, "c"), (6, None, "b"), (7, 1, "b"), (8, 9, "b")]
    assert len(compared(spark, monkeypatch, few, many)) == 13


def test_packs_are_cut_and_lines_are_added(spark, monkeypatch):
    few = [(k, k % 3, f"h{k % 2}") for k in range(40)]
    many = [(k, k * k % 4, f"x.h{k % 3}") for k in range(300)]
    for sizes in ({"PACKED": 3}, {"AT_ONCE": 5}, {"AT_ONCE": 1, "CELLS": 1}, {"PACKED": 2, "AT_ONCE": 40, "CELLS": 30}):
        compared(spark, monkeypatch, few, many, **sizes)


def test_one_side_far_larger_and_one_group_that_holds_most(spark, monkeypatch):
    compared(spark, monkeypatch, [(k, 0, "h") for k in range(500)], [(0, 0, "h"), (1, 0, "g.h")])
    compared(spark, monkeypatch, [(0, 0, "h"), (1, 1, "h")], [(k, int(k % 50 == 0), "h") for k in range(500)])


def test_an_empty_side_has_no_pairs(spark, monkeypatch):
    assert compared(spark, monkeypatch, [], [(1, 0, "h")]) == []


NATION = "cast(pmod(xxhash64(id, 7), 25) as int)"


def sites(spark, folder, suppliers, customers):
    spark.range(suppliers).select(F.col("id").alias("s_suppkey"), F.expr(NATION).alias("s_nationkey")).write.parquet(f"{folder}/supplier.parquet")
    spark.range(customers).select(F.col("id").alias("c_custkey"), F.expr(NATION).alias("c_nationkey")).write.parquet(f"{folder}/customer.parquet")


def test_what_is_shuffled_is_a_few_times_the_tables(spark, tmp_path):
    sites(spark, str(tmp_path), 10_000, 10_000)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        before = settled(spark)
        assert merges.same_sites(spark, str(tmp_path)).count() > 3_900_000
        took = settled(spark) - before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert took < 4_000_000, took


def test_rows_that_follow_one_another_are_alike(spark, tmp_path):
    sites(spark, str(tmp_path / "in"), 2500, 5000)
    merges.same_sites(spark, str(tmp_path / "in")).write.parquet(str(tmp_path / "out"))
    size = sum(p.stat().st_size for p in (tmp_path / "out").glob("*.parquet"))
    assert size < 350_000, size
