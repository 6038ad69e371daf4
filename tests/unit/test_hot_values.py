"""Values and nations that hold most rows are dealt over tasks."""

from podium.operators import relational as R
from podium.plans import merges
from pyspark.sql import functions as F


def test_rows_of_one_value_are_dealt(spark):
    df = spark.range(4000).select("id", (F.col("id") % 10 == 0).cast("long").alias("v"))
    ranked = R.range_ranked(df, [], "v", "r", descending=False, average=True, ranges=8)
    held = ranked.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert held < 2000  # 3600 rows have one value
    assert {tuple(r) for r in ranked.select("v", "r").distinct().collect()} == {(0, 1800.5), (1, 3800.5)}


def test_large_whole_numbers_that_are_one_double_keep_their_ranks(spark):
    top = 1 << 60
    df = spark.createDataFrame([(k, top + k % 3) for k in range(90)], "id long, v long")
    got = {tuple(r) for r in R.range_ranked(df, [], "v", "r", descending=False, ranges=4).select("v", "r").distinct().collect()}
    assert got == {(top, 1), (top + 1, 31), (top + 2, 61)}


def test_pairs_of_one_nation_are_dealt(spark, tmp_path):
    spark.range(20).select(F.col("id").alias("s_suppkey"), F.lit(3).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    spark.range(400).select(F.col("id").alias("c_custkey"), F.lit(3).alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    pairs = merges.same_sites(spark, str(tmp_path))
    rows = pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in rows) == 8000 and max(r["count"] for r in rows) < 6000
    same = {(r.s_suppkey, r.c_custkey) for r in pairs.where("same").collect()}
    assert same == {(s, c) for s in range(20) for c in range(400) if s % 5 == c % 5}
