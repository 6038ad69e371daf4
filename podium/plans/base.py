"""Views of the driver's tables that the queries share, in both languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions.numbers import percentile_score
from podium.operators.relational import range_ranked

MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scores(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """score and placements per key, of provider, entity, year."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("provider"), F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").cast(MONEY).alias("price"),
    )
    return orders.groupBy(*keys).agg(F.sum("price").cast("decimal(28,2)").alias("score"), F.count("*").alias("n"))


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """provider, entity, score, rank, field.  Providers are few and large, so each is ranked in ranges of its scores."""
    rows = scores(spark, sf_dir, "provider", "entity").select("provider", "entity", "score")
    fields = rows.groupBy("provider").agg(F.count("*").alias("field"))  # a row a provider
    return range_ranked(rows, ["provider"], "score").join(F.broadcast(fields), "provider").select("provider", "entity", "score", "rank", "field")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, country; nation is a dimension of 25 rows."""
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_nationkey"))
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey"), F.col("n_name").alias("country"))
    return customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select("entity", "country")


def consensus(spark: SparkSession, sf_dir: str, least: int = 4) -> DataFrame:
    """entity, providers, raw (mean percentile; the mean of four or five six-place numbers is exact to eight) of entities with enough providers."""
    rows = ranked(spark, sf_dir).withColumn("pct", percentile_score(F.col("rank"), F.col("field")).cast("decimal(18,6)"))
    grouped = rows.groupBy("entity").agg(F.count("*").alias("providers"), F.sum("pct").alias("total"))
    return grouped.where(F.col("providers") >= least).select("entity", "providers", F.bround(F.col("total").cast("double") / F.col("providers"), 8).alias("raw"))


SCORED = """scored AS (SELECT o_orderpriority AS provider, o_custkey AS entity, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS score,
  count(*) AS n FROM orders GROUP BY 1, 2)"""
YEARLY = """yearly AS (SELECT o_custkey AS entity, year(o_orderdate) AS year, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS score,
  count(*) AS n FROM orders GROUP BY 1, 2)"""
RANKED = SCORED + """, ranked AS (SELECT provider, entity, score, rank() OVER (PARTITION BY provider ORDER BY score DESC) AS rank,
  count(*) OVER (PARTITION BY provider) AS field FROM scored)"""
NATIONS = """nations AS (SELECT c_custkey AS entity, n_name AS country FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
CONSENSUS = RANKED + """, consensus AS (SELECT entity, count(*) AS providers, round_even(CAST(sum(CAST(greatest(0.0::DOUBLE,
  100.0::DOUBLE * (1.0::DOUBLE - (rank - 1)::DOUBLE / (greatest(field, 2) - 1)::DOUBLE)) AS DECIMAL(18,6))) AS DOUBLE) / count(*), 8) AS raw
  FROM ranked GROUP BY entity HAVING count(*) >= 4)"""
