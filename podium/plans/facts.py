"""Queries on an observation store made from events: entity a user, metric a type, frame a day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions import facts
from podium.operators import fact_store
from podium.plans.base import table
from podium.plans.registry import registry

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registry(QUERIES, ORACLES)

OBSERVED = """obs AS (SELECT event_id, user_id AS entity, event_type AS metric, strftime(ts, '%Y-%m-%d') AS frame, CAST(floor(value / 40) AS BIGINT) AS value,
(event_id % 3 = 0)::INTEGER AS priority, (event_id % 11) * 10 AS score FROM events)"""


def _observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("entity"), F.col("event_type").alias("metric"), F.date_format("ts", "yyyy-MM-dd").alias("frame"),
        F.floor(F.col("value") / 40).alias("value"), (F.col("event_id") % 3 == 0).cast("int").alias("priority"), (F.col("event_id") % 11 * 10).alias("score"),
    )


CANONICAL = OBSERVED + """, vals AS (SELECT entity, metric, priority, value, max(score) AS score FROM obs GROUP BY 1, 2, 3, 4),
o AS (SELECT entity, metric, count(*) AS n, arg_max(value, struct_pack(a := score, b := -value)) AS best, list_sort(list(score), 'DESC') AS scores, list(value) AS vs FROM vals WHERE priority = 0 GROUP BY 1, 2),
r AS (SELECT entity, metric, count(*) AS m, min(value) AS registered FROM vals WHERE priority = 1 GROUP BY 1, 2),
j AS (SELECT coalesce(o.entity, r.entity) AS entity, coalesce(o.metric, r.metric) AS metric, coalesce(n, 0) AS n, coalesce(m, 0) AS m, best, registered, scores, coalesce(m = 1 AND list_contains(vs, registered), false) AS agreed FROM o FULL JOIN r ON o.entity = r.entity AND o.metric = r.metric),
c AS (SELECT entity, metric, CASE WHEN n = 1 AND (m = 0 OR agreed) THEN 'official' WHEN n = 1 THEN 'official-registry-differs' WHEN n > 1 AND agreed THEN 'corroborated'
WHEN n > 1 AND scores[1] >= 80 AND scores[1] - scores[2] >= 25 THEN 'strongest' WHEN n > 1 AND m = 1 THEN 'registry' WHEN n > 1 THEN 'best-of-several' WHEN m = 1 THEN 'registry-only' END AS reason, best, registered FROM j),
canon AS (SELECT entity, metric, CASE WHEN reason IN ('corroborated', 'registry', 'registry-only') THEN registered ELSE best END AS value,
CASE WHEN reason IN ('official', 'corroborated') THEN 'high' WHEN reason IN ('official-registry-differs', 'strongest', 'registry-only') THEN 'medium' ELSE 'low' END AS confidence, reason FROM c WHERE reason IS NOT NULL)"""


@query(f"""WITH {OBSERVED} SELECT entity, metric, frame, count(DISTINCT value) AS vals, count(*) AS observations FROM obs GROUP BY 1, 2, 3 HAVING count(DISTINCT value) >= 2""")
def conflict_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = fact_store.mark_conflicts(_observations(spark, sf_dir)).where("conflicting")
    return marked.groupBy("entity", "metric", "frame").agg(F.countDistinct("value").alias("vals"), F.count("*").alias("observations"))


@query(f"""WITH {CANONICAL} SELECT * FROM canon""")
def canonical_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_store.select_canonical(_observations(spark, sf_dir))


@query(f"""WITH {CANONICAL}, metrics AS (SELECT DISTINCT event_type AS metric FROM events UNION ALL SELECT 'unseen'), s AS (SELECT metric, count(*) AS observations, count(DISTINCT entity) AS entities FROM obs GROUP BY 1), k AS (SELECT metric, count(*) AS canonical FROM canon GROUP BY 1)
SELECT metric, coalesce(observations, 0) AS observations, coalesce(entities, 0) AS entities, coalesce(canonical, 0) AS canonical FROM metrics LEFT JOIN s USING (metric) LEFT JOIN k USING (metric)""")
def metric_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _observations(spark, sf_dir)
    metrics = rows.select("metric").distinct().unionByName(spark.createDataFrame([("unseen",)], "metric string"))
    return fact_store.coverage(metrics, rows, fact_store.select_canonical(rows))


@query("""SELECT 'order_key_repeated' AS "check", count(*) AS bad_rows FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'order_without_customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'line_without_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'negative_balance', count(*) FROM customer WHERE c_acctbal < 0""")
def fact_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, items = (table(spark, sf_dir, t) for t in ("orders", "customer", "lineitem"))
    return fact_store.violations({
        "order_key_repeated": fact_store.repeated_keys(orders, ["o_orderkey"]),
        "order_without_customer": fact_store.orphans(orders, customer, "o_custkey", "c_custkey"),
        "line_without_order": fact_store.orphans(items, orders, "l_orderkey", "o_orderkey"),
        "negative_balance": customer.where("c_acctbal < 0"),
    })


@query(f"""WITH {OBSERVED} SELECT event_id, (metric = 'click' AND value BETWEEN 0 AND 1000 OR metric <> 'click' AND value >= 0) AS ok FROM obs""")
def plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _observations(spark, sf_dir).withColumn("kind", F.when(F.col("metric") == "click", "student_staff_ratio").otherwise("students"))
    value = F.when(F.col("kind") == "student_staff_ratio", F.col("value") + F.lit(1e-9)).otherwise(F.col("value").cast("double"))
    return rows.select("event_id", facts.plausible(F.col("kind"), value, F.lit(2024)).alias("ok"))


@query("""SELECT s_suppkey, 'src_' || substr(sha256('{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}'), 1, 24) AS id FROM supplier""")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select("s_suppkey", facts.stable_id("src_", F.col("s_suppkey"), F.col("s_name")).alias("id"))


BUILT = OBSERVED + """, o AS (SELECT DISTINCT entity, metric, frame, value, priority, 'page-' || event_id % 13 AS source FROM obs)"""


def _dataset(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = _observations(spark, sf_dir).withColumns({"source": F.concat(F.lit("page-"), (F.col("event_id") % 13).cast("string")), "retrieved": F.col("frame")})
    metrics = rows.select("metric").distinct()
    return fact_store.build(rows.drop("event_id"), metrics)


@query(f"""WITH {CANONICAL}, obs5 AS (SELECT DISTINCT entity, metric, frame, value, priority, 'page-' || event_id % 13 AS source FROM obs)
SELECT 'sources' AS part, count(DISTINCT source) AS n FROM obs5 UNION ALL SELECT 'institutions', count(DISTINCT entity) FROM obs5 UNION ALL SELECT 'metrics', count(DISTINCT metric) FROM obs5
UNION ALL SELECT 'observations', count(*) FROM obs5 UNION ALL SELECT 'canonical', count(*) FROM canon""")
def fact_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the tables of a built dataset have."""
    parts = [df.agg(F.lit(name).alias("part"), F.count("*").alias("n")) for name, df in _dataset(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, parts)


@query(f"""WITH {BUILT}, ids AS (SELECT entity, metric, frame, value, source, count(*) AS n FROM o GROUP BY ALL) SELECT 'repeated observation id' AS "check", count(*) FILTER (WHERE n > 1) AS bad_rows FROM ids
UNION ALL SELECT unnest(['repeated source id', 'several canonical values', 'observation without institution', 'canonical value without observation', 'canonical value that its observation does not hold']), 0
UNION ALL SELECT 'observation without source', count(*) FROM o WHERE source = 'page-3' UNION ALL SELECT 'observation of an unknown metric', count(*) FROM o WHERE metric = 'error' UNION ALL SELECT 'implausible value', count(*) FROM o WHERE value > 8""")
def fact_dataset_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of a dataset that lost a source and a metric."""
    built = _dataset(spark, sf_dir)
    hurt = built | {"sources": built["sources"].where("source <> 'page-3'"), "metrics": built["metrics"].where("metric <> 'error'")}
    return fact_store.faults(hurt, F.col("value") <= 8)


@query("""SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 1800 + s_suppkey % 150 WHEN 4 THEN 1900 + s_suppkey % 100 END AS year FROM supplier""")
def recovered_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years of founding out of running text: after the name, unless several or about a part."""
    k, year = F.col("s_suppkey") % 5, (1800 + F.col("s_suppkey") % 150).cast("string")
    text = (
        F.when(k == 0, F.concat(F.lit("It all began: "), "s_name", F.lit(" was founded on a hill in "), year, F.lit(".")))
        .when(k == 1, F.concat("s_name", F.lit(", its School of Law since "), year))
        .when(k == 2, F.concat("s_name", F.lit(" of 1850. "), "s_name", F.lit(" of 1960.")))
        .when(k == 3, F.concat("s_name", F.lit(" "), F.repeat(F.lit("x"), F.lit(90)), F.lit(" 1900")))
        .otherwise(F.concat("s_name", F.lit(" library since 1850; "), "s_name", F.lit(" itself since "), (1900 + F.col("s_suppkey") % 100).cast("string")))
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", facts.recovered_year(text, F.col("s_name")).alias("year"))
