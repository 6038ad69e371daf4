"""Queries that run along one order of all rows, and over large single files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions import addresses, web
from podium.operators import constraints, frontier, ordered
from podium.plans.base import table
from podium.plans.registry import registry
from podium.sources import csv_ranges, landing
from podium.sources import documents as D

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registry(QUERIES, ORACLES)


@query("""WITH e AS (SELECT event_id, ts, value, event_type, lag(value) OVER w AS before, sum((event_type = 'error')::INT) OVER (w ROWS UNBOUNDED PRECEDING) AS segment FROM events WINDOW w AS (ORDER BY ts, event_id))
SELECT event_id, before, segment, coalesce(value < before, false) AS falls FROM e""")
def one_key_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one sequence: the value before, the segment since the last error, and whether the value falls."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value", "event_type")
    order = ["ts", "event_id"]
    told = ordered.with_previous(events, [], order, "value", "before")
    told = ordered.with_segments(told, [], order, F.col("event_type") == "error", "segment")
    return told.select("event_id", "before", "segment", F.coalesce(F.col("value") < F.col("before"), F.lit(False)).alias("falls"))


@query("""SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id % 2 ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS known,
row_number() OVER (PARTITION BY user_id % 2 ORDER BY ts, event_id) AS n FROM events""")
def last_known_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last purchase so far and the number of each event, in two halves of the users."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", (F.col("user_id") % 2).alias("half"), F.when(F.col("event_type") == "purchase", F.col("value")).alias("bought"))
    known = ordered.with_last_known(rows, ["half"], ["ts", "event_id"], "bought", "known")
    return ordered.with_numbers(known, ["half"], ["ts", "event_id"], "n").select("event_id", "known", "n")


@query("""WITH a AS (SELECT c_custkey, c_custkey % 40 AS k FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN (11 + k) || '.' || (c_custkey % 251) || '.0.9' ELSE '2001:db8:' || printf('%x', 200 + 3 * k) || '::' || printf('%x', c_custkey % 60000) END AS address, CASE WHEN k <= 24 THEN 'NATION_' || k END AS block FROM a""")
def address_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block that holds each customer's address: of each nation one IPv4 and one IPv6 block, none nested."""
    k = F.col("c_custkey") % 40
    hexed = lambda n: F.lower(F.hex(n))
    v4 = F.concat_ws(".", (11 + k).cast("string"), (F.col("c_custkey") % 251).cast("string"), F.lit("0.9"))
    v6 = F.concat(F.lit("2001:db8:"), hexed(200 + 3 * k), F.lit("::"), hexed(F.col("c_custkey") % 60000))
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, v4).otherwise(v6).alias("address"))
    nation = table(spark, sf_dir, "nation")
    listed = [F.concat((11 + F.col("n_nationkey")).cast("string"), F.lit(".0.0.0/8")), F.concat(F.lit("2001:db8:"), hexed(200 + 3 * F.col("n_nationkey")), F.lit("::/48"))]
    blocks = nation.select(F.col("n_name").alias("block"), F.explode(F.array(*listed)).alias("cidr")).withColumn("b", addresses.bounds(F.col("cidr")))
    ends = blocks.select("block", F.col("b.low.hi").alias("low_hi"), F.col("b.low.lo").alias("low_lo"), F.col("b.high.hi").alias("high_hi"), F.col("b.high.lo").alias("high_lo"))
    placed = customers.withColumn("n", addresses.number(F.col("address"))).select("c_custkey", "address", F.col("n.hi").alias("hi"), F.col("n.lo").alias("lo"))
    return ordered.in_intervals(placed, ends, ["low_hi", "low_lo"], ["high_hi", "high_lo"], ["hi", "lo"], "block").select("c_custkey", "address", "block")


@query("""SELECT address, address IN ('::ffff:192.168.7.1', '::ffff:c0a8:701', '10.9.8.7', 'fe80::1%eth0', '2001:db8::5', '2002:808:808::1', 'no address', '::1', '2001:0:53aa::1') AS reserved, count(*) AS n
FROM (SELECT (['::ffff:8.8.8.8', '::ffff:192.168.7.1', '::ffff:c0a8:701', '::ffff:808:808', '10.9.8.7', '9.9.9.9', 'fe80::1%eth0', '2606:4700::1111', '2001:db8::5', '2002:808:808::1', 'no address', '::1', '2001:0:53aa::1', '[2a00:1450::1]'])[o_custkey % 14 + 1] AS address FROM orders) GROUP BY 1, 2""")
def reserved_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by address, and whether it can be a public host's."""
    listed = ["::ffff:8.8.8.8", "::ffff:192.168.7.1", "::ffff:c0a8:701", "::ffff:808:808", "10.9.8.7", "9.9.9.9", "fe80::1%eth0", "2606:4700::1111", "2001:db8::5", "2002:808:808::1", "no address", "::1", "2001:0:53aa::1", "[2a00:1450::1]"]
    rows = table(spark, sf_dir, "orders").select(F.get(F.array(*map(F.lit, listed)), (F.col("o_custkey") % 14).cast("int")).alias("address"))
    return rows.groupBy("address").agg(F.count("*").alias("n")).withColumn("reserved", addresses.is_reserved(F.col("address")))


@query("""SELECT doc_id::VARCHAR AS doc_id, CASE WHEN text <> '' THEN text END AS text, lang FROM documents WHERE NOT contains(coalesce(text, ''), chr(13))""")
def multi_line_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with line breaks and quotes in their texts, written as CSV and read back by byte ranges."""
    docs = table(spark, sf_dir, "documents").where(~F.contains(F.coalesce("text", F.lit("")), F.lit("\r")))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    path = landing.folder(spark, "csv")
    docs.select(F.concat_ws(",", quoted("doc_id"), quoted("text"), "lang").alias("value")).write.text(path)
    return csv_ranges.read(spark, path, ["doc_id", "text", "lang"], header=False)


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pages that link to each other by rule: the seeds (each page its own entity), the pages, of which some cannot be read, and the links."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    numbered = landing.written(ordered.with_numbers(pages.select("page_id", "url"), [], ["page_id"], "n"), "numbered")
    total = numbered.agg(F.count("*")).scalar()
    labels = D.html_parts(pages).select("page_id", F.posexplode("links.href").alias("j", "href"))
    to = (F.col("page_id") * 7 + F.col("j") * F.col("j") + F.length("href")) % total + 1
    score = web.page_priority(F.concat(F.lit("https://a.edu"), F.col("href")), F.lit(20), F.lit("a.edu"))
    links = labels.select(F.col("page_id").alias("page"), to.alias("n"), score.alias("score")).join(numbered.select("n", "url"), "n").select("page", "url", "score")
    seeds = numbered.select(F.col("page_id").alias("entity"), "url", F.lit(100).alias("score"))
    return seeds, numbered.select("url", F.when(F.col("page_id") % 11 != 0, F.col("page_id")).alias("page")), links


@query()
def crawl_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From each page the pages that are read next, best link first, with a budget of pages and attempts."""
    return frontier.crawled(*_graph(spark, sf_dir))


def _dataset(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Orders as observations of customers, hurt by rule."""
    k = F.col("o_orderkey")
    orders, customer, supplier = (table(spark, sf_dir, t) for t in ("orders", "customer", "supplier"))
    observations = orders.select(
        F.when(k % 101 == 100, k - 1).otherwise(k).alias("observation_id"), F.when(k % 103 == 0, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("entity"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "founded").otherwise(F.lower("o_orderpriority")).alias("metric"), F.when(k % 107 == 0, -1).otherwise(F.col("o_custkey") % 10).cast("long").alias("source_id"),
        F.when(k % 109 == 0, "text").otherwise("number").alias("kind"), F.lit("people").alias("unit"), F.col("o_totalprice").alias("value"), F.year("o_orderdate").alias("frame"),
        F.when(k % 113 == 0, 1.5).otherwise(0.9).alias("confidence"), (k % 3 != 0).alias("comparable"), F.when(k % 50 == 0, F.lit("group")).alias("conflict"),
    )
    metrics = orders.select(F.lower("o_orderpriority").alias("metric")).where("metric not in ('1-urgent', '5-low')").distinct().unionByName(spark.createDataFrame([("founded",)], "metric string"))
    picks = orders.where((k % 101 < 99) & (k % 103 != 0)).groupBy(F.col("o_custkey").alias("entity"), F.when(F.col("o_orderpriority") == "1-URGENT", "founded").otherwise(F.lower("o_orderpriority")).alias("metric")).agg(
        F.min_by(F.struct(k.alias("observation_id"), F.when(k % 107 == 0, -1).otherwise(F.col("o_custkey") % 10).cast("long").alias("source_id"), F.col("o_totalprice").alias("value"), F.year("o_orderdate").alias("frame")), k).alias("p"))
    c, o = F.col("entity"), F.col("p.observation_id")
    canonical = picks.where(c % 29 != 5).select(
        "entity", "metric", "p.source_id", F.when(o % 127 == 1, -o).otherwise(o).alias("observation_id"), (F.col("p.value") + F.when(o % 131 == 1, 1.0).otherwise(0.0)).alias("value"), "p.frame",
        F.when(c % 137 == 1, "certain").otherwise("high").alias("level"), F.when(c % 139 == 1, "").otherwise("only one").alias("reason"),
    )
    counts = {"institutions": customer, "sources": supplier, "observations": orders}
    meta = spark.range(1).select(*[df.agg(F.count("*")).scalar().alias(n) for n, df in counts.items()], F.lit(0).cast("long").alias("canonical"), F.lit(0).cast("long").alias("conflicting"), F.lit(7).cast("long").alias("unresolved"), F.array().cast("array<struct<metric: string, observations: bigint, entities: bigint, canonical: bigint>>").alias("coverage"))
    return {
        "metrics": metrics.withColumns({"kind": F.lit("number"), "unit": F.lit("people")}),
        "institutions": customer.select(F.col("c_custkey").alias("entity"), F.when(F.col("c_custkey") % 97 == 3, -1).otherwise(F.col("c_custkey") % 10).cast("long").alias("identity_source"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey") % 11 - 1).alias("website_source")),
        "sources": supplier.select(F.col("s_suppkey").alias("source_id")), "observations": observations, "canonical": canonical, "meta": meta.withColumn("selected", F.col("institutions") + 7),
    }


@query("""WITH o AS (SELECT CASE WHEN o_orderkey % 101 = 100 THEN o_orderkey - 1 ELSE o_orderkey END AS id, CASE WHEN o_orderkey % 103 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS entity, CASE WHEN o_orderpriority = '1-URGENT' THEN 'founded' ELSE lower(o_orderpriority) END AS metric,
CASE WHEN o_orderkey % 107 = 0 THEN -1 ELSE o_custkey % 10 END AS source_id, o_orderkey AS k, o_custkey, o_totalprice AS value FROM orders),
p AS (SELECT o_custkey AS entity, metric, min(k) AS k FROM o WHERE k % 101 < 99 AND k % 103 <> 0 GROUP BY 1, 2), c AS (SELECT * FROM p WHERE entity % 29 <> 5),
f("check", bad_rows) AS (SELECT 'repeated metric', 0 UNION ALL SELECT 'repeated institution', 0 UNION ALL SELECT 'repeated source', 0 UNION ALL SELECT 'repeated observation', count(*) - count(DISTINCT id) FROM o UNION ALL SELECT 'several canonical values', 0
UNION ALL SELECT 'institution of an unknown source', count(*) FILTER (WHERE c_custkey % 97 = 3 OR c_custkey % 10 NOT IN (SELECT s_suppkey FROM supplier)) FROM customer UNION ALL SELECT 'website of an unknown source', count(*) FILTER (WHERE c_custkey % 2 = 0 AND c_custkey % 11 - 1 NOT IN (SELECT s_suppkey FROM supplier)) FROM customer
UNION ALL SELECT 'observation of an unknown institution', count(*) FILTER (WHERE entity NOT IN (SELECT c_custkey FROM customer)) FROM o UNION ALL SELECT 'observation of an unknown source', count(*) FILTER (WHERE source_id NOT IN (SELECT s_suppkey FROM supplier)) FROM o
UNION ALL SELECT 'observation of an unknown metric', count(*) FILTER (WHERE metric = '5-low') FROM o UNION ALL SELECT 'observation with another shape than its metric''s', count(*) FILTER (WHERE k % 109 = 0 AND metric <> '5-low') FROM o
UNION ALL SELECT 'confidence outside 0 to 1', count(*) FILTER (WHERE k % 113 = 0) FROM o UNION ALL SELECT 'canonical value of an unknown observation', count(*) FILTER (WHERE k % 127 = 1) FROM c
UNION ALL SELECT 'canonical value that its observation does not hold', count(*) FILTER (WHERE k % 127 <> 1 AND k % 131 = 1) FROM c UNION ALL SELECT 'canonical value of an observation for display only', count(*) FILTER (WHERE k % 127 <> 1 AND k % 3 = 0) FROM c
UNION ALL SELECT 'selection without a level or reason', count(*) FILTER (WHERE entity % 137 = 1 OR entity % 139 = 1) FROM c
UNION ALL SELECT 'comparable founding year without a canonical one', count(DISTINCT entity) FROM o WHERE metric = 'founded' AND k % 3 <> 0 AND entity NOT IN (SELECT entity FROM c WHERE metric = 'founded')
UNION ALL SELECT unnest(['metadata: institutions', 'metadata: sources', 'metadata: observations', 'metadata: selected']), 0 UNION ALL SELECT unnest(['metadata: canonical', 'metadata: conflicting', 'metadata: coverage']), 1) SELECT "check", bad_rows FROM f""")
def dataset_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of a dataset of facts that is hurt in many ways."""
    return constraints.dataset_faults(_dataset(spark, sf_dir)).select("check", "bad_rows")
