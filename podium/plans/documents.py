"""Queries on pages and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions import facts, names, web
from podium.operators import matching
from podium.plans.base import table
from podium.plans.registry import registry
from podium.sources import documents as D

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registry(QUERIES, ORACLES)


@query("""SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) <> '' AS titled, len(regexp_extract_all(html, '(?is)<a\\s[^>]*href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 1))::BIGINT AS links, sha256(html) AS content_hash FROM pages""")
def page_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = D.html_parts(table(spark, sf_dir, "pages"))
    return parts.select("page_id", (F.col("title") != "").alias("titled"), F.size("links").cast("long").alias("links"), "content_hash")


@query("""WITH l AS (SELECT page_id, lower(unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 1))) AS u FROM pages)
SELECT CASE WHEN regexp_matches(u, 'admission|apply|prospective|undergraduate|graduate-school') THEN 'admissions' WHEN regexp_matches(u, 'research|innovation') THEN 'research' WHEN regexp_matches(u, 'facts|figures|at-a-glance|statistics|rankings?') THEN 'facts'
WHEN regexp_matches(u, 'about|history|mission|who-we-are') THEN 'about' WHEN regexp_matches(u, 'contact|directions|visit') THEN 'contact' WHEN regexp_matches(u, 'news|press|media|events?') THEN 'news' ELSE 'other' END AS kind, count(*) AS n FROM l GROUP BY 1""")
def link_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = D.html_parts(table(spark, sf_dir, "pages")).select(F.explode("links.href").alias("u"))
    return links.groupBy(web.link_kind(F.col("u")).alias("kind")).agg(F.count("*").alias("n"))


@query("""WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS href FROM pages), p AS (SELECT page_id, href, regexp_extract(url, '^(https?)://([^/?#]+)', ['scheme', 'host']) AS u FROM l)
SELECT page_id, href, u.scheme || '://' || lower(u.host) || href AS normal, true AS same_site FROM p""")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages resolved against their page; the rules that these do not need are in the unit tests."""
    links = D.html_parts(table(spark, sf_dir, "pages")).select("page_id", "url", F.explode("links.href").alias("href"))
    normal = links.withColumn("normal", web.normalize_url("href", "url"))
    return normal.select("page_id", "href", "normal", web.same_site(web.host(F.col("url")), web.host(F.col("normal"))).alias("same_site"))


FACT_TEXTS = """SELECT c_custkey AS id, 1500 + c_custkey % 500 AS year, 1000 + c_custkey * 7 AS people, c_custkey % 90 + 5 AS share FROM customer"""


@query(f"""WITH t AS ({FACT_TEXTS}) SELECT id, 'founded' AS metric, year::DOUBLE AS value, 'year' AS unit FROM t WHERE id % 7 <> 0
UNION ALL SELECT id, 'students', people::DOUBLE, 'people' FROM t WHERE id % 7 <> 0 UNION ALL SELECT id, 'staff', (people // 10)::DOUBLE, 'people' FROM t
UNION ALL SELECT id, 'student_staff_ratio', (share / 2.0)::DOUBLE, 'ratio' FROM t UNION ALL SELECT id, 'acceptance_rate', share::DOUBLE, 'percent' FROM t UNION ALL SELECT id, 'international_share', share::DOUBLE, 'percent' FROM t""")
def text_fact_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts out of sentences: three lines for each customer, one of them about a department for every seventh."""
    told = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (1500 + F.col("c_custkey") % 500).alias("year"), (1000 + F.col("c_custkey") * 7).alias("people"), (F.col("c_custkey") % 90 + 5).alias("share"))
    # narrow rows come in few splits, and the patterns are the work
    told = told.repartition(max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))), "id")
    about = F.when(F.col("id") % 7 == 0, "The department of history").otherwise("The university")
    lines = F.array(
        F.concat(about, F.lit(" was founded by the citizens in "), F.col("year").cast("string"), F.lit(" and has "), F.format_number("people", 0), F.lit(" enrolled students today.")),
        F.concat(F.lit("With "), (F.col("people") / 10).cast("long").cast("string"), F.lit(" academic staff, the ratio of students to teachers is "), (F.col("share") / 2).cast("string"), F.lit(" to 1.")),
        F.concat(F.lit("The acceptance rate is about "), F.col("share").cast("string"), F.lit("%, and "), F.col("share").cast("string"), F.lit(" percent come from abroad.")),
    )
    return facts.extract_facts(told.select("id", F.explode(lines).alias("text"))).select("id", "metric", "value", "unit")


NAMED = """SELECT p_brand, p_name AS name, min(p_partkey) AS id FROM part GROUP BY 1, 2"""
STOP = str(list(names.STOP_WORDS))
SCORED_NAMES = f"""WITH n AS ({NAMED}), l AS (SELECT id, p_brand, name, list_distinct(string_split(name, ' ')) AS tokens FROM n),
r AS (SELECT id, p_brand, CASE WHEN id % 2 = 0 THEN name ELSE string_split(name, ' ')[2] || ' ' || string_split(name, ' ')[1] END AS name FROM n),
rt AS (SELECT *, list_distinct(string_split(name, ' ')) AS tokens FROM r),
m AS (SELECT l.id AS left_id, rt.id AS right_id, len(list_intersect(l.tokens, rt.tokens)) AS shared, len(l.tokens) AS ln, len(rt.tokens) AS rn, l.name = rt.name AS same FROM l JOIN rt ON l.p_brand = rt.p_brand AND len(list_intersect(l.tokens, rt.tokens)) > 0),
s AS (SELECT left_id, right_id, shared, 2.0::DOUBLE * shared / (ln + rn) AS dice, CASE WHEN same THEN 100.0 WHEN shared = ln AND shared = rn THEN 80.0 WHEN 2.0 * shared / (ln + rn) >= 0.82 AND shared >= 3 THEN 40.0 + 50.0 * (2.0 * shared / (ln + rn)) END AS score FROM m)"""


def _names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The distinct names of each brand's parts, and the same names, every other one with its words turned round."""
    parts = table(spark, sf_dir, "part").groupBy("p_brand", F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    words = F.split("name", " ")
    turned = F.when(F.col("id") % 2 == 0, F.col("name")).otherwise(F.concat_ws(" ", F.get(words, F.lit(1)), F.get(words, F.lit(0))))
    return parts, parts.withColumn("name", turned)


@query(SCORED_NAMES + """ SELECT left_id, right_id, shared, round_even(dice, 6) AS dice FROM s""")
def fuzzy_token_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of one list against names of another, blocked by brand."""
    pairs = matching.scored_pairs(*_names(spark, sf_dir), ["p_brand"])
    return pairs.select("left_id", "right_id", "shared", F.bround("dice", 6).alias("dice"))


@query(SCORED_NAMES + """, k AS (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY score DESC, right_id) AS k, score - coalesce(lead(score) OVER (PARTITION BY left_id ORDER BY score DESC, right_id), 0) AS margin FROM s WHERE score IS NOT NULL)
SELECT left_id, right_id, CAST(score AS DOUBLE) AS score FROM k WHERE k = 1 AND margin >= 5""")
def fuzzy_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one name that leads the next by the margin."""
    pairs = matching.scored_pairs(*_names(spark, sf_dir), ["p_brand"])
    return matching.best_matches(pairs).select("left_id", "right_id", "score")


@query("""SELECT doc_id, CASE WHEN length(text) > 80 THEN rtrim(substr(text, 1, 79), ' ') || '…' ELSE text END AS teaser, CASE WHEN regexp_matches(lower(text), 'checking your browser|just a moment|verify you are human|enable javascript and cookies|access denied') THEN true ELSE false END AS challenge FROM documents""")
def text_teasers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", names.truncate(F.col("text"), 80).alias("teaser"), web.is_challenge(F.col("text")).alias("challenge"))


@query("""WITH c AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations) SELECT conv_id, count(*) AS turns, count(*) FILTER (WHERE role = before) AS repeated_roles, arg_min(role, turn) AS first_role FROM c GROUP BY 1""")
def conversation_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    told = table(spark, sf_dir, "conversations").withColumn("before", F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn")))
    return told.groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_if(F.col("role") == F.col("before")).alias("repeated_roles"), F.min_by("role", "turn").alias("first_role"))


@query("""WITH b AS (SELECT page_id, unnest(regexp_split_to_array(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<template\\b[^>]*>.*?</template\\s*>|<noscript\\b[^>]*>.*?</noscript\\s*>|<head\\b[^>]*>.*?</head\\s*>|<!--.*?-->', ' ', 'g'),
'(?i)</?(?:p|div|li|ul|ol|h[1-6]|td|th|tr|table|article|section|header|footer|nav|aside|main|blockquote|br|hr|body|html|form|figure)\\b[^>]*>')) AS piece FROM pages),
t AS (SELECT page_id, trim(regexp_replace(regexp_replace(piece, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g')) AS block FROM b WHERE NOT contains(piece, '&'))
SELECT page_id, count(*) AS blocks, sum(length(block))::BIGINT AS chars, min(md5(block)) AS least FROM t WHERE length(block) BETWEEN 20 AND 700 GROUP BY 1""")
def visible_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text blocks of pages that facts are looked for in; those without character references, which SQL cannot decode."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", "&", "\u0001&").alias("html"))
    found = D.visible_blocks(pages).where(~F.contains("block", F.lit("\u0001")))
    return found.groupBy("page_id").agg(F.count("*").alias("blocks"), F.sum(F.length("block")).alias("chars"), F.min(F.md5("block")).alias("least"))
