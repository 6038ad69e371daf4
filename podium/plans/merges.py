"""Queries for filters, joins, aggregates and orders of the archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions import facts, numbers, places, web
from podium.operators import matching, merging, ordered
from podium.operators import relational as R
from podium.plans.base import NATIONS, RANKED, nations, ranked, table
from podium.plans.registry import registry
from podium.sources import documents as D
from podium.sources import snapshots

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registry(QUERIES, ORACLES)


@query("""WITH r AS (SELECT o_custkey AS id, max(o_orderpriority) AS segment, count(*) AS n FROM orders GROUP BY 1)
SELECT c_custkey AS id, coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, r.segment) AS segment, c_acctbal AS balance, n FROM customer LEFT JOIN r ON c_custkey = id""")
def merge_without_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("segment"), F.col("c_acctbal").alias("balance"))
    right = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderpriority").alias("segment"), F.count("*").alias("n"))
    return merging.merged(left, right, ["id"])


@query("""SELECT l_orderkey, l_linenumber, p_name, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def unique_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return merging.unique_left_join(items, table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), ["p_partkey"]).drop("p_partkey")


@query("""SELECT o_orderkey, 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def consistent_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.format_string("Customer#%09d", "o_custkey").alias("name"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return merging.consistent_left_join(orders, customers, ["c_custkey"], "name", "c_name").select("o_orderkey", "name", "c_mktsegment")


@query("""SELECT p_brand, arg_max(p_name, struct_pack(a := length(p_name), b := p_name)) AS name FROM part GROUP BY 1""")
def longest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(merging.longest(F.col("p_name")).alias("name"))


@query(f"""WITH {RANKED}, a AS (SELECT entity, rank FROM ranked WHERE provider = '1-URGENT'), b AS (SELECT entity, rank FROM ranked WHERE provider = '5-LOW')
SELECT count(*) FILTER (WHERE a.rank <= 100 AND b.rank <= 100) AS in_both, count(*) AS shared FROM a JOIN b USING (entity)""")
def top_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranked(spark, sf_dir)
    side = lambda provider, name: rows.where(F.col("provider") == provider).select("entity", F.col("rank").alias(name))
    return side("1-URGENT", "a").join(side("5-LOW", "b"), "entity").agg(merging.in_both(F.col("a"), F.col("b"), 100).alias("in_both"), F.count("*").alias("shared"))


@query("""WITH y AS (SELECT o_custkey AS entity, year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1, 2) SELECT entity, string_agg(year || ':' || n, ',' ORDER BY year) AS points, count(*) AS years FROM y GROUP BY 1""")
def collected_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year")).count()
    points = yearly.groupBy("entity").agg(merging.collected(F.col("year"), F.col("count").alias("n")).alias("points"))
    shown = F.array_join(F.transform("points", lambda p: F.concat_ws(":", p["key"].cast("string"), p["n"].cast("string"))), ",")
    return points.select("entity", shown.alias("points"), F.size("points").cast("long").alias("years"))


@query(f"""WITH {RANKED} SELECT entity, string_agg(provider || '=' || rank, ',' ORDER BY provider) AS ranks, min(rank) AS best FROM ranked GROUP BY 1""")
def ranks_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of an entity as a map of provider to rank."""
    maps = ranked(spark, sf_dir).groupBy("entity").agg(F.map_from_entries(F.collect_list(F.struct("provider", "rank"))).alias("ranks"))
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("ranks")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return maps.select("entity", shown.alias("ranks"), F.array_min(F.map_values("ranks")).alias("best"))


@query("""WITH f AS (SELECT o_custkey AS id, o_orderpriority AS p, min(o_orderkey) AS first FROM orders GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY first) AS k FROM f)
SELECT o_custkey AS id, arg_min(o_orderstatus, o_orderkey) FILTER (WHERE o_orderstatus <> 'P') AS status, (SELECT string_agg(p, '|' ORDER BY first) FROM k WHERE k.id = o_custkey AND k <= 3) AS priorities FROM orders GROUP BY 1""")
def merged_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First known status and the first three priorities of each customer, in the order of orders."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), F.array("o_orderpriority").alias("p"))
    return rows.groupBy("id").agg(
        merging.first_present(F.col("status"), F.col("o_orderkey")).alias("status"), F.array_join(merging.united(F.col("p"), F.col("o_orderkey"), 3), "|").alias("priorities")
    )


@query("""WITH y AS (SELECT year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY 1) SELECT 'stable' AS part, year, n FROM y WHERE year <= 1996 UNION ALL SELECT 'recent', year, n FROM y WHERE year >= 1996""")
def split_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    yearly = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    stable, recent = merging.split_at(yearly, "year", 1996)
    return stable.withColumn("part", F.lit("stable")).unionByName(recent.withColumn("part", F.lit("recent")))


@query(f"""WITH {NATIONS}, c AS (SELECT n_name AS country, c_name, c_acctbal, row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT n_name AS country, c_mktsegment, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2), sk AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY n DESC, c_mktsegment) AS k FROM s)
SELECT n_name AS country, (SELECT string_agg(c_name, ',' ORDER BY k) FROM c WHERE c.country = n_name AND k <= 3) AS entities, (SELECT string_agg(c_mktsegment || ':' || n, ',' ORDER BY k) FROM sk WHERE sk.country = n_name AND k <= 2) AS segments FROM nation""")
def country_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each country with arrays of its first entities and segments."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_name").alias("country"), "n_nationkey")
    rows = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    best = R.top_per_group(rows, ["country"], [F.desc("c_acctbal"), "c_custkey"], 3).groupBy("country").agg(merging.collected(F.col("position"), F.col("c_name").alias("x")).alias("entities"))
    sizes = rows.groupBy("country", "c_mktsegment").agg(F.count("*").alias("n"))
    segments = R.top_per_group(sizes, ["country"], [F.desc("n"), "c_mktsegment"], 2).groupBy("country").agg(merging.collected(F.col("position"), F.concat_ws(":", "c_mktsegment", F.col("n").cast("string")).alias("x")).alias("segments"))
    shown = lambda c: F.array_join(F.transform(c, lambda s: s["x"]), ",").alias(c)
    return nation.select("country").join(best, "country", "left").join(segments, "country", "left").select("country", shown("entities"), shown("segments"))


@query("""SELECT g.id AS numeric_id, n_name AS country, count(c_custkey) AS entities FROM (SELECT unnest(range(0, 30)) AS id) g LEFT JOIN nation ON id = n_nationkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2""")
def map_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapes of a map with what is known of their countries; shapes without data stay."""
    counts = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    known = table(spark, sf_dir, "nation").join(counts, "n_nationkey", "left").select(F.col("n_nationkey").cast("long").alias("numeric_id"), F.col("n_name").alias("country"), "n")
    return spark.range(30).withColumnRenamed("id", "numeric_id").join(known, "numeric_id", "left").select("numeric_id", "country", F.coalesce("n", F.lit(0)).alias("entities"))


@query("""SELECT 'supplier' AS kind, s_name AS name, s_acctbal AS balance, NULL AS segment FROM supplier UNION ALL SELECT 'customer', c_name, c_acctbal, c_mktsegment FROM customer""")
def union_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return snapshots.union_all([suppliers, customers])


@query("""SELECT c_name, rank, row_number() OVER (ORDER BY rank NULLS LAST, lower(c_name)) AS position FROM (SELECT c_name, CASE WHEN c_acctbal > 0 THEN floor(c_acctbal / 1000)::BIGINT END AS rank FROM customer) ORDER BY position LIMIT 200""")
def nulls_last_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of a directory: by rank, the unranked last, then by name whatever its case."""
    rows = table(spark, sf_dir, "customer").select("c_name", F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") / 1000)).alias("rank"))
    order = [F.col("rank").asc_nulls_last(), F.lower("c_name")]
    return rows.orderBy(*order).limit(200).withColumn("position", F.row_number().over(Window.orderBy(*order)))


@query("""WITH n AS (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE upper(p_name) END AS name FROM part) SELECT name, row_number() OVER (ORDER BY lower(name), name = upper(name)) AS position FROM n""")
def locale_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in the order of readers: letters before case, small letters first; ranges of that order are sorted by a task each."""
    names = table(spark, sf_dir, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.upper("p_name")).alias("name")).distinct()
    return ordered.with_numbers(names, [], [F.collate("name", "UNICODE")], "position")


KIND_SQL = "CASE " + " ".join(f"WHEN regexp_matches(lower(path), '{pattern}') THEN {web.KIND_POINTS[name]}" for name, pattern in web.LINK_KINDS) + " ELSE 0 END"


@query(f"""WITH l AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS href FROM pages), p AS (SELECT *, regexp_extract(href, '^([^?#]*)', 1) AS path FROM l),
f AS (SELECT page_id, href, 20 + {KIND_SQL} + {web.SAME_HOST_POINTS} - {web.DEPTH_POINTS} * greatest(len(list_filter(string_split(path, '/'), lambda x: x <> '')) - 1, 0) AS priority FROM p)
SELECT page_id, href, priority, row_number() OVER (PARTITION BY page_id ORDER BY priority DESC, href) AS position FROM f QUALIFY position <= 3""")
def page_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three links of each page to follow first."""
    links = D.html_parts(table(spark, sf_dir, "pages")).select("page_id", "url", F.explode("links.href").alias("href")).distinct()
    home = web.host(F.col("url"))
    full = F.concat(F.lit("https://"), home, F.col("href"))
    scored = links.withColumn("priority", web.page_priority(full, F.lit(20), home))
    return R.top_per_group(scored, ["page_id"], [F.desc("priority"), "href"], 3).select("page_id", "href", "priority", "position")


SCOPES = """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'overall' WHEN 1 THEN '' WHEN 2 THEN 'academic-' || lower(p_type) ELSE lower(p_type) END AS scope, 1995 + p_size % 7 AS year FROM part"""


def _scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_partkey") % 5
    scope = F.when(kind == 0, "overall").when(kind == 1, "").when(kind == 2, F.concat(F.lit("academic-"), F.lower("p_type"))).otherwise(F.lower("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", scope.alias("ranking_scope"), (1995 + F.col("p_size") % 7).alias("year"))


@query(f"""SELECT p_partkey, scope AS ranking_scope FROM ({SCOPES}) WHERE scope NOT IN ('overall', '') AND NOT starts_with(scope, 'academic-')""")
def subject_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.subject_rows(_scopes(spark, sf_dir)).select("p_partkey", "ranking_scope")


@query(f"""WITH s AS ({SCOPES}), first(scope, year) AS (VALUES ('economy', 1997), ('promo', 1999), ('academic-promo', 2003)) SELECT p_partkey, s.scope AS ranking_scope FROM s LEFT JOIN first ON s.scope = first.scope WHERE coalesce(first.year, 1998) <= 1998""")
def subjects_in_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scopes that existed in 1998."""
    launches = spark.createDataFrame([("economy", 1997), ("promo", 1999), ("academic-promo", 2003)], "ranking_scope string, first_year int")
    return snapshots.open_scopes(_scopes(spark, sf_dir).drop("year"), launches, 1998)


@query("""SELECT l_orderkey, l_linenumber, d AS display FROM (SELECT *, CASE l_linenumber % 7 WHEN 0 THEN '' WHEN 1 THEN '-' WHEN 2 THEN ' N/A' WHEN 3 THEN 'Not Ranked' WHEN 4 THEN '=' || l_partkey ELSE l_partkey::VARCHAR END AS d FROM lineitem) WHERE l_linenumber % 7 > 3""")
def ranked_at_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, part = F.col("l_linenumber") % 7, F.col("l_partkey").cast("string")
    display = F.when(k == 0, "").when(k == 1, "-").when(k == 2, " N/A").when(k == 3, "Not Ranked").when(k == 4, F.concat(F.lit("="), part)).otherwise(part)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", display.alias("display")).where(numbers.is_ranked(F.col("display")))


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 10 AND l_returnflag = 'N' AND year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem)""")
def quality_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the latest year that meet every condition on a column that the table has."""
    items = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    latest = items.agg(F.max("year").alias("latest"))
    kept = merging.quality_filter(items, {"l_quantity": F.col("l_quantity") >= 10, "l_returnflag": F.col("l_returnflag") == "N", "core_only": F.col("core_only")})
    return kept.join(F.broadcast(latest), F.col("year") == F.col("latest"), "left_semi").select("l_orderkey", "l_linenumber")


@query(f"""WITH {RANKED}, {NATIONS}, c AS (SELECT entity, count(*) AS coverage FROM ranked GROUP BY 1) SELECT entity, c_name AS name, country, coverage FROM c JOIN customer ON entity = c_custkey JOIN nations USING (entity) WHERE contains(lower(c_name), '#00000') AND country = 'NATION_7' AND coverage >= 4""")
def coverage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The finder's form: a part of the name, a country, providers at least."""
    covered = ranked(spark, sf_dir).groupBy("entity").agg(F.count("*").alias("coverage")).where("coverage >= 4")
    named = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"), F.col("c_name").alias("name")).where(F.contains(F.lower("name"), F.lit("#00000")))
    return covered.join(named, "entity").join(nations(spark, sf_dir).where("country = 'NATION_7'"), "entity").select("entity", "name", "country", "coverage")


@query("""SELECT c_custkey, c_name FROM customer WHERE contains(lower(c_name), 'r#00000001') ORDER BY c_name LIMIT 5""")
def name_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command line's search: part of a name, at most five."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name").where(F.contains(F.lower("c_name"), F.lower(F.lit("R#00000001"))))
    return rows.orderBy("c_name").limit(5)


@query("""SELECT s_suppkey, c_custkey, h1 = h2 OR ends_with(h1, '.' || h2) OR ends_with(h2, '.' || h1) AS same FROM (SELECT s_suppkey, c_custkey, 'u' || s_suppkey % 5 || '.edu' AS h1, CASE c_custkey % 3 WHEN 0 THEN 'u' ELSE 'law.u' END || c_custkey % 5 || '.edu' AS h2 FROM supplier JOIN customer ON s_nationkey = c_nationkey)""")
def same_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a nation, so rows grow with the square of its size; what is shuffled grows as the tables do."""
    a = F.concat(F.lit("www.U"), (F.col("s_suppkey") % 5).cast("string"), F.lit(".edu"))
    b = F.concat(F.when(F.col("c_custkey") % 3 == 0, "u").otherwise("law.u"), (F.col("c_custkey") % 5).cast("string"), F.lit(".edu"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), web.bare_host(a).alias("value"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), web.bare_host(b).alias("value"))
    tasks = max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    pairs = matching.group_pairs(suppliers, customers, "nation", web.same_bare, tasks)
    return pairs.select(F.col("few_id").alias("s_suppkey"), F.col("many_id").alias("c_custkey"), F.col("verdict").alias("same"))



STATUSES, EXCEPTIONS = (503, 404, 429, 403, None, None, None, None), (None, None, None, None, "TimeoutError", "RobotsError", "OddException", None)


@query("""WITH k AS (SELECT event_id, ['transient', 'absent', 'transient', 'refused', 'transient', 'refused', 'refused', NULL][event_id % 8 + 1] AS kind FROM events)
SELECT event_id, kind, kind IS NULL OR kind IN ('transient', 'absent') AS again FROM k""")
def retry_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each failed request means, and whether it is made again."""
    pick = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("event_id") % 8)
    status, exception = pick(STATUSES, "int"), pick(EXCEPTIONS, "string")
    return table(spark, sf_dir, "events").select("event_id", web.failure_class(status, exception).alias("kind"), web.retries(status, exception, ("transient", "absent")).alias("again"))


@query("""WITH d AS (SELECT DISTINCT o_custkey AS entity, 'd' || o_orderkey % 4 || '.edu' AS domain, CASE WHEN o_orderstatus = 'P' THEN 'registry' ELSE o_orderpriority END AS provider FROM orders) SELECT entity, domain FROM d GROUP BY 1, 2 HAVING count(DISTINCT provider) >= 2 OR bool_or(provider = 'registry')""")
def agreed_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), F.concat(F.lit("d"), (F.col("o_orderkey") % 4).cast("string"), F.lit(".edu")).alias("domain"), F.when(F.col("o_orderstatus") == "P", "registry").otherwise(F.col("o_orderpriority")).alias("provider"))
    return matching.agreed_domains(rows)


@query("""WITH c AS (SELECT c_custkey, ['CN', 'FR', 'NO', 'US', 'DE'][c_custkey % 5 + 1] AS expected, ['HK', 'GF', 'SJ', 'PR', 'DE', 'US'][c_nationkey % 6 + 1] AS found FROM customer)
SELECT c_custkey, expected = found OR (expected, found) IN (('CN', 'HK'), ('FR', 'GF'), ('NO', 'SJ'), ('US', 'PR')) AS same FROM c""")
def territory_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda values, k: F.get(F.array(*map(F.lit, values)), k)
    expected, found = pick(["CN", "FR", "NO", "US", "DE"], F.col("c_custkey") % 5), pick(["HK", "GF", "SJ", "PR", "DE", "US"], F.col("c_nationkey") % 6)
    return table(spark, sf_dir, "customer").select("c_custkey", places.same_country(expected, F.array(found)).alias("same"))


@query("""SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 80 WHEN 1 THEN 55 WHEN 2 THEN -20 ELSE 0 END AS score FROM supplier""")
def evidence_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well a sentence supports a year: by name, by "the university", by a part of it, not at all."""
    k, year = F.col("s_suppkey") % 4, (1800 + F.col("s_suppkey") % 200).cast("string")
    text = (
        F.when(k == 0, F.concat("s_name", F.lit(" was founded in "), year)).when(k == 1, F.concat(F.lit("Our university began in "), year))
        .when(k == 2, F.concat("s_name", F.lit(" has a School of Law since "), year)).otherwise(F.concat(F.lit("In "), year, F.lit(" it rained.")))
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", facts.evidence_score(text, F.col("s_name"), F.col("s_suppkey") % 200 + 1800).alias("score"))


@query("""WITH c AS (SELECT o_custkey AS seed, o_orderkey AS record, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END AS priority, o_orderkey % 25 AS country FROM orders WHERE o_orderstatus <> 'P'),
ok AS (SELECT c.* FROM c JOIN customer ON seed = c_custkey WHERE abs(c_nationkey - country) <= 6), best AS (SELECT *, count(*) OVER (PARTITION BY seed, priority) AS n, min(priority) OVER (PARTITION BY seed) AS first FROM ok)
SELECT c_custkey AS seed, record, priority, CASE WHEN record IS NULL THEN 'no candidate in the country' END AS failure FROM customer LEFT JOIN (SELECT seed, min(record) AS record, priority FROM best WHERE priority = first AND (priority < 4 OR n = 1) GROUP BY 1, 3) b ON c_custkey = seed""")
def registry_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity by the first kind of evidence that holds: kinds in order, records of another country rejected, the last
    kind only where it is unique; seeds without any are failures."""
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).when(F.col("o_orderpriority") == "3-MEDIUM", 3).otherwise(4)
    seeds = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("seed"), F.col("c_nationkey").alias("expected"))
    candidates = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_custkey").alias("seed"), F.col("o_orderkey").alias("record"), kind.alias("priority"), (F.col("o_orderkey") % 25).alias("found"))
    return matching.identities(seeds, candidates, F.abs(F.col("expected") - F.col("found")) <= 6, unique_from=4)


@query("""WITH c AS (SELECT o_custkey AS entity, 'https://s' || o_orderkey % 9 || '.edu' AS site, min(o_orderkey) AS priority, bool_or(o_orderstatus = 'O') AS answered FROM orders GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY priority) AS k FROM c WHERE answered)
SELECT entity, (SELECT site FROM k WHERE k.entity = c.entity AND k = 1) AS website, (SELECT count(*) FROM k WHERE k.entity = c.entity AND k > 1) AS others, count(*) FILTER (WHERE NOT answered) AS failed FROM c GROUP BY entity""")
def website_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entity's website: the first candidate that answered; what else answered and what failed is counted as warnings."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), F.concat(F.lit("https://s"), (F.col("o_orderkey") % 9).cast("string"), F.lit(".edu")).alias("site"), "o_orderkey", "o_orderstatus")
    candidates = rows.groupBy("entity", "site").agg(F.min("o_orderkey").alias("priority"), F.max(F.col("o_orderstatus") == "O").alias("answered"))
    return candidates.groupBy("entity").agg(
        F.min_by("site", F.when(F.col("answered"), F.col("priority"))).alias("website"),
        F.greatest(F.count_if("answered") - 1, F.lit(0)).alias("others"), F.count_if(~F.col("answered")).alias("failed"),
    )


@query("""WITH ind AS (SELECT l_suppkey AS entity, sum(CAST(l_quantity AS DECIMAL(18,2))) AS scale, round_even(sum(CAST(l_discount AS DECIMAL(18,2)))::DOUBLE / count(*), 9) AS impact FROM lineitem GROUP BY 1),
r AS (SELECT entity, rank() OVER (ORDER BY scale DESC) AS a, rank() OVER (ORDER BY impact DESC) AS b FROM ind) SELECT count(*) FILTER (WHERE a <= 50 AND b <= 50) AS in_both, count(*) FILTER (WHERE a <= 50) AS large, max(b) FILTER (WHERE a <= 10) AS lowest, count(*) AS n FROM r""")
def scale_impact_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the largest are also the strongest."""
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("entity")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("scale"), F.bround(F.sum(F.col("l_discount").cast("decimal(18,2)")).cast("double") / F.count("*"), 9).alias("impact"),
    )
    placed = R.range_ranked(R.range_ranked(items, [], "scale", "a"), [], "impact", "b")
    return placed.agg(merging.in_both(F.col("a"), F.col("b"), 50).alias("in_both"), F.count_if(F.col("a") <= 50).alias("large"), F.max(F.when(F.col("a") <= 10, F.col("b"))).alias("lowest"), F.count("*").alias("n"))


@query(f"""WITH {RANKED}, {NATIONS}, m AS (SELECT country, count(*) FILTER (WHERE rank <= 100) AS top100, min(rank) AS best, round_even(avg(rank), 6) AS mean, count(DISTINCT entity) AS entities FROM ranked JOIN nations USING (entity) GROUP BY 1),
o AS (SELECT country, count(*) AS orders FROM orders JOIN nations ON o_custkey = entity GROUP BY 1) SELECT country, top100, best, mean, entities, orders FROM m JOIN o USING (country)""")
def country_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Further metrics of a country: places, the best and mean rank, entities and volume."""
    where = nations(spark, sf_dir)
    rows = ranked(spark, sf_dir).join(where, "entity")
    per = rows.groupBy("country").agg(F.count_if(F.col("rank") <= 100).alias("top100"), F.min("rank").alias("best"), F.bround(F.avg("rank"), 6).alias("mean"), F.countDistinct("entity").alias("entities"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity")).join(where, "entity").groupBy("country").agg(F.count("*").alias("orders"))
    return per.join(orders, "country")
