"""Queries that write the driver's rows in a publisher's format and read them back through the sources."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.operators import relational as R
from podium.plans.base import table
from podium.plans.registry import registry
from podium.sources import documents as D
from podium.sources import landing, paged, sinks, snapshots

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registry(QUERIES, ORACLES)


@query("""SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name || ', "' || p_brand || '"' END AS name, CASE WHEN p_size > 25 THEN 'True' ELSE 'False' END AS large,
'{"brand": "' || p_brand || '", "sizes": [' || p_size || ', ' || p_size + 1 || '], "note": null}' AS detail FROM part""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV with quotes, commas, line breaks of no harm, blanks, booleans and nested cells."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 4 != 0, F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"'))).alias("name"), (F.col("p_size") > 25).alias("large"),
        F.struct(F.col("p_brand").alias("brand"), F.array("p_size", F.col("p_size") + 1).alias("sizes"), F.lit(None).cast("string").alias("note")).alias("detail"),
    )
    path = landing.folder(spark, "parts.csv")
    sinks.write_csv(parts, path)
    return snapshots.read_table(spark, path).drop("__path", "__ord")


@query("""SELECT l_orderkey::VARCHAR AS id, l_linenumber::VARCHAR AS line, l_returnflag || '; ' || l_linestatus AS flags FROM lineitem""")
def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated, splittable."""
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.concat_ws("; ", "l_returnflag", "l_linestatus").alias("flags"))
    path = landing.folder(spark, "items.tsv")
    sinks.write_csv(items, path, "\t")
    return snapshots.read_table(spark, path, "\t", multi_line=False).drop("__path", "__ord")


@query("""SELECT o_custkey AS customer, o_orderkey AS id, o_orderstatus AS status FROM orders""")
def json_list_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents with a list each; nulls in the list say nothing."""
    rows = table(spark, sf_dir, "orders").groupBy(F.pmod("o_custkey", F.lit(50)).alias("page")).agg(
        F.concat(F.collect_list(F.struct(F.col("o_custkey").alias("customer"), F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))), F.array(F.lit(None))).alias("items")
    )
    path = landing.folder(spark, "orders.json")
    rows.write.option("ignoreNullFields", False).json(path)
    read = spark.read.schema("items array<struct<customer:long,id:long,status:string>>").json(path)
    return read.select(F.explode(F.filter("items", lambda x: x.isNotNull())).alias("x")).select("x.*")


def _archive(spark: SparkSession, sf_dir: str) -> str:
    """A folder of snapshots, a CSV and a manifest for each priority and year, written once a session."""

    def write() -> str:
        folder = landing.folder(spark, "archive")
        orders = table(spark, sf_dir, "orders").select(
            F.lower(F.regexp_replace("o_orderpriority", r"^\d-| ", "")).alias("source"), F.year("o_orderdate").alias("ranking_year"), F.when(F.col("o_orderstatus") == "P", "overall").otherwise("science").alias("ranking_scope"),
            F.col("o_custkey").alias("entity"), F.col("o_totalprice").alias("score"),
        )
        place = F.when(F.col("ranking_year") % 2 == 0, "worldwide").otherwise("europe")
        rows = orders.withColumn("stem", F.concat_ws("_", "source", place, F.lit("all"), F.lit("rankings"), F.col("ranking_year").cast("string")))
        sinks.write_snapshots(rows, folder, "stem")
        told = sinks.manifest(rows.where("ranking_year <> 1996"), ["source", "ranking_year", "stem"]).withColumn("ranking_year", F.when(F.col("ranking_year") % 3 != 0, F.col("ranking_year")))
        sinks.write_snapshots(told, folder, "stem", "json", ".manifest.json")
        return folder

    return landing.memoised(spark, ("archive", sf_dir), write)


ARCHIVE = """a AS (SELECT lower(regexp_replace(o_orderpriority, '^[0-9]-| ', '', 'g')) AS source, year(o_orderdate) AS edition, * FROM orders WHERE year(o_orderdate) <> 1996),
snap AS (SELECT source, edition, source || '_' || CASE WHEN edition % 2 = 0 THEN 'worldwide' ELSE 'europe' END || '_all_rankings_' || edition || '.csv' AS file_name, count(*) AS records, count(*) FILTER (WHERE o_orderstatus = 'P') AS overall FROM a GROUP BY 1, 2)"""


@query(f"""WITH {ARCHIVE} SELECT source, edition, file_name, edition % 2 = 0 AS is_global, records, overall FROM snap""")
def snapshot_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests whose CSV is there; the edition of every third comes from the file's name."""
    found = snapshots.catalogue(spark, _archive(spark, sf_dir))
    return found.select("source", "edition", F.regexp_replace("file_name", "%20", " ").alias("file_name"), "is_global", "records", F.coalesce(F.try_element_at("records_by_scope", F.lit("overall")), F.lit(0)).alias("overall"))


@query(f"""WITH {ARCHIVE}, l AS (SELECT source, max(edition) AS edition FROM snap WHERE edition % 2 = 0 GROUP BY 1) SELECT a.source, a.edition, count(*) AS n, round_even(sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE, 2) AS score FROM a JOIN l ON a.source = l.source AND a.edition = l.edition GROUP BY 1, 2""")
def snapshot_latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each source's latest worldwide snapshot; only the chosen files are read."""
    chosen = snapshots.latest(snapshots.catalogue(spark, _archive(spark, sf_dir)).where("is_global"))
    paths = [r["path"] for r in chosen.select("path").collect()]  # a path a publisher
    rows = snapshots.read_table(spark, paths)
    name = F.element_at(F.split("__path", "/"), -1)
    told = rows.select(F.col("source"), F.regexp_extract(name, r"_(\d{4})\.csv$", 1).cast("int").alias("edition"), F.col("score").cast("decimal(18,2)").alias("score"))
    return told.groupBy("source", "edition").agg(F.count("*").alias("n"), F.sum("score").alias("score"))


@query(f"""WITH {ARCHIVE} SELECT source, edition, max(file_name) AS file_name FROM snap GROUP BY 1, 2""")
def snapshot_latest_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = snapshots.catalogue(spark, _archive(spark, sf_dir))
    return snapshots.latest(found, ("source", "edition")).select("source", "edition", "file_name")


@query(f"""WITH {ARCHIVE} SELECT source, edition, min(file_name) AS file_name FROM snap GROUP BY 1, 2""")
def snapshot_first_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.first_path(snapshots.catalogue(spark, _archive(spark, sf_dir))).select("source", "edition", "file_name")


@query(f"""WITH {ARCHIVE} SELECT max(edition) AS edition, arg_max(file_name, edition) AS file_name FROM snap WHERE regexp_matches(file_name, '^urgent_worldwide_all_rankings_[0-9]{{4}}[.]csv$')""")
def snapshot_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest file of a name's pattern, whatever its manifest says."""
    found = snapshots.catalogue(spark, _archive(spark, sf_dir))
    return snapshots.latest_named(found, r"^urgent_worldwide_all_rankings_(\d{4})\.csv$").select("edition", "file_name")


@query("""SELECT DISTINCT regexp_extract(url, '^https?://([^/]+)', 1) AS host, url FROM pages""")
def sitemap_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sitemap for each host of the pages, every other address in CDATA, some twice."""
    loc = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("<url><loc><![CDATA["), "url", F.lit("]]></loc></url>"))).otherwise(F.concat(F.lit("<url><loc> "), "url", F.lit(" </loc></url><url><loc>"), "url", F.lit("</loc></url>")))
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), loc.alias("loc"))
    maps = pages.groupBy("host").agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list("loc"), "\n"), F.lit("</urlset>")).alias("xml"))
    return D.sitemap_urls(maps, "xml").select("host", "url")


ROBOTS = "User-agent: *\nDisallow: /t\nAllow: /the\nDisallow: /*,$\n\nUser-agent: otherbot\nUser-agent: PodiumBot/2.0 # ours\nDisallow: /and\nDisallow:\nAllow: /%61nd"


@query("""WITH l AS (SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*href=["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS path FROM pages), agents(agent) AS (VALUES ('PodiumBot/1.0 (test)'), ('anybot')),
rules(ours, path, allow) AS (VALUES (false, '/t', false), (false, '/the', true), (true, '/and', false), (true, '/and', true)),
met AS (SELECT l.page_id, l.path, agent, max(length(r.path) * 10 + allow::INT) AS best FROM l CROSS JOIN agents JOIN rules r ON r.ours = (agent LIKE 'Podium%') AND starts_with(l.path, r.path) GROUP BY 1, 2, 3)
SELECT l.page_id, l.path, agents.agent, CASE WHEN agents.agent = 'anybot' AND ends_with(l.path, ',') AND coalesce(best, 0) < 40 THEN false ELSE coalesce(best % 10 = 1, true) END AS allowed FROM l CROSS JOIN agents LEFT JOIN met ON met.page_id = l.page_id AND met.path = l.path AND met.agent = agents.agent""")
def robots_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages under a robots.txt with a general group and one of our own."""
    links = D.html_parts(table(spark, sf_dir, "pages")).select("page_id", F.explode("links.href").alias("path")).distinct()
    requests = links.select("page_id", "path", F.explode(F.array(F.lit("PodiumBot/1.0 (test)"), F.lit("anybot"))).alias("agent"))
    rules = D.robots_rules(table(spark, sf_dir, "pages").select("page_id", F.lit(ROBOTS).alias("robots")), "page_id", "robots")
    return D.robots_allow(requests, rules, "page_id").select("page_id", "path", "agent", "allowed")


@query("""SELECT s_nationkey AS doc, s_suppkey + 1 AS rank, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN '/s/' || s_suppkey END AS url, CASE WHEN s_suppkey % 2 = 1 THEN s_suppkey / 2.0 END::DOUBLE AS share, CASE WHEN s_suppkey % 2 = 1 THEN 1000 + s_suppkey END::DOUBLE AS articles FROM supplier""")
def markdown_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rankings in Markdown: numbered links, and tables with two metrics."""
    rank = (F.col("s_suppkey") + 1).cast("string")
    line = F.when(F.col("s_suppkey") % 2 == 0, F.concat(rank, F.lit(". ["), "s_name", F.lit("](/s/"), F.col("s_suppkey").cast("string"), F.lit(")"))).otherwise(
        F.concat(F.lit("| "), rank, F.lit(" | "), "s_name", F.lit(" | "), (F.col("s_suppkey") / 2).cast("string"), F.lit("% | "), F.format_number(1000 + F.col("s_suppkey"), 0), F.lit(" |"))
    )
    texts = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("doc")).agg(F.array_join(F.concat(F.array(F.lit("# Ranking\n"), F.lit("| Rank | Name | Share | Articles |"), F.lit("|---|---|---|---|")), F.collect_list(line)), "\n").alias("text"))
    return D.markdown_ranking(texts, "text").select("doc", "rank", "name", "url", F.get("metrics", F.lit(0)).alias("share"), F.get("metrics", F.lit(1)).alias("articles"))


@query("""WITH r AS (SELECT s_nationkey AS doc, CASE WHEN s_suppkey % 10 = 9 THEN 1 ELSE s_suppkey + 1 END AS rank, CASE WHEN s_suppkey % 7 = 0 THEN 'same' ELSE s_name END AS name, s_suppkey FROM supplier), b AS (SELECT *, lag(rank) OVER (PARTITION BY doc ORDER BY s_suppkey) AS before FROM r)
SELECT doc, 'rank falls' AS fault, count(*) AS n FROM b WHERE rank < before GROUP BY 1 UNION ALL SELECT doc, 'repeated name', count(*) FROM (SELECT doc, name FROM r GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1""")
def ranking_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("doc"), F.when(F.col("s_suppkey") % 10 == 9, 1).otherwise(F.col("s_suppkey") + 1).alias("rank"), F.when(F.col("s_suppkey") % 7 == 0, "same").otherwise(F.col("s_name")).alias("name"), "s_suppkey")
    return D.ranking_faults(rows, ["doc"], "s_suppkey", "name")


@query("""SELECT c_nationkey AS page, c_custkey AS rank, c_name || ' & Sons' AS institution, c_mktsegment AS field FROM customer""")
def html_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking among a page's tables: that whose header has the needed columns."""
    cell = F.concat(F.lit("<tr><td> "), F.col("c_custkey").cast("string"), F.lit("<sup></sup></td><td><a href='#'>"), "c_name", F.lit("</a> &amp;\n Sons</td><td>"), "c_mktsegment", F.lit("</td></tr>"))
    body = F.array_join(F.collect_list(cell), "")
    html = F.concat(F.lit("<table><tr><th>Menu</th></tr></table><table><thead><tr><th>World Rank</th><th>Institution</th><th>Field</th></tr></thead>"), body, F.lit("</table>"))
    pages = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("page")).agg(html.alias("html"))
    rows = D.html_tables(pages, "page", "html", ("World Rank", "Institution"))
    held = lambda name: F.try_element_at("cells", F.lit(name))
    return rows.select("page", held("world_rank").cast("long").alias("rank"), held("institution").alias("institution"), held("field").alias("field"))


@query("""SELECT s_nationkey AS page, s_suppkey + 1 AS rank, s_name || ' of ' || s_nationkey AS name, (s_suppkey + 1) * 1000 AS closing FROM supplier""")
def fragment_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows out of positioned fragments, as a page of a printed ranking has them."""
    rank, far = F.format_number(F.col("s_suppkey") + 1, 0), F.format_number((F.col("s_suppkey") + 1) * 1000, 0)
    piece = lambda k, x, text: F.struct((F.col("s_suppkey") * 10 + k).alias("ord"), F.lit(x).alias("x"), text.alias("text"))
    pieces = F.array(piece(0, 10.0, rank), piece(1, 80.0, F.col("s_name")), piece(2, 200.0, F.concat(F.lit("of "), F.col("s_nationkey").cast("string"))), piece(3, 500.0, far))
    fragments = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("page"), F.explode(pieces).alias("f")).select("page", "f.*")
    return D.fragment_rows(fragments, 50.0, 400.0)


@query("""SELECT p_partkey AS id, 0 AS node, 'Product' AS kind, p_name AS name FROM part UNION ALL SELECT p_partkey, 1, 'Offer', NULL FROM part UNION ALL SELECT p_partkey, 2, 'Organization', p_brand FROM part""")
def json_ld_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured data of pages, nested nodes in order; broken blocks say nothing."""
    told = F.to_json(F.struct(F.lit("Product").alias("@type"), F.col("p_name").alias("name"), F.array(F.struct(F.array(F.lit("Offer")).alias("@type"), F.struct(F.lit("Organization").alias("@type"), F.struct(F.col("p_brand").alias("@value")).alias("name")).alias("seller"))).alias("offers")))
    html = F.concat(F.lit('<head><script type="application/ld+json">{broken</script><script type="application/ld+json">'), told, F.lit("</script></head>"))
    pages = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), html.alias("html"))
    return D.json_ld(pages, "id", "html").where(F.col("kind").isin("Product", "Offer", "Organization")).select("id", F.col("node").cast("int").alias("node"), "kind", "name")


@query("""SELECT k // 100 + 1 AS page, k AS id, 'entry ' || k AS name FROM (SELECT unnest(range(0, 2000)) AS k)""")
def paged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A paged source, a partition a page."""
    paged.register(spark, "podium_pages", "page long, id long, name string", 20, lambda page: ((page, k, f"entry {k}") for k in range((page - 1) * 100, page * 100)))
    return spark.read.format("podium_pages").load()


@query("""SELECT k AS id, (k * k) % 97 AS value FROM (SELECT unnest(range(0, 700)) AS k)""")
def cursor_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source that tells its next cursor with each page."""

    def fetch(cursor: str) -> tuple[list[tuple], str | None]:
        begin = 0 if cursor == "*" else json.loads(cursor)["at"]
        return [(k, k * k % 97) for k in range(begin, begin + 70)], json.dumps({"at": begin + 70}) if begin + 70 < 700 else None

    paged.register_cursor(spark, "podium_cursor", "id long, value long", fetch)
    return spark.read.format("podium_cursor").load()


@query("""SELECT event_id, (props->>'$.k')::BIGINT AS score, props->>'$.z' AS other FROM events""")
def indicator_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded indicators of a JSON object as columns."""
    found = snapshots.indicators(table(spark, sf_dir, "events"), "props", {"k": "score", "z": "other"})
    return found.select("event_id", F.col("score").cast("long").alias("score"), "other")


@query("""SELECT c_custkey AS entity, count(o_orderkey) FILTER (WHERE year(o_orderdate) = 1997) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def yearly_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One year out of an entity's array of yearly counts."""
    yearly = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity"), F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    held = yearly.groupBy("entity").agg(F.collect_list(F.struct("year", "n")).alias("counts_by_year"))
    return held.select("entity", F.coalesce(snapshots.of_year(F.col("counts_by_year"), 1997)["n"], F.lit(0)).alias("n"))


SEEDS = """seed AS (SELECT c_custkey AS id, c_name AS name, 'N' || c_nationkey AS country_code, floor(c_acctbal / 100)::BIGINT AS rank FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 5 <> 0)"""


def _seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country_code"),
        F.floor(F.col("c_acctbal") / 100).alias("rank"), F.when(F.col("c_mktsegment") == "BUILDING", "overall").otherwise("science").alias("ranking_scope"),
    )
    return snapshots.seeds(rows, "id").select("id", "name", "country_code", "rank")


@query(f"""WITH {SEEDS} SELECT * FROM seed""")
def seed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seeds(spark, sf_dir)


@query(f"""WITH {SEEDS} SELECT name, country_code, rank FROM seed UNION ALL SELECT s_name, 'N' || s_nationkey, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey ELSE s_suppkey % 50 END FROM supplier WHERE s_suppkey % 2 = 0""")
def seed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeds, and the directory's entities that the seeds' own source does not rank."""
    key = F.col("s_suppkey")
    ranks = F.when(key % 2 == 0, F.create_map(F.lit("b"), key % 50, F.lit("c"), key % 50 + 7)).otherwise(F.create_map(F.lit("a"), key, F.lit("b"), key))
    directory = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("country_code"), F.when(key % 3 == 0, key).alias("consensus_rank"), ranks.alias("ranks"))
    return snapshots.seed_union(_seeds(spark, sf_dir), directory, "a")


@query("""SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE 'Alias of ' || s_name END AS label, CASE WHEN s_suppkey % 4 = 0 THEN 'https://b.' || s_suppkey || '.org' WHEN s_suppkey % 4 = 1 THEN 'http://a.' || s_suppkey || '.org' ELSE 'https://d' || s_suppkey || '.org' END AS website, 'N' || s_nationkey AS country FROM supplier""")
def registry_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry items flattened: the label, the website to prefer, the country."""
    key = F.col("s_suppkey").cast("string")
    site = lambda prefix: F.struct(F.lit("website").alias("type"), F.concat(F.lit(prefix), key, F.lit(".org")).alias("value"))
    alias = F.struct(F.concat(F.lit("Alias of "), "s_name").alias("value"), F.array(F.lit("alias")).alias("types"))
    display = F.struct(F.col("s_name").alias("value"), F.array(F.lit("label"), F.lit("ror_display")).alias("types"))
    none = F.expr("cast(array() as array<struct<type:string,value:string>>)")
    items = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.lit("active").alias("status"), F.when(F.col("s_suppkey") % 3 == 0, F.array(alias, display)).otherwise(F.array(alias)).alias("names"),
        F.when(F.col("s_suppkey") % 4 == 0, F.array(site("http://a."), site("https://b."))).when(F.col("s_suppkey") % 4 == 1, F.array(site("http://a."))).otherwise(none).alias("links"),
        F.array(F.concat(F.lit("d"), key, F.lit(".org"))).alias("domains"), F.array(F.struct(F.struct(F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("country_code")).alias("geonames_details"))).alias("locations"),
    )
    return snapshots.registry_records(items).select("id", "label", "website", F.get("country_codes", F.lit(0)).alias("country"))


@query("""SELECT 'pub' AS source, '2024-01-01' AS retrieved_at, 'overall' AS ranking_scope, 2024 AS ranking_year, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey::VARCHAR ELSE '=' || s_suppkey END AS rank_display, s_name AS name, CASE WHEN s_suppkey % 4 = 0 THEN 'N' || s_nationkey END AS country_raw, s_acctbal::VARCHAR AS total FROM supplier""")
def canonical_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A publisher's columns renamed, dropped, stamped, backfilled and mapped to the canonical ones."""
    key = F.col("s_suppkey")
    raw = table(spark, sf_dir, "supplier").select(
        key.cast("string").alias("rank"), F.when(key % 3 == 0, " ").otherwise(F.concat(F.lit("="), key.cast("string"))).alias("display"), F.lit("").alias("title"), F.col("s_name").alias("univNameEn"),
        F.array(F.struct(F.lit("x").alias("value"), F.lit("other").alias("label")), F.struct(F.when(key % 4 == 0, F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))).alias("value"), F.lit("country").alias("label"))).alias("stats"), F.col("s_acctbal").cast("string").alias("scoreTotal"), F.lit("junk").alias("logo"),
    )
    named = snapshots.backfilled(raw.withColumnsRenamed({"univNameEn": "name_en", "scoreTotal": "total"}), "display", "rank")
    named = named.withColumn("country", snapshots.labelled(F.col("stats"), "country"))
    told = snapshots.canonical(named, ["display", "rank"], ["title", "name_en", "absent"], ["country"])
    out = snapshots.stamped(told, "pub", "overall", 2024, "2024-01-01", drop=["logo", "stats", "rank", "display", "title", "name_en", "country"])
    return out.select(*snapshots.LEADING, "rank_display", "name", "country_raw", "total")


@query("""SELECT DISTINCT p_type AS ranking_scope, 'old' AS error FROM part WHERE p_type NOT IN ('ECONOMY', 'PROMO') UNION ALL SELECT DISTINCT p_type, 'new' FROM part WHERE p_type = 'PROMO'""")
def failure_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures of scopes that were tried again give way to the new ones."""
    scopes = table(spark, sf_dir, "part").select(F.col("p_type").alias("ranking_scope")).distinct()
    attempted = scopes.where("ranking_scope in ('ECONOMY', 'PROMO')")
    return sinks.merged_failures(scopes.withColumn("error", F.lit("old")), attempted, scopes.where("ranking_scope = 'PROMO'").withColumn("error", F.lit("new")))


@query("""SELECT p_brand AS provider, p_type AS subject, count(*) AS rows, count(*) AS indexed FROM part GROUP BY 1, 2""")
def detail_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder for each provider and subject, the index of them, and what the folders hold."""
    parts = table(spark, sf_dir, "part").select(F.col("p_brand").alias("provider"), F.col("p_type").alias("subject"), "p_partkey")
    path = landing.folder(spark, "details")
    index = sinks.write_details(parts, path).withColumnRenamed("count", "indexed")
    held = spark.read.parquet(path).groupBy("provider", "subject").agg(F.count("*").alias("rows"))
    return held.join(index, ["provider", "subject"])


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'second' ELSE 'first' END AS result FROM customer""")
def checkpointed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of results, the second only of what was pending or is tried again; the newest of each counts."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    path = landing.folder(spark, "results")
    sinks.append_results(ids.where("id % 2 = 1 or id % 4 = 0").withColumns({"result": F.lit("first"), "batch": F.lit(1)}), path)
    left = sinks.pending(ids, spark.read.parquet(path), "id").unionByName(ids.where("id % 4 = 0"))
    sinks.append_results(left.withColumns({"result": F.lit("second"), "batch": F.lit(2)}), path)
    return sinks.latest_results(spark, path, "id", "batch").select("id", "result")


@query("""SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) AS place FROM lineitem""")
def stable_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal values keep the order of their ordinals."""
    return R.top_per_group(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), ["l_orderkey"], [F.desc("l_quantity"), "l_linenumber"], 1_000_000, "place").drop("l_quantity")
