"""Queries for the functions that turn publishers' cells into values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions import facts, names, numbers, places
from podium.plans.base import table
from podium.plans.registry import registry

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registry(QUERIES, ORACLES)


@query("""SELECT p_partkey, p_name || ' & ' || p_brand || ' <' || p_size || '> "x" ' || chr(233) AS plain FROM part""")
def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markup out, references decoded, blanks collapsed."""
    size = F.col("p_size").cast("string")
    cell = F.concat(F.lit("<p class='a'>"), F.regexp_replace("p_name", " ", " \n <br/>"), F.lit("&nbsp;&amp; <b>"), F.regexp_replace("p_brand", "#", "&#35;"), F.lit("</b> &lt;"), size, F.lit("&gt; &quot;x&quot; &#xE9;</p>"))
    return table(spark, sf_dir, "part").select("p_partkey", names.plain_text(cell).alias("plain"))


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' Of Science' AS title FROM part""")
def title_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    slug = F.concat(names.slug(F.upper("p_name")), F.lit("_of-SCIENCE"))
    return table(spark, sf_dir, "part").select("p_partkey", names.title_case(slug).alias("title"))


@query("""SELECT s_suppkey, 'the universite of e' || lower(replace(s_name, '#', ' ')) || ' and sons' AS key FROM supplier""")
def institution_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("The Université of  É"), F.col("s_name"), F.lit(" & Sons!"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.institution_name(name).alias("key"))


@query("""WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS w, p_type FROM part) SELECT p_partkey, array_to_string(list_sort(list_distinct([w[1], w[2], lower(p_type)])), ' ') AS signature FROM t""")
def name_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that tell a name apart, sorted."""
    name = F.concat(F.lit("The University of "), F.initcap("p_name"), F.lit(" and "), "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", names.signature(name).alias("signature"))


@query("""WITH t AS (SELECT p_partkey, list_distinct(list_filter(string_split(p_name || ' ' || lower(p_type), ' '), lambda w: length(w) > 2)) AS a, list_distinct(list_filter(string_split(p_name || ' small of it', ' '), lambda w: length(w) > 2)) AS b FROM part)
SELECT p_partkey, round_even(len(list_intersect(a, b))::DOUBLE / greatest(len(a), len(b)), 6) AS alike FROM t""")
def name_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = names.tokens(F.concat_ws(" ", "p_name", "p_type"), 3), names.tokens(F.concat("p_name", F.lit(" small of it")), 3)
    return table(spark, sf_dir, "part").select("p_partkey", F.bround(names.overlap(a, b), 6).alias("alike"))


@query("""SELECT c_custkey, 'nation ' || c_nationkey || ' zurich' AS folded, array_to_string(['a longer name of it', c_name], '|') AS searched FROM customer""")
def searchable_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded text to search in, and the names to look for: long ones first, short ones not at all."""
    folded = names.fold(F.concat(F.lit("NATION "), F.col("c_nationkey").cast("string"), F.lit(" Zürich")))
    found = names.searchable_names(F.array(F.lit("short"), F.col("c_name"), F.lit("a longer name of it"), F.col("c_name")))
    return table(spark, sf_dir, "customer").select("c_custkey", folded.alias("folded"), F.array_join(found, "|").alias("searched"))


@query("""SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Promotions & offers' ELSE upper(p_type[1]) || lower(p_type[2:]) || ' Goods' END AS label FROM part""")
def subject_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    scopes = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("field-"), F.lower("p_type"), F.lit("-goods")).alias("scope"))
    labels = spark.createDataFrame([("field-promo-goods", "Promotions & offers")], "scope string, label string")
    return names.subject_labels(scopes, "scope", labels).select("p_partkey", "label")


@query("""SELECT c_custkey, 'I' || c_custkey AS openalex, CASE WHEN c_custkey % 2 = 0 THEN '0' || lpad(c_custkey::VARCHAR, 8, 'a') END AS ror, NULL::VARCHAR AS wikidata FROM customer""")
def captured_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    alex, ror = F.concat(F.lit("https://openalex.org/I"), key), F.concat(F.when(F.col("c_custkey") % 2 == 0, "https://ror.org/0").otherwise("https://example.org/0"), F.lpad(key, 8, "a"))
    return table(spark, sf_dir, "customer").select("c_custkey", names.captured_id(alex, "openalex").alias("openalex"), names.captured_id(ror, "ror").alias("ror"), names.captured_id(alex, "wikidata").alias("wikidata"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 5 WHEN 0 THEN NULL WHEN 1 THEN l_partkey * 1000.0 WHEN 2 THEN NULL ELSE l_quantity END::DOUBLE AS number, CASE l_linenumber % 5 WHEN 3 THEN -l_quantity WHEN 4 THEN l_quantity END::DOUBLE AS share FROM lineitem""")
def number_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with thousands separators, units, infinities, Unicode minus and percent signs."""
    k, quantity = F.col("l_linenumber") % 5, F.col("l_quantity").cast("string")
    cell = F.when(k == 0, "Infinity").when(k == 1, F.concat(F.lit(" "), F.format_number(F.col("l_partkey") * 1000, 0))).when(k == 2, F.concat(quantity, F.lit("d"))).otherwise(quantity)
    share = F.when(k == 3, F.concat(F.lit("−"), quantity, F.lit("%"))).when(k == 4, F.concat(quantity, F.lit("%"))).otherwise("N/A")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", numbers.to_number(cell).alias("number"), numbers.share_number(share).alias("share"))


@query("""WITH r AS (SELECT p_partkey AS k, format('{:,}', p_partkey * 7) AS big FROM part) SELECT k, CASE k % 4 WHEN 0 THEN k * 7 WHEN 1 THEN k WHEN 2 THEN 601 END AS rank, CASE k % 4 WHEN 0 THEN '=' || big WHEN 1 THEN format('{:,}', k) WHEN 2 THEN '601–800' ELSE '—' END AS display FROM r""")
def row_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row's rank from the first column that has one: a tied number, a number, a range, none."""
    k = F.col("p_partkey")
    main = F.when(k % 4 == 0, F.format_number(k * 7, 0)).when(k % 4 == 3, "Reporter")
    other = F.when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, " 601–800 ").when(k % 4 == 3, "")
    rank, display = numbers.row_rank(main, other, tied=F.lit("Yes"))
    return table(spark, sf_dir, "part").select(k.alias("k"), rank.alias("rank"), display.alias("display"))


@query("""WITH v AS (SELECT o_orderkey, floor(o_totalprice)::BIGINT * CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1000 WHEN 2 THEN 100000 ELSE 0 END AS n FROM orders)
SELECT o_orderkey, CASE WHEN n >= 999950000 THEN regexp_replace(printf('%.1f', floor(n * 10 / 1e9 + 0.5) / 10), '[.]0$', '') || 'B' WHEN n >= 999950 THEN regexp_replace(printf('%.1f', floor(n * 10 / 1e6 + 0.5) / 10), '[.]0$', '') || 'M' WHEN n >= 1000 THEN regexp_replace(printf('%.1f', floor(n * 10 / 1e3 + 0.5) / 10), '[.]0$', '') || 'K' ELSE n::VARCHAR END AS shown FROM v""")
def compact_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 4
    n = F.floor("o_totalprice") * F.when(k == 0, 1).when(k == 1, 1000).when(k == 2, 100000).otherwise(0)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", n.alias("n"))
    return rows.select("o_orderkey", numbers.compact(F.col("n").cast("double")).alias("shown"))


@query("""WITH b AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b FROM lineitem) SELECT l_orderkey, l_linenumber, round_even((l_quantity - a) / (b - a), 9) AS linear, round_even((log10(l_quantity) - log10(a)) / (log10(b) - log10(a)), 9) AS logarithmic FROM lineitem, b""")
def axis_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    ends = items.agg(F.min("l_quantity").alias("a"), F.max("l_quantity").alias("b"))
    place = lambda log: F.bround(numbers.on_scale(F.col("l_quantity"), F.col("a"), F.col("b"), log), 9)
    return items.join(F.broadcast(ends)).select("l_orderkey", "l_linenumber", place(False).alias("linear"), place(True).alias("logarithmic"))


@query("""SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN 'DE' WHEN 1 THEN 'US' WHEN 2 THEN 'KR' WHEN 3 THEN 'FR' WHEN 4 THEN 'TR' END AS country_code,
CASE c_custkey % 8 WHEN 0 THEN 'Germany' WHEN 1 THEN 'United States' WHEN 2 THEN 'South Korea' WHEN 3 THEN 'France' WHEN 4 THEN 'Turkey' WHEN 5 THEN 'Multinational' WHEN 6 THEN 'Unknown' ELSE 'NATION_' || c_nationkey END AS country FROM customer""")
def country_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row's country from several columns: codes, names, aliases; else what to show instead."""
    k = F.col("c_custkey") % 8
    first = F.when(k == 0, "deu").when(k == 1, "Boston, U.S.A.").when(k == 2, "").when(k == 4, "nowhere").when(k == 5, "Multinational").when(k == 6, "ZZ").when(k == 7, F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")))
    second = F.when(k == 2, "Korea, South Korea").when(k == 3, "FR").when(k == 4, "Türkiye (TUR)")
    rows = table(spark, sf_dir, "customer").select("c_custkey", first.alias("location"), second.alias("region"))
    found = places.row_country(rows, ["location", "absent", "region"], places.country_keys(spark), places.country_labels(spark))
    return found.select("c_custkey", "country_code", "country")


@query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 1990 + c_custkey % 9 END AS first_year, CASE WHEN c_custkey % 2 = 0 THEN DATE '2024-01-01' + (c_custkey % 300)::INTEGER END AS day FROM customer""")
def periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Academic years that follow one another, and ISO days at the begin of a cell."""
    k, year = F.col("c_custkey"), 1990 + F.col("c_custkey") % 9
    text = F.when(k % 3 == 0, F.concat(year.cast("string"), F.lit("/"), F.lpad((year % 100 + 1).cast("string"), 2, "0"))).when(k % 3 == 1, F.concat(year.cast("string"), F.lit("-"), (year + 2).cast("string"))).otherwise("1995")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int"))
    cell = F.when(k % 2 == 0, F.concat(day.cast("string"), F.lit("T08:00:00Z"))).otherwise(F.date_format(day, "dd.MM.yyyy"))
    return table(spark, sf_dir, "customer").select("c_custkey", numbers.academic_year(text).alias("first_year"), facts.iso_day(cell).alias("day"))


@query("""SELECT s_suppkey, '{"kind":"number","value":' || s_suppkey || ',"unit":' || CASE WHEN s_suppkey % 2 = 0 THEN '"people"' ELSE 'null' END || '}' AS signature FROM supplier""")
def value_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.when(F.col("s_suppkey") % 2 == 0, "people")
    return table(spark, sf_dir, "supplier").select("s_suppkey", facts.value_signature(F.lit("number").alias("kind"), F.col("s_suppkey").alias("value"), unit.alias("unit")).alias("signature"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 150 WHEN 1 THEN 70 WHEN 2 THEN 55 ELSE -1 END AS score, CASE p_partkey % 4 WHEN 0 THEN 0.95 WHEN 1 THEN 0.9 WHEN 2 THEN 0.8 ELSE 0.2 END::DOUBLE AS confidence FROM part""")
def structured_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well structured nodes describe an institution, and how far to trust a value by its method."""
    k = F.col("p_partkey") % 4
    kind = F.when(k == 0, "https://schema.org/CollegeOrUniversity").when(k == 1, "EducationalOrganization").when(k == 2, "schema:Organization").otherwise("Person")
    name = F.when(k == 0, F.col("p_name")).when(k == 2, F.concat(F.element_at(F.split("p_name", " "), 1), F.lit(" other")))
    method, official = F.when(k == 0, "json-ld").when(k == 2, "registry").otherwise("text"), k < 2
    return table(spark, sf_dir, "part").select("p_partkey", facts.node_score(kind, name, F.col("p_name")).alias("score"), facts.confidence(method, official).alias("confidence"))


@query("""SELECT c_nationkey AS country, c_mktsegment AS name, count(*) AS n FROM customer GROUP BY 1, 2""")
def composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities keyed by name and country, where the country may be unknown: nulls are equal in a key."""
    rows = table(spark, sf_dir, "customer").select(F.struct(F.col("c_mktsegment").alias("name"), F.when(F.col("c_nationkey") >= 0, F.col("c_nationkey")).alias("country")).alias("key"))
    return rows.groupBy("key").agg(F.count("*").alias("n")).select("key.country", "key.name", "n")
