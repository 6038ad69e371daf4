"""Queries for single operators: ties, orders, sets, sinks, encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions import addresses, names, numbers, places
from podium.operators import matching
from podium.operators import relational as R
from podium.plans.base import table
from podium.plans.registry import registry
from podium.sources import sinks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registry(QUERIES, ORACLES)


@query("""SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_returnflag ORDER BY q DESC NULLS LAST) AS r FROM (SELECT *, CASE WHEN l_linenumber < 7 THEN l_quantity END AS q FROM lineitem) WHERE q IS NOT NULL
UNION ALL SELECT l_orderkey, l_linenumber, NULL FROM lineitem WHERE l_linenumber >= 7""")
def rank_min_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", F.when(F.col("l_linenumber") < 7, F.col("l_quantity")).alias("q"))
    return R.range_ranked(items, ["l_returnflag"], "q", "r").select("l_orderkey", "l_linenumber", "r")


@query("""SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0::DOUBLE AS r FROM lineitem""")
def rank_average_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    return R.range_ranked(items, ["l_returnflag"], "l_quantity", "r", descending=False, average=True).select("l_orderkey", "l_linenumber", "r")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events) WHERE k = 1""")
def first_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return R.pick(events, ["user_id", "event_type"], F.col("event_id"), ["event_id", "value"])


@query("""SELECT user_id, arg_max(value, event_id) AS value FROM events GROUP BY 1""")
def last_wins_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pick(table(spark, sf_dir, "events"), ["user_id"], F.col("event_id"), ["value"], last=True)


@query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2) SELECT user_id, arg_max(event_type, struct_pack(a := n, b := -f)) AS mode, max(n) AS n FROM c GROUP BY 1""")
def mode_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.mode_first_seen(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("""WITH v AS (SELECT list_sort(list(c_acctbal)) AS l FROM customer) SELECT DISTINCT l[1 + CAST(floor((len(l) - 1) * i / 5.0 + 0.5) AS BIGINT)] AS cut FROM v, (SELECT unnest([1, 2, 3, 4]) AS i)""")
def quantile_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.quantile_cuts(table(spark, sf_dir, "customer"), "c_acctbal", 5)


@query("""SELECT p_partkey, p_name FROM part WHERE contains(lower(strip_accents(p_name)), 'e') AND contains(lower(strip_accents(p_name)), 'a')""")
def token_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return parts.where(names.has_all_tokens(names.fold("p_name"), "E a"))


@query("""SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 40""")
def paged_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.page(table(spark, sf_dir, "customer"), [F.desc("c_acctbal"), "c_custkey"], 20, 3).select("c_custkey", "c_name")


@query("""WITH o AS (SELECT o_orderkey, o_orderpriority AS ranking_scope, year(o_orderdate) AS y FROM orders), e AS (SELECT * FROM o WHERE y < 1997), b AS (SELECT * FROM o WHERE y >= 1997 AND ranking_scope <> '1-URGENT'),
m AS (SELECT *, 0 AS nw FROM e WHERE ranking_scope NOT IN (SELECT ranking_scope FROM b) UNION ALL SELECT *, 1 FROM b)
SELECT ranking_scope, count(*) AS records, min(y) AS first_year, max(y) AS last_year FROM m GROUP BY 1""")
def scope_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scopes that a batch holds are replaced whole, others stay."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("ranking_scope"), F.year("o_orderdate").alias("y"))
    batch = orders.where("y >= 1997 and ranking_scope <> '1-URGENT'")
    merged = sinks.upserted(orders.where("y < 1997"), batch, order="o_orderkey")
    return merged.groupBy("ranking_scope").agg(F.count("*").alias("records"), F.min("y").alias("first_year"), F.max("y").alias("last_year"))


@query("""SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def dictionary_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded by a dictionary in order of first appearance, and decoded again."""
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    codes = sinks.dictionary(rows, "n_name", "c_custkey")
    return sinks.decoded(sinks.encoded(rows, "n_name", codes), "n_name", codes).select("c_custkey", "n_name")


@query("""WITH f AS (SELECT n_name, min(c_custkey) AS k FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1) SELECT n_name, row_number() OVER (ORDER BY k) - 1 AS code FROM f""")
def dictionary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    rows = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return sinks.dictionary(rows, "n_name", "c_custkey").withColumn("code", F.col("code").cast("long"))


@query("""WITH p AS (SELECT o_custkey, o_orderkey, o_totalprice, lead(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS nxt, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders)
SELECT o_custkey, o_orderkey, round_even(o_totalprice - coalesce(nxt, 0), 4) AS margin FROM p WHERE k = 1 AND o_totalprice - coalesce(nxt, 0) >= 25""")
def runner_up_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    led = orders.withColumn("margin", R.margin_to_next(["o_custkey"], "o_totalprice", ["o_orderkey"]))
    best = R.first_wins(led, ["o_custkey"], [F.desc("o_totalprice"), "o_orderkey"])
    return best.where("margin >= 25").select("o_custkey", "o_orderkey", F.bround("margin", 4).alias("margin"))


@query("""SELECT l_orderkey, l_linenumber FROM (SELECT *, lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS p FROM lineitem) WHERE l_quantity < p""")
def sequence_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that fall below their predecessor."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey", "l_extendedprice")
    return items.withColumn("bad", R.falls_back("l_quantity", ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])).where("bad").select("l_orderkey", "l_linenumber")


@query("""WITH c AS (SELECT p_brand, p_size, count(*) AS held FROM part GROUP BY 1, 2), e AS (SELECT *, coalesce(lag(p_size + held) OVER (PARTITION BY p_brand ORDER BY p_size), 1) AS expected FROM c)
SELECT p_brand, p_size, held, expected FROM e WHERE p_size <> expected""")
def rank_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes read as ranks: those that break competition ranking."""
    return R.rank_gaps(table(spark, sf_dir, "part"), ["p_brand"], "p_size").select("p_brand", "p_size", "held", F.col("expected").cast("long"))


@query("""WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) SELECT o_custkey, o_orderkey FROM p WHERE (k - 1) % 4 = 0 OR k = n""")
def every_nth_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.every_nth(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"], 4).select("o_custkey", "o_orderkey")


@query("""SELECT user_id, event_id, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS segment FROM events""")
def sessionize_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment opens at each view."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return events.select("user_id", "event_id", R.segments(F.col("event_type") == "view", ["user_id"], ["ts", "event_id"]).alias("segment"))


@query("""WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1995), b AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1996)
SELECT 'union' AS op, count(*) AS n FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'intersect', count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'except', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))
    a, b = (orders.where(F.col("y") == y).select("o_custkey") for y in (1995, 1996))
    counted = lambda op, df: df.agg(F.lit(op).alias("op"), F.count("*").alias("n"))
    return counted("union", a.union(b).distinct()).unionByName(counted("intersect", a.intersect(b))).unionByName(counted("except", a.subtract(b)))


@query("""SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def pending_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return sinks.pending(table(spark, sf_dir, "customer").select("c_custkey"), done, "c_custkey")


@query("""SELECT c_name, min(c_nationkey) AS c_nationkey FROM customer GROUP BY 1 HAVING count(DISTINCT c_nationkey) = 1""")
def unique_name_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.unique_names(table(spark, sf_dir, "customer"), "c_name", "c_nationkey")


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, regexp_extract(props, '[0-9]+')::BIGINT AS first_number FROM events""")
def json_props_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k bigint")
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"), numbers.rank_number(F.col("props")).alias("first_number"))


@query("""SELECT p_partkey, regexp_replace(trim(regexp_replace(lower(strip_accents(p_name)), '[^a-z0-9]+', ' ', 'g')), '^the ', '') AS key, replace(trim(regexp_replace(lower(strip_accents(p_name)), '[^a-z0-9]+', ' ', 'g')), ' ', '-') AS slug FROM part""")
def normalize_name_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", names.normalize_name(F.col("p_name")).alias("key"), names.slug(names.ascii_fold("p_name")).alias("slug"))


@query("""WITH q AS (SELECT p_partkey, p_retailprice, p_size FROM part) SELECT p_partkey, round_even(p_retailprice / 3, 2) AS rounded, '=' || p_size AS display, p_size::BIGINT AS number, CASE WHEN p_size <= 10 THEN 'top-10' WHEN p_size <= 50 THEN 'top-50' WHEN p_size <= 100 THEN 'top-100' ELSE 'ranked' END AS band FROM q""")
def number_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = F.concat(F.lit("="), F.col("p_size"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", numbers.half_even(F.col("p_retailprice") / 3, 2).alias("rounded"), shown.alias("display"), numbers.rank_number(shown).alias("number"), numbers.rank_band(F.col("p_size")).alias("band")
    )


@query("""SELECT n_nationkey, (['DE', 'US', 'VN', 'KR', 'GB', NULL, 'FR', 'CN'])[n_nationkey % 8 + 1] AS code, (['Germany', 'U.S.A.', 'Viet Nam', 'Korea, South Korea', 'Leeds (GBR), England', 'Atlantis', 'fra', 'Mainland China'])[n_nationkey % 8 + 1] AS raw FROM nation""")
def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes, names and aliases as publishers write them."""
    written = F.array(*map(F.lit, ["Germany", "U.S.A.", "Viet Nam", "Korea, South Korea", "Leeds (GBR), England", "Atlantis", "fra", "Mainland China"]))
    aliases = spark.createDataFrame([("mainland China", "CN"), ("England", "GB")], "alias string, code string")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.element_at(written, F.col("n_nationkey") % 8 + 1).alias("raw"))
    return places.with_country(nation, "raw", places.country_keys(spark, aliases=aliases), "code").select("n_nationkey", "code", "raw")


@query("""SELECT c_custkey, (c_custkey % 256) || '.' || (c_nationkey * 7) || '.0.1' AS address, (c_custkey % 256 IN (0, 10, 127) OR c_custkey % 256 >= 224 OR (c_custkey % 256 = 172 AND c_nationkey * 7 BETWEEN 16 AND 31) OR (c_custkey % 256 = 192 AND c_nationkey * 7 IN (0, 168) AND (c_nationkey * 7 = 168 OR true))
OR (c_custkey % 256 = 100 AND c_nationkey * 7 BETWEEN 64 AND 127) OR (c_custkey % 256 = 169 AND c_nationkey * 7 = 254) OR (c_custkey % 256 = 198 AND c_nationkey * 7 IN (18, 19))) AS reserved FROM customer""")
def cidr_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    address = F.concat((F.col("c_custkey") % 256).cast("string"), F.lit("."), (F.col("c_nationkey") * 7).cast("string"), F.lit(".0.1"))
    return table(spark, sf_dir, "customer").select("c_custkey", address.alias("address"), addresses.is_reserved(address).alias("reserved"))


@query("""WITH c AS (SELECT o_custkey AS entity, o_orderkey AS record, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS priority FROM orders) SELECT entity, arg_min(record, struct_pack(a := priority, b := record)) AS record, min(priority) AS priority FROM c GROUP BY 1""")
def candidate_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first candidate of the best class."""
    priority = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderkey").alias("record"), priority.alias("priority"))
    return R.cascade(rows, ["entity"], "priority", ["record"]).select("entity", "record", "priority")


@query("""SELECT o_orderpriority AS provider, count(*) AS records, count(DISTINCT year(o_orderdate)) AS scopes FROM orders GROUP BY 1""")
def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("provider"), F.year("o_orderdate").cast("string").alias("ranking_scope"))
    return sinks.manifest(rows, ["provider"]).select("provider", "records", F.size("records_by_scope").cast("long").alias("scopes"))


@query("""SELECT provider, edition, records FROM (SELECT o_orderpriority AS provider, year(o_orderdate) AS edition, count(*) AS records, row_number() OVER (PARTITION BY o_orderpriority ORDER BY year(o_orderdate) DESC) AS k FROM orders GROUP BY 1, 2) WHERE k = 1""")
def latest_edition(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.sources.snapshots import latest

    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("source"), F.year("o_orderdate").alias("edition")).agg(F.count("*").alias("records"))
    return latest(rows.withColumn("file_name", F.lit("x"))).select(F.col("source").alias("provider"), "edition", "records")


@query("""SELECT o_orderpriority AS provider, o_orderstatus AS status, count(*) AS n, grouping(o_orderpriority, o_orderstatus)::BIGINT AS level FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def rollup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("provider"), F.col("o_orderstatus").alias("status"))
    return rows.rollup("provider", "status").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@query("""SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n, sum(CAST(value AS DECIMAL(18,2)))::DECIMAL(28,2)::DOUBLE AS total FROM events GROUP BY 1, 2""")
def windowed_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.streaming import windowed_counts

    return windowed_counts(table(spark, sf_dir, "events"), "ts", ["event_type"], "1 day").select("start", "event_type", "n", F.col("total").cast("decimal(28,2)"))


@query("""WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from podium.streaming import sessions

    return sessions(table(spark, sf_dir, "events"), "ts", "user_id", "30 minutes")
