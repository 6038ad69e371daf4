"""Queries across providers, countries and years."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions.numbers import growth_rate, percent_change
from podium.operators import ordered
from podium.operators import relational as R
from podium.plans.base import CONSENSUS, NATIONS, RANKED, SCORED, YEARLY, consensus, nations, ranked, scores, table
from podium.plans.registry import registry
from podium.sources import landing

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


query = registry(QUERIES, ORACLES)


@query(f"""WITH {CONSENSUS} SELECT entity, providers, raw, row_number() OVER (ORDER BY raw DESC, providers DESC, entity) AS consensus_rank FROM consensus""")
def consensus_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean percentile over providers, of entities that four or more rank."""
    return R.numbered(consensus(spark, sf_dir), "raw", [F.desc("providers"), "entity"], "consensus_rank").select("entity", "providers", "raw", F.col("consensus_rank").cast("long"))


@query(f"""WITH {RANKED}, {NATIONS} SELECT country, count(*) AS placements, count(DISTINCT provider) AS providers FROM ranked JOIN nations USING (entity)
WHERE rank <= 100 GROUP BY country ORDER BY placements DESC, providers DESC, country LIMIT 18""")
def country_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = ranked(spark, sf_dir).where("rank <= 100").join(nations(spark, sf_dir), "entity")
    return top.groupBy("country").agg(F.count("*").alias("placements"), F.countDistinct("provider").alias("providers")).orderBy(F.desc("placements"), F.desc("providers"), "country").limit(18)


@query(f"""WITH {RANKED}, {NATIONS}, per AS (SELECT provider, country, count(*) AS n FROM ranked JOIN nations USING (entity) WHERE rank <= 100 GROUP BY 1, 2),
lead AS (SELECT provider, country, n, row_number() OVER (PARTITION BY provider ORDER BY n DESC, country) AS k, sum(n) OVER (PARTITION BY provider) AS total,
count(*) OVER (PARTITION BY provider) AS countries FROM per), size AS (SELECT provider, count(*) AS universe FROM ranked GROUP BY 1)
SELECT provider, universe, CAST(total AS BIGINT) AS top100, countries, country AS leader, n AS leader_count FROM lead JOIN size USING (provider) WHERE k = 1""")
def provider_top100(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ranked(spark, sf_dir)
    per = rows.where("rank <= 100").join(nations(spark, sf_dir), "entity").groupBy("provider", "country").agg(F.count("*").alias("n"))
    lead = per.groupBy("provider").agg(F.sum("n").alias("top100"), F.count("*").alias("countries"), F.min_by(F.struct("country", "n"), F.struct(-F.col("n"), "country")).alias("l"))
    size = rows.groupBy("provider").agg(F.count("*").alias("universe"))
    return lead.join(size, "provider").select("provider", "universe", "top100", "countries", F.col("l.country").alias("leader"), F.col("l.n").alias("leader_count"))


@query("""WITH per AS (SELECT o_orderpriority AS provider, year(o_orderdate) AS year, count(*) AS size, count(*) FILTER (WHERE o_orderstatus <> 'P') AS ranked,
count(*) FILTER (WHERE o_orderstatus = 'P') AS unranked FROM orders GROUP BY 1, 2) SELECT * FROM per WHERE provider IN (SELECT provider FROM per GROUP BY 1 HAVING count(*) >= 2)""")
def ranking_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("provider"), F.year("o_orderdate").alias("year"), "o_orderstatus")
    per = orders.groupBy("provider", "year").agg(F.count("*").alias("size"), F.count_if(F.col("o_orderstatus") != "P").alias("ranked"), F.count_if(F.col("o_orderstatus") == "P").alias("unranked"))
    return per.withColumn("points", F.count("*").over(Window.partitionBy("provider"))).where("points >= 2").drop("points")


TOP_YEARLY = YEARLY + """, placed AS (SELECT entity, year, rank() OVER (PARTITION BY year ORDER BY score DESC) AS rank FROM yearly),
top AS (SELECT year, entity, CASE WHEN contains(country, '_1') THEN NULL ELSE country END AS country FROM placed JOIN nations USING (entity) WHERE rank <= 100)"""


def _top_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """year, country of each year's first hundred; some countries are unknown (null)."""
    placed = R.range_ranked(scores(spark, sf_dir, "entity", "year"), ["year"], "score").where("rank <= 100")
    return placed.join(nations(spark, sf_dir), "entity").select("year", F.when(~F.col("country").contains("_1"), F.col("country")).alias("country"))


@query(f"""WITH {NATIONS}, {TOP_YEARLY}, per AS (SELECT year, country, count(*) AS n FROM top GROUP BY 1, 2),
total AS (SELECT year, CAST(sum(n) AS BIGINT) AS total FROM per GROUP BY 1)
SELECT year, total, round_even(sum(CASE WHEN country IS NULL THEN 0 ELSE n * n END)::DOUBLE / any_value(total)::DOUBLE / any_value(total)::DOUBLE, 9) AS hhi
FROM per JOIN total USING (year) GROUP BY year, total""")
def concentration_hhi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares are of all rows: unknown countries count in the total, not as a country."""
    per = _top_yearly(spark, sf_dir).groupBy("year", "country").agg(F.count("*").alias("n"))
    total = F.sum("n")
    square = F.sum(F.when(F.col("country").isNull(), 0).otherwise(F.col("n") * F.col("n")))
    return per.groupBy("year").agg(total.alias("total"), F.bround(square.cast("double") / total / total, 9).alias("hhi"))


@query(f"""WITH {NATIONS}, {TOP_YEARLY}, per AS (SELECT year, country, count(*) AS n FROM top WHERE country IS NOT NULL GROUP BY 1, 2),
leaders AS (SELECT country FROM per GROUP BY 1 ORDER BY max(n) DESC, country LIMIT 6), years AS (SELECT year, sum(n) AS total FROM per GROUP BY 1)
SELECT y.year, l.country, coalesce(p.n, 0) AS n, round_even(100.0::DOUBLE * coalesce(p.n, 0) / y.total, 6) AS share
FROM years y CROSS JOIN leaders l LEFT JOIN per p ON p.year = y.year AND p.country = l.country""")
def concentration_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six countries of the highest peak over all years, with zeros; shares of known countries only."""
    per = _top_yearly(spark, sf_dir).where("country is not null").groupBy("year", "country").agg(F.count("*").alias("n"))
    leaders = per.groupBy("country").agg(F.max("n").alias("peak")).orderBy(F.desc("peak"), "country").limit(6).select("country")
    years = per.groupBy("year").agg(F.sum("n").alias("total"))
    grid = R.zero_filled(per, years.select("year"), leaders, ["n"])
    return grid.join(years, "year").select("year", "country", "n", F.bround(100.0 * F.col("n") / F.col("total"), 6).alias("share"))


SUBJECT = """subject AS (SELECT p_brand AS subject, l_suppkey AS entity, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS score
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2), board AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY score DESC, entity) AS rank FROM subject)"""
OVERALL = """overall AS (SELECT l_suppkey AS entity, rank() OVER (ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC) AS overall_rank FROM lineitem
WHERE l_returnflag = 'R' GROUP BY 1)"""


def _board(spark: SparkSession, sf_dir: str, k: int | None = None) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_suppkey").alias("entity"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("subject"))
    subject = items.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("subject", "entity").agg(F.sum("price").cast("decimal(28,2)").alias("score"))
    board = subject.withColumn("rank", F.row_number().over(Window.partitionBy("subject").orderBy(F.desc("score"), "entity")))
    return board.where(F.col("rank") <= k) if k else board


@query(f"""WITH {SUBJECT}, {OVERALL} SELECT subject, entity, rank, overall_rank FROM board LEFT JOIN overall USING (entity)
WHERE rank <= 10 AND (overall_rank IS NULL OR overall_rank >= 30)""")
def subject_outperformers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High in a subject, low or absent overall."""
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_suppkey").alias("entity")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("score"))
    overall = R.range_ranked(returned, [], "score", "overall_rank").select("entity", "overall_rank")
    joined = _board(spark, sf_dir, 10).join(overall, "entity", "left")
    return joined.where("overall_rank is null or overall_rank >= 30").select("subject", "entity", "rank", "overall_rank")


@query(f"""WITH {YEARLY}, {NATIONS}, per AS (SELECT year, country, sum(score) AS share, count(*) FILTER (WHERE n >= 2) AS strong FROM yearly JOIN nations USING (entity) WHERE year IN (1995, 2000) GROUP BY 1, 2),
a AS (SELECT * FROM per WHERE year = 1995 AND share < 1e12), b AS (SELECT * FROM per WHERE year = 2000)
SELECT coalesce(a.country, b.country) AS country, coalesce(a.share, 0)::DECIMAL(28,2)::DOUBLE AS first_share, coalesce(b.share, 0)::DECIMAL(28,2)::DOUBLE AS last_share,
(coalesce(b.share, 0) - coalesce(a.share, 0))::DECIMAL(28,2)::DOUBLE AS change, CASE WHEN coalesce(a.share, 0) <> 0 THEN round_even((coalesce(b.share, 0)::DOUBLE - a.share::DOUBLE) / a.share::DOUBLE * 100, 6) END AS percent,
coalesce(a.strong, 0) AS first_strong, coalesce(b.strong, 0) AS last_strong FROM a FULL JOIN b ON a.country = b.country ORDER BY last_share DESC, country LIMIT 18""")
def country_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two editions by country, missing sides as zeros."""
    rows = scores(spark, sf_dir, "entity", "year").where(F.col("year").isin(1995, 2000)).join(nations(spark, sf_dir), "entity")
    side = lambda y, name: (F.coalesce(F.sum(F.when(F.col("year") == y, F.col("score"))), F.lit(0)).cast("decimal(28,2)").alias(f"{name}_share"), F.count_if((F.col("year") == y) & (F.col("n") >= 2)).alias(f"{name}_strong"))
    per = rows.groupBy("country").agg(*side(1995, "first"), *side(2000, "last"))
    first, last = F.col("first_share").cast("double"), F.col("last_share").cast("double")
    out = per.withColumn("change", (F.col("last_share") - F.col("first_share")).cast("decimal(28,2)")).withColumn("percent", F.bround(percent_change(last, first), 6))
    return out.orderBy(F.desc("last_share"), "country").limit(18)


@query(f"""WITH {SUBJECT} SELECT subject, entity, score::DECIMAL(28,2)::DOUBLE AS score, rank FROM board WHERE rank <= 10""")
def subject_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _board(spark, sf_dir, 10).select("subject", "entity", "score", "rank")


@query("""WITH scored AS (SELECT p_type AS subject, l_suppkey AS entity, sum(CAST(l_quantity AS DECIMAL(18,2))) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
placed AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY q DESC, entity) AS rank FROM scored),
types AS (SELECT subject, row_number() OVER (ORDER BY subject) AS k FROM (SELECT DISTINCT subject FROM placed))
SELECT entity, max(CASE WHEN k = 1 THEN rank END) AS s1, max(CASE WHEN k = 2 THEN rank END) AS s2, max(CASE WHEN k = 3 THEN rank END) AS s3, max(CASE WHEN k = 4 THEN rank END) AS s4,
max(CASE WHEN k = 5 THEN rank END) AS s5, max(CASE WHEN k = 6 THEN rank END) AS s6 FROM placed JOIN types USING (subject) GROUP BY entity""")
def subject_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks of an entity in all subjects, one column each; a subject is ranked by as many tasks as it has ranges."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("subject"))
    items = table(spark, sf_dir, "lineitem").select("l_partkey", F.col("l_suppkey").alias("entity"), F.col("l_quantity").cast("decimal(18,2)").alias("q"))
    scored = items.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy("subject", "entity").agg(F.sum("q").alias("q"))
    placed = ordered.with_numbers(scored, ["subject"], [F.desc("q"), "entity"], "rank")
    subjects = sorted(r[0] for r in parts.select("subject").distinct().collect())  # a dimension of fixed size
    named = F.create_map(*[F.lit(x) for k, subject in enumerate(subjects) for x in (subject, f"s{k + 1}")])
    return placed.withColumn("k", named[F.col("subject")]).groupBy("entity").pivot("k", [f"s{k + 1}" for k in range(len(subjects))]).agg(F.max("rank"))


@query(f"""WITH {YEARLY}, {CONSENSUS}, a AS (SELECT * FROM yearly WHERE year = 1995), b AS (SELECT * FROM yearly WHERE year = 2000),
top AS (SELECT entity FROM consensus ORDER BY raw DESC, providers DESC, entity LIMIT 400)
SELECT entity, a.n AS first_n, b.n AS last_n, round_even((b.n - a.n)::DOUBLE / a.n::DOUBLE * 100, 6) AS growth, round_even((pow(b.n::DOUBLE / a.n::DOUBLE, 0.2) - 1) * 100, 6) AS yearly_growth
FROM a JOIN b USING (entity) SEMI JOIN top USING (entity) WHERE a.n >= 1 ORDER BY growth DESC, entity LIMIT 15""")
def cohort_growth_cagr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Growth of a cohort present in both years and among the leading consensus entities."""
    yearly = scores(spark, sf_dir, "entity", "year")
    first = yearly.where("year = 1995").select("entity", F.col("n").alias("first_n"))
    last = yearly.where("year = 2000").select("entity", F.col("n").alias("last_n"))
    top = consensus(spark, sf_dir).orderBy(F.desc("raw"), F.desc("providers"), "entity").limit(400).select("entity")
    both = first.join(last, "entity").join(top, "entity", "left_semi").where("first_n >= 1")
    a, b = F.col("first_n").cast("double"), F.col("last_n").cast("double")
    out = both.withColumn("growth", F.bround(percent_change(b, a), 6)).withColumn("yearly_growth", F.bround(growth_rate(b, a, 5), 6))
    return out.orderBy(F.desc("growth"), "entity").limit(15)


COHORT = YEARLY + """, cohort AS (SELECT entity FROM yearly WHERE year BETWEEN 1995 AND 1998 GROUP BY 1 HAVING count(DISTINCT year) = 4),
series AS (SELECT country, year, CAST(sum(n) AS BIGINT) AS works FROM yearly SEMI JOIN cohort USING (entity) JOIN nations USING (entity) WHERE year BETWEEN 1995 AND 1998 GROUP BY 1, 2),
lead6 AS (SELECT country FROM series WHERE year = 1998 ORDER BY works DESC, country LIMIT 6),
dense AS (SELECT l.country, y.year, coalesce(s.works, 0) AS works FROM lead6 l CROSS JOIN (SELECT unnest([1995, 1996, 1997, 1998]) AS year) y LEFT JOIN series s ON s.country = l.country AND s.year = y.year)"""


def _cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """country, year, works of entities present in every year of the window; six leading countries, dense."""
    yearly = scores(spark, sf_dir, "entity", "year").where("year between 1995 and 1998")
    cohort = yearly.groupBy("entity").agg(F.countDistinct("year").alias("years")).where("years = 4")
    series = yearly.join(cohort, "entity", "left_semi").join(nations(spark, sf_dir), "entity").groupBy("country", "year").agg(F.sum("n").alias("works"))
    leaders = series.where("year = 1998").orderBy(F.desc("works"), "country").limit(6).select("country")
    return R.zero_filled(series, leaders, spark.range(1995, 1999).select(F.col("id").cast("int").alias("year")), ["works"])


@query(f"""WITH {NATIONS}, {COHORT} SELECT country, year::INTEGER AS year, works, round_even(100.0::DOUBLE * works / sum(works) OVER (PARTITION BY year), 6) AS share FROM dense""")
def constant_cohort_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = F.bround(100.0 * F.col("works") / F.sum("works").over(Window.partitionBy("year")), 6)
    return _cohort(spark, sf_dir).withColumn("share", share)


@query(f"""WITH {NATIONS}, {COHORT} SELECT country, year::INTEGER AS year, CASE WHEN f <> 0 THEN round_even(100.0::DOUBLE * works / f, 6) END AS "index" FROM
(SELECT *, first_value(works) OVER (PARTITION BY country ORDER BY year) AS f FROM dense)""")
def rebased_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cohort(spark, sf_dir).select("country", "year", F.bround(R.rebased(None, ["country"], "year", "works"), 6).alias("index"))


INDICATORS = """ind AS (SELECT l_suppkey AS entity, sum(CAST(l_quantity AS DECIMAL(18,2))) AS scale, sum(CAST(l_discount AS DECIMAL(18,2)))::DOUBLE / count(*) AS impact, count(*) AS n FROM lineitem GROUP BY 1)"""


def _indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    return items.groupBy(F.col("l_suppkey").alias("entity")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(28,2)").alias("scale"),
        (F.sum(F.col("l_discount").cast("decimal(18,2)")).cast("double") / F.count("*")).alias("impact"), F.count("*").alias("n"),
    )


@query(f"""WITH {INDICATORS}, r AS (SELECT *, rank() OVER (ORDER BY scale DESC) AS rank FROM ind) SELECT entity, scale::DECIMAL(28,2)::DOUBLE AS scale, round_even(impact, 9) AS impact, rank FROM r WHERE rank <= 140""")
def scale_impact_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = R.range_ranked(_indicators(spark, sf_dir), [], "scale")
    return placed.where("rank <= 140").select("entity", "scale", F.bround("impact", 9).alias("impact"), "rank")


@query(f"""WITH {INDICATORS}, r AS (SELECT rank() OVER (ORDER BY scale) + (count(*) OVER (PARTITION BY scale) - 1) / 2.0 AS rx, rank() OVER (ORDER BY round_even(impact, 9)) + (count(*) OVER (PARTITION BY round_even(impact, 9)) - 1) / 2.0 AS ry FROM ind)
SELECT round_even(corr(rx::DOUBLE, ry::DOUBLE), 6) AS spearman, count(*) AS n FROM r""")
def scale_impact_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _indicators(spark, sf_dir).withColumn("impact", F.bround("impact", 9))
    return R.spearman(rows, "scale", "impact").select(F.bround("spearman", 6).alias("spearman"), "n")


@query("""WITH ind AS (SELECT l_suppkey AS entity, sum(CAST(l_quantity AS DECIMAL(18,2))) AS scale, round_even(count(*) FILTER (WHERE l_discount >= 0.08)::DOUBLE / count(*), 9) AS top FROM lineitem GROUP BY 1),
r AS (SELECT rank() OVER (ORDER BY scale) + (count(*) OVER (PARTITION BY scale) - 1) / 2.0 AS rx, rank() OVER (ORDER BY top) + (count(*) OVER (PARTITION BY top) - 1) / 2.0 AS ry FROM ind)
SELECT round_even(corr(rx::DOUBLE, ry::DOUBLE), 6) AS spearman, count(*) AS n FROM r""")
def scale_top_share_spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the large ones have the larger share of strong items."""
    items = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("entity")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("decimal(28,2)").alias("scale"), F.bround(F.count_if(F.col("l_discount") >= 0.08).cast("double") / F.count("*"), 9).alias("top"),
    )
    return R.spearman(items, "scale", "top").select(F.bround("spearman", 6).alias("spearman"), "n")


@query(f"""WITH {INDICATORS} SELECT arg_min(entity, struct_pack(a := scale, b := entity)) AS smallest, arg_max(entity, struct_pack(a := scale, b := -entity)) AS largest,
arg_max(entity, struct_pack(a := round_even(impact, 9), b := -entity)) AS strongest, count(*) FILTER (WHERE n >= 500) AS big FROM ind""")
def spotlights_argmin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _indicators(spark, sf_dir).withColumn("impact", F.bround("impact", 9))
    return rows.agg(
        F.min_by("entity", F.struct("scale", "entity")).alias("smallest"), F.max_by("entity", F.struct("scale", -F.col("entity"))).alias("largest"),
        F.max_by("entity", F.struct("impact", -F.col("entity"))).alias("strongest"), F.count_if(F.col("n") >= 500).alias("big"),
    )


TRENDS = CONSENSUS + """, lead14 AS (SELECT entity FROM consensus ORDER BY raw DESC, providers DESC, entity LIMIT 14),
points AS (SELECT o_custkey AS entity, o_orderpriority AS provider, year(o_orderdate) AS year, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DECIMAL(28,2)::DOUBLE AS score FROM orders SEMI JOIN lead14 ON o_custkey = entity GROUP BY 1, 2, 3),
kept AS (SELECT * FROM points WHERE (entity, provider) IN (SELECT (entity, provider) FROM points GROUP BY entity, provider HAVING count(*) >= 2))"""


def _trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = consensus(spark, sf_dir).orderBy(F.desc("raw"), F.desc("providers"), "entity").limit(14).select("entity")
    points = scores(spark, sf_dir, "entity", "provider", "year").join(F.broadcast(top), "entity", "left_semi").drop("n")
    return points.withColumn("__n", F.count("*").over(Window.partitionBy("entity", "provider"))).where("__n >= 2").drop("__n")


@query(f"""WITH {TRENDS} SELECT entity, provider, year, score FROM kept""")
def entity_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trends(spark, sf_dir).select("entity", "provider", "year", "score")


@query(f"""WITH {TRENDS} SELECT entity, provider, count(*) AS points, min(year) AS first_year, max(year) AS last_year, arg_min(score, year) AS first_score, arg_max(score, year) AS last_score,
(arg_max(score, year) - arg_min(score, year))::DECIMAL(28,2)::DOUBLE AS movement FROM kept GROUP BY 1, 2""")
def trend_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = _trends(spark, sf_dir).groupBy("entity", "provider").agg(
        F.count("*").alias("points"), F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.min_by("score", "year").alias("first_score"), F.max_by("score", "year").alias("last_score")
    )
    return per.withColumn("movement", (F.col("last_score") - F.col("first_score")).cast("decimal(28,2)"))


@query(f"""WITH {CONSENSUS}, {NATIONS}, m AS (SELECT country, 'ranked' AS metric, count(*)::BIGINT AS v FROM ranked JOIN nations USING (entity) WHERE rank <= 500 GROUP BY 1
UNION ALL SELECT country, 'consensus', count(*) FROM consensus JOIN nations USING (entity) GROUP BY 1
UNION ALL SELECT n_name, 'suppliers', count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
p AS (SELECT country, CAST(sum(CASE WHEN metric = 'ranked' THEN v ELSE 0 END) AS BIGINT) AS ranked, CAST(sum(CASE WHEN metric = 'consensus' THEN v ELSE 0 END) AS BIGINT) AS consensus,
CAST(sum(CASE WHEN metric = 'suppliers' THEN v ELSE 0 END) AS BIGINT) AS suppliers FROM m GROUP BY 1),
best AS (SELECT country, arg_max(entity, struct_pack(a := raw, b := -entity)) AS leader FROM consensus JOIN nations USING (entity) GROUP BY 1)
SELECT country, ranked, consensus, suppliers, leader FROM p LEFT JOIN best USING (country) WHERE ranked > 0 OR consensus > 0 OR suppliers > 0""")
def country_atlas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of several tables side by side by country; all-zero countries go."""
    where = nations(spark, sf_dir)
    agreed = consensus(spark, sf_dir).join(where, "entity")
    nation = table(spark, sf_dir, "nation")
    suppliers = table(spark, sf_dir, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("country"))
    metric = lambda df, name: df.groupBy("country").agg(F.count("*").alias("v")).withColumn("metric", F.lit(name))
    names = ["ranked", "consensus", "suppliers"]
    tables = [ranked(spark, sf_dir).where("rank <= 500").join(where, "entity"), agreed, suppliers]
    long = metric(tables[0], names[0]).unionByName(metric(tables[1], names[1])).unionByName(metric(tables[2], names[2]))
    wide = long.groupBy("country").agg(*[F.coalesce(F.sum(F.when(F.col("metric") == n, F.col("v"))), F.lit(0)).alias(n) for n in names])
    best = agreed.groupBy("country").agg(F.max_by("entity", F.struct("raw", -F.col("entity"))).alias("leader"))
    return wide.where(" or ".join(f"{n} > 0" for n in names)).join(best, "country", "left").select("country", *names, "leader")


BOARDS = """lines AS (SELECT p_brand AS subject, year(o_orderdate) AS edition, o_custkey AS entity, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS score FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN orders ON l_orderkey = o_orderkey WHERE NOT (year(o_orderdate) >= 2000 AND p_brand LIKE '%1') GROUP BY 1, 2, 3), sized AS (SELECT *, count(*) OVER (PARTITION BY subject, edition) AS size FROM lines),
latest AS (SELECT subject, max(edition) AS edition FROM sized WHERE size >= 5 GROUP BY 1),
boards AS (SELECT s.subject, s.edition, s.entity, s.score, s.size, rank() OVER (PARTITION BY s.subject ORDER BY s.score DESC) AS rank FROM sized s JOIN latest l ON s.subject = l.subject AND s.edition = l.edition WHERE s.size >= 5)"""


def _boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each subject's newest edition with at least five rows; some subjects stop before the newest."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("subject"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("edition"), F.col("o_custkey").alias("entity"))
    rows = items.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = rows.where(~((F.col("edition") >= 2000) & F.col("subject").endswith("1")))
    lines = rows.groupBy("subject", "edition", "entity").agg(F.sum("price").cast("decimal(28,2)").alias("score"))
    sized = lines.withColumn("size", F.count("*").over(Window.partitionBy("subject", "edition"))).where("size >= 5")
    newest = F.max("edition").over(Window.partitionBy("subject"))
    kept = sized.withColumn("newest", newest).where("edition = newest").drop("newest")
    return kept.withColumn("rank", R.rank_min(F.col("score"), ["subject"]))


@query(f"""WITH {BOARDS} SELECT subject, edition, entity, score::DECIMAL(28,2)::DOUBLE AS score, size, rank FROM boards WHERE rank <= 25""")
def subject_boards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boards(spark, sf_dir).where("rank <= 25").select("subject", "edition", "entity", "score", "size", "rank")


@query(f"""WITH {BOARDS}, {NATIONS}, per AS (SELECT subject, country, count(*) AS n FROM boards JOIN nations USING (entity) WHERE rank <= 100 GROUP BY 1, 2)
SELECT subject, country, n, position FROM (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY n DESC, country) AS position FROM per) WHERE position <= 8""")
def board_country_top8(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = _boards(spark, sf_dir).where("rank <= 100").join(nations(spark, sf_dir), "entity").groupBy("subject", "country").agg(F.count("*").alias("n"))
    return R.top_per_group(per, ["subject"], [F.desc("n"), "country"], 8).select("subject", "country", "n", "position")


@query(f"""WITH {RANKED}, {NATIONS}, own AS (SELECT entity, provider, rank FROM ranked JOIN nations USING (entity) WHERE country = (SELECT min(n_name) FROM nation) AND provider IN ('1-URGENT', '2-HIGH'))
SELECT entity, round_even(sum(rank)::DOUBLE / 2, 2) AS mean_rank FROM own GROUP BY 1 HAVING count(*) = 2 ORDER BY mean_rank, entity LIMIT 15""")
def national_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of one country that both providers rank, by the rounded mean of their ranks."""
    nation = table(spark, sf_dir, "nation").agg(F.min("n_name").alias("country"))
    own = ranked(spark, sf_dir).where(F.col("provider").isin("1-URGENT", "2-HIGH")).join(nations(spark, sf_dir), "entity").join(F.broadcast(nation), "country", "left_semi")
    both = own.groupBy("entity").agg(F.count("*").alias("n"), F.sum("rank").alias("s")).where("n = 2")
    return both.select("entity", F.bround(F.col("s").cast("double") / 2, 2).alias("mean_rank")).orderBy("mean_rank", "entity").limit(15)


@query(f"""WITH {CONSENSUS}, web AS (SELECT user_id AS entity, sum(CAST(value AS DECIMAL(18,2))) AS visits FROM events GROUP BY 1),
paired AS (SELECT entity, row_number() OVER (ORDER BY raw DESC, providers DESC, entity) AS academic, row_number() OVER (ORDER BY visits DESC, entity) AS web FROM consensus JOIN web USING (entity)),
gap AS (SELECT *, academic - web AS advantage FROM paired)
(SELECT 'ahead' AS side, * FROM gap ORDER BY advantage DESC, entity LIMIT 8) UNION ALL (SELECT 'behind' AS side, * FROM gap ORDER BY advantage, entity LIMIT 8)""")
def position_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions in two lists of the same entities, and the widest gaps either way."""
    web = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("entity")).agg(F.sum(F.col("value").cast("decimal(18,2)")).alias("visits"))
    both = landing.written(consensus(spark, sf_dir).join(web, "entity"), "paired")
    both = R.numbered(both, "raw", [F.desc("providers"), "entity"], "academic")
    both = R.numbered(landing.written(both, "placed"), "visits", ["entity"], "web")
    gap = both.select("entity", F.col("academic").cast("long"), F.col("web").cast("long"), (F.col("academic") - F.col("web")).cast("long").alias("advantage"))
    side = lambda name, order: gap.orderBy(order, "entity").limit(8).select(F.lit(name).alias("side"), "entity", "academic", "web", "advantage")
    return side("ahead", F.desc("advantage")).unionByName(side("behind", F.asc("advantage")))


@query("""SELECT count(*) AS records, count(DISTINCT o_orderpriority) AS providers, count(DISTINCT year(o_orderdate)) AS editions, min(year(o_orderdate)) AS first_year, max(year(o_orderdate)) AS last_year,
max(strftime(o_orderdate, '%Y-%m-%d')) AS latest FROM orders""")
def archive_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, year = table(spark, sf_dir, "orders"), F.year("o_orderdate")
    return orders.agg(
        F.count("*").alias("records"), F.countDistinct("o_orderpriority").alias("providers"), F.countDistinct(year).alias("editions"), F.min(year).alias("first_year"), F.max(year).alias("last_year"),
        F.max(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("latest"),
    )


@query("""SELECT o_orderpriority AS provider, min(year(o_orderdate)) AS first_year, max(year(o_orderdate)) AS last_year, count(DISTINCT year(o_orderdate)) AS editions, count(*) AS records,
count(*) FILTER (WHERE o_orderstatus = 'O') AS open_records, arg_max(o_orderstatus, struct_pack(a := o_orderdate, b := o_orderkey)) AS latest_status FROM orders GROUP BY 1""")
def provider_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("provider")).agg(
        F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.countDistinct(year).alias("editions"), F.count("*").alias("records"),
        F.count_if(F.col("o_orderstatus") == "O").alias("open_records"), F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("latest_status"),
    )


DIRECTORY = CONSENSUS + """, placed AS (SELECT entity, raw, row_number() OVER (ORDER BY raw DESC, providers DESC, entity) AS consensus_rank FROM consensus),
wide AS (SELECT entity, count(*) AS providers, max(CASE WHEN provider = '1-URGENT' THEN rank END) AS r1, max(CASE WHEN provider = '2-HIGH' THEN rank END) AS r2, max(CASE WHEN provider = '3-MEDIUM' THEN rank END) AS r3,
max(CASE WHEN provider LIKE '4-%' THEN rank END) AS r4, max(CASE WHEN provider LIKE '5-%' THEN rank END) AS r5 FROM ranked GROUP BY 1)"""


@query(f"""WITH {DIRECTORY}, {NATIONS} SELECT entity, country, w.providers, r1, r2, r3, r4, r5, consensus_rank FROM wide w LEFT JOIN nations USING (entity) LEFT JOIN placed USING (entity)""")
def entity_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All entities with their rank at each provider and their consensus rank, if any."""
    rows = ranked(spark, sf_dir).withColumn("p", F.concat(F.lit("r"), F.substring("provider", 1, 1)))
    wide = rows.groupBy("entity").agg(F.count("*").alias("providers"), *[F.max(F.when(F.col("p") == p, F.col("rank"))).alias(p) for p in ("r1", "r2", "r3", "r4", "r5")])
    placed = R.numbered(consensus(spark, sf_dir), "raw", [F.desc("providers"), "entity"], "consensus_rank").select("entity", F.col("consensus_rank").cast("long"))
    return wide.join(nations(spark, sf_dir), "entity", "left").join(placed, "entity", "left").select("entity", "country", "providers", "r1", "r2", "r3", "r4", "r5", "consensus_rank")


@query(f"""WITH {SCORED}, {NATIONS} SELECT 'country' AS facet, country AS value, count(DISTINCT entity) AS entities FROM scored JOIN nations USING (entity) GROUP BY 2
UNION ALL SELECT 'provider', provider, count(DISTINCT entity) FROM scored GROUP BY 2""")
def directory_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scores(spark, sf_dir, "provider", "entity").join(nations(spark, sf_dir), "entity")
    facet = lambda c: rows.groupBy(F.col(c).alias("value")).agg(F.countDistinct("entity").alias("entities")).select(F.lit(c).alias("facet"), "value", "entities")
    return facet("country").unionByName(facet("provider"))


@query(f"""WITH {CONSENSUS}, {NATIONS}, per AS (SELECT country, round_even(sum(CAST(raw AS DECIMAL(18,8)))::DOUBLE / count(*) - 50, 6) AS value FROM consensus JOIN nations USING (entity) GROUP BY 1)
SELECT country, value FROM per WHERE value <> 0 ORDER BY abs(value) DESC, country LIMIT 8""")
def leaders_by_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The countries that differ most from the middle, either way."""
    per = consensus(spark, sf_dir).join(nations(spark, sf_dir), "entity").groupBy("country").agg(F.bround(F.sum(F.col("raw").cast("decimal(18,8)")).cast("double") / F.count("*") - 50, 6).alias("value"))
    return per.where("value <> 0").orderBy(F.desc(F.abs("value")), "country").limit(8)


@query(f"""WITH {RANKED}, per AS (SELECT entity, count(*) AS n, max(rank) AS worst, min(rank) AS best FROM ranked GROUP BY 1) SELECT entity, best, worst, worst - best AS span FROM per WHERE n >= 4 AND worst <= 2000""")
def universal_leaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities that every provider ranks high, with the span of their ranks."""
    per = ranked(spark, sf_dir).groupBy("entity").agg(F.count("*").alias("n"), F.max("rank").alias("worst"), F.min("rank").alias("best"))
    return per.where("n >= 4 and worst <= 2000").select("entity", "best", "worst", (F.col("worst") - F.col("best")).alias("span"))
