"""Queries that tell which record an institution is, and what a text says of it.

Institutions stand for documents: a name is the longest words of a document's text, so copies of
a document bear one name and near copies similar ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions import evidence, names
from podium.operators import identity
from podium.plans.base import table
from podium.plans.registry import registry
from podium.sources.landing import written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registry(QUERIES, ORACLES)

STOP = str(list(names.STOP_WORDS))
#: doc_id, lang, ws: the longest words, four to six, ties by the alphabet.
WORDS = """w AS (SELECT doc_id, lang, list_transform(list_sort(list_transform(list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+'), lambda x: lower(x))),
  lambda x: {'n': -length(x), 'w': x}))[1 : 4 + doc_id % 3], lambda s: s.w) AS ws FROM documents)"""
VARIANT = """CASE doc_id % 5 WHEN 0 THEN 'institute ' || array_to_string(ws, ' ') WHEN 1 THEN array_to_string(list_reverse(ws), ' ') || ' institute'
  WHEN 2 THEN 'institute ' || array_to_string(ws[1 : len(ws) - 1], ' ') WHEN 3 THEN 'institute ' || array_to_string(ws, ' ') ELSE ws[1] END"""
KIND = "CASE doc_id % 5 WHEN 3 THEN 'alias' WHEN 4 THEN 'acronym' ELSE 'official' END"


def _tokens(name: str) -> str:
    return f"list_filter(list_distinct(string_split({name}, ' ')), lambda x: x <> '' AND NOT list_contains({STOP}, x))"


#: p: block, key, record, score of all pairs of q (block, key, kt) and r (block, record, name, kind, rt).
PAIRS = """p AS (SELECT block, key, record, max(CASE WHEN key = name AND kind = 'official' THEN 100.0 WHEN key = name AND kind = 'alias' THEN 90.0
  WHEN key = name AND kind = 'acronym' AND length(name) >= 3 THEN 80.0 WHEN kind <> 'official' THEN NULL
  WHEN len(kt) = len(rt) AND len(list_intersect(kt, rt)) = len(kt) AND len(kt) >= 2 THEN 80.0
  WHEN len(list_intersect(kt, rt)) >= 3 AND 2.0::DOUBLE * len(list_intersect(kt, rt)) / (len(kt) + len(rt)) >= 0.82
  THEN floor(40.5 + 50.0::DOUBLE * (2.0::DOUBLE * len(list_intersect(kt, rt)) / (len(kt) + len(rt)))) END)::DOUBLE AS score
  FROM q JOIN r USING (block) WHERE key = name OR len(list_intersect(kt, rt)) >= 2 GROUP BY 1, 2, 3)"""


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, ws."""
    long = names.longest_words(F.col("text"), 6)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", long.alias("long"))
    return written(docs.select("doc_id", "lang", F.slice("long", F.lit(1), (4 + F.col("doc_id") % 3).cast("int")).alias("ws")), "named")


def _name(words: Column | str) -> Column:
    return F.concat(F.lit("Institute "), F.array_join(words, " "))


def _variant(k: Column) -> tuple[Column, Column]:
    """A record's name and its kind, as the record's number says."""
    shorter = F.slice("ws", F.lit(1), F.greatest(F.size("ws") - 1, F.lit(0)))
    name = (
        F.when(k == 1, F.concat(F.array_join(F.reverse("ws"), " "), F.lit(" institute"))).when(k == 2, _name(shorter))
        .when(k == 4, F.get("ws", F.lit(0))).otherwise(_name("ws"))
    )
    return name, F.when(k == 3, "alias").when(k == 4, "acronym").otherwise("official")


@query(f"""WITH {WORDS}, q AS (SELECT DISTINCT lang AS block, 'institute ' || array_to_string(ws, ' ') AS key, {_tokens("'institute ' || array_to_string(ws, ' ')")} AS kt FROM w),
r AS (SELECT lang AS block, doc_id AS record, {VARIANT} AS name, {KIND} AS kind, {_tokens(VARIANT)} AS rt FROM w), {PAIRS},
k AS (SELECT *, row_number() OVER (PARTITION BY block, key ORDER BY score DESC, record) AS k, score - coalesce(lead(score) OVER (PARTITION BY block, key ORDER BY score DESC, record), 0) AS lead FROM p WHERE score IS NOT NULL)
SELECT doc_id, record, score, lead FROM w JOIN k ON lang = block AND 'institute ' || array_to_string(ws, ' ') = key WHERE k = 1 AND lead >= 5""")
def name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of its language that a name leads to, by classes of names and rarest shared words."""
    named = _named(spark, sf_dir)
    name, kind = _variant(F.col("doc_id") % 5)
    records = named.select(F.col("lang").alias("block"), F.col("doc_id").alias("record"), name.alias("name"), kind.alias("kind"))
    asked = named.select("doc_id", F.col("lang").alias("block"), _name("ws").alias("name"))
    best = identity.leaders(identity.name_scores(asked.select("block", "name"), records))
    at = F.concat_ws("\u0001", "block", "key").alias("at")
    keyed = written(asked.select("doc_id", F.concat_ws("\u0001", "block", names.institution_name(F.col("name"))).alias("at")), "asked")
    return identity.with_lookup(keyed, best.select(at, "record", "score", "lead"), "at").select("doc_id", "record", "score", "lead")


RESOLVED = f"""WITH {WORDS}, d AS (SELECT doc_id, 'institute ' || array_to_string(ws, ' ') AS key, {_tokens("'institute ' || array_to_string(ws, ' ')")} AS kt, {VARIANT} AS name, {KIND} AS kind, {_tokens(VARIANT)} AS rt FROM w),
seeds AS (SELECT doc_id AS seed, key, kt, CASE WHEN doc_id % 13 > 0 THEN ['CN', 'FR', 'NO', 'US', 'DE'][doc_id % 5 + 1] END AS country, CASE WHEN doc_id % 49 = 0 THEN doc_id + 1000000000 WHEN doc_id % 7 = 0 THEN doc_id + doc_id % 3 END AS direct FROM d),
records AS (SELECT doc_id AS record, doc_id % 11 > 0 AS active, [['HK', 'CN'], ['FR'], ['SJ'], ['PR', 'MX'], ['DE']][doc_id % 5 + 1] AS countries, CASE WHEN doc_id % 4 > 0 THEN 'Q' || (doc_id + (doc_id % 9)//8) END AS own, name, kind, rt FROM d),
fit AS (SELECT *, list_distinct(list_concat(countries, CASE WHEN list_has_any(countries, ['HK', 'MO']) THEN ['CN'] ELSE [] END, CASE WHEN list_has_any(countries, ['GF', 'GP', 'MQ', 'RE']) THEN ['FR'] ELSE [] END, CASE WHEN list_contains(countries, 'SJ') THEN ['NO'] ELSE [] END, CASE WHEN list_has_any(countries, ['GU', 'PR', 'VI']) THEN ['US'] ELSE [] END)) AS fits FROM records),
direct AS (SELECT seed, direct AS record, CASE WHEN record IS NULL THEN 'unknown id' WHEN country IS NOT NULL AND NOT list_contains(fits, country) THEN 'outside the country' END AS reason FROM seeds LEFT JOIN fit ON record = direct WHERE direct IS NOT NULL),
aff AS (SELECT seed, record, CASE WHEN NOT list_contains(fits, country) THEN 'outside the country' END AS reason FROM (SELECT doc_id AS seed, doc_id + doc_id % 2 AS hit FROM d WHERE doc_id % 3 = 0) JOIN seeds USING (seed) JOIN fit ON record = hit WHERE direct IS NULL AND country IS NOT NULL),
q AS (SELECT DISTINCT coalesce(country, '*') AS block, key, kt FROM seeds WHERE direct IS NULL),
r AS (SELECT unnest(list_append(fits, '*')) AS block, record, name, kind, rt FROM fit WHERE active), {PAIRS},
k AS (SELECT *, row_number() OVER (PARTITION BY block, key ORDER BY score DESC, record) AS k, score - coalesce(lead(score) OVER (PARTITION BY block, key ORDER BY score DESC, record), 0) AS lead FROM p WHERE score IS NOT NULL AND (block <> '*' OR score >= 100)),
named AS (SELECT seed, CASE WHEN lead >= 5 THEN record END AS record, CASE WHEN lead < 5 THEN 'no lead' END AS reason FROM seeds s JOIN k ON coalesce(s.country, '*') = block AND s.key = k.key WHERE k = 1 AND direct IS NULL),
same AS (SELECT key, count(*) AS n, min(doc_id) AS other FROM d GROUP BY 1),
crossed AS (SELECT seed, other, other + (other % 17)//16 AS record, CASE WHEN other % 6 = 5 THEN 'several claims' WHEN other % 8 = 7 THEN 'no claim' WHEN NOT coalesce(active, false) THEN 'not active' WHEN own <> 'Q' || other THEN 'ids disagree' WHEN NOT list_contains(fits, country) THEN 'outside the country' END AS reason
  FROM seeds JOIN same ON seeds.key = same.key AND n = 1 LEFT JOIN fit ON record = other + (other % 17)//16 WHERE direct IS NULL AND country IS NOT NULL),
j AS (SELECT s.seed, s.direct AS asked, s.country, d.record AS d, d.reason AS dr, a.record AS a, a.reason AS ar, n.record AS n, n.reason AS nr, n.seed IS NOT NULL AS nn, c.record AS c, c.reason AS cr, c.other, c.seed IS NOT NULL AS cc FROM seeds s LEFT JOIN direct d USING (seed) LEFT JOIN aff a USING (seed) LEFT JOIN named n USING (seed) LEFT JOIN crossed c USING (seed)),
m AS (SELECT *, CASE WHEN asked IS NOT NULL AND dr IS NULL THEN 'direct' WHEN a IS NOT NULL AND ar IS NULL THEN 'affiliation' WHEN nn AND nr IS NULL THEN 'query' WHEN cc AND cr IS NULL THEN 'cross' END AS method FROM j)"""


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry of documents: some direct ids, chosen affiliations, name variants, another registry that links back."""
    d, k = _named(spark, sf_dir), F.col("doc_id")
    pick = lambda values: F.get(F.array(*map(F.lit, values)), (k % 5).cast("int"))
    seeds = d.select(
        k.alias("seed"), _name("ws").alias("name"), F.when(k % 13 > 0, pick(["CN", "FR", "NO", "US", "DE"])).alias("country"),
        F.when(k % 49 == 0, k + 1_000_000_000).when(k % 7 == 0, k + k % 3).alias("direct"),
    )
    countries = F.split(pick(["HK CN", "FR", "SJ", "PR MX", "DE"]), " ")
    linked = F.concat(F.lit("Q"), (k + F.floor(k % 9 / 8)).cast("string"))
    name, kind = _variant(k % 5)
    records = d.select(k.alias("record"), (k % 11 > 0).alias("active"), countries.alias("countries"), F.when(k % 4 > 0, linked).alias("other"))
    hits = d.where(k % 3 == 0).select(k.alias("seed"), (k + k % 2).alias("record"), F.lit(1).alias("place"), F.lit(True).alias("chosen"))
    q = F.concat(F.lit("Q"), k.cast("string"))
    others = d.select(q.alias("other"), _name("ws").alias("name"), F.lit("official").alias("kind"))
    to = k + F.floor(k % 17 / 16)
    claims = d.where((k % 8 != 7) | (k % 6 == 5)).select(q.alias("other"), F.explode(F.when(k % 6 == 5, F.array(to, to + 1)).otherwise(F.array(to))).alias("record"))
    known = written(records.select("record"), "known")
    hits = hits.join(known, "record", "semi").select("seed", "record", "place", "chosen")
    return identity.resolved(seeds, records, d.select(k.alias("record"), name.alias("name"), kind.alias("kind")), hits, others, claims)


@query(RESOLVED + """ SELECT seed, CASE method WHEN 'direct' THEN d WHEN 'affiliation' THEN a WHEN 'query' THEN n WHEN 'cross' THEN c END AS record, method, CASE WHEN method = 'cross' THEN 'Q' || other END AS other,
CASE WHEN method IS NOT NULL THEN NULL WHEN asked IS NOT NULL THEN dr WHEN country IS NULL THEN 'no exact match anywhere' WHEN cr IN ('not active', 'ids disagree', 'outside the country') THEN 'cross: ' || cr ELSE 'no unambiguous match in the country' END AS failure FROM m""")
def identity_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who each institution is, by which kind of evidence, or why nobody knows."""
    return _resolved(spark, sf_dir).select("seed", "record", "method", "other", "failure")


@query(RESOLVED + """, x AS (SELECT seed, 'direct' AS kind, dr AS reason FROM m UNION ALL SELECT seed, 'affiliation', ar FROM m UNION ALL SELECT seed, 'query', nr FROM m WHERE coalesce(method, '') NOT IN ('affiliation') UNION ALL SELECT seed, 'cross', cr FROM m WHERE method IS NULL)
SELECT kind, reason, count(*) AS n, min(seed) AS first FROM x WHERE reason IS NOT NULL GROUP BY 1, 2""")
def rejected_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that were rejected on the way, by kind of evidence and reason."""
    each = _resolved(spark, sf_dir).select("seed", F.explode("rejected").alias("r"))
    return each.groupBy(F.col("r.method").alias("kind"), F.col("r.reason").alias("reason")).agg(F.count("*").alias("n"), F.min("seed").alias("first"))


FOLDED = "trim(regexp_replace(replace(lower(strip_accents(coalesce(text, ''))), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
PART = "\\b(?:" + "|".join(evidence.PARTS) + ")\\b"
LAST = "CASE WHEN strpos(reverse({0}), reverse({1})) > 0 THEN length({0}) - strpos(reverse({0}), reverse({1})) + 1 - length({1}) ELSE -1 END"
SAID = f"""{WORDS}, said AS (SELECT doc_id, ['institute ' || array_to_string(ws, ' '), array_to_string(list_reverse(ws[1 : 2]), ' ')] AS names, (1500 + doc_id % 500)::VARCHAR AS year,
  CASE WHEN doc_id % 19 = 0 THEN 'normalised' WHEN doc_id % 17 = 0 THEN 'structured' ELSE 'text' END AS method, {FOLDED} AS body FROM documents JOIN w USING (doc_id)),
told AS (SELECT *, trim(regexp_replace(concat_ws(' ', body, year, ['', names[1], names[2], 'our university', 'the institution', 'nobody', names[1] || ' of ' || names[2]][doc_id % 7 + 1], repeat('and ', doc_id % 45),
  CASE doc_id % 5 WHEN 0 THEN 'school' WHEN 1 THEN 'campuses' ELSE '' END, ['founded', 'established', 'chartered', 'opened', 'founding', 'establishment', 'came into existence', 'begun'][doc_id % 8 + 1],
  repeat('so ', doc_id * 7 % 90), year, 'of', body, year), ' +', ' ', 'g')) AS evidence FROM said)"""


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, names, year, method, evidence: a document's folded text with a sentence on a beginning."""
    pick = lambda values, n: F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), (F.col("doc_id") % n).cast("int"))
    k, year = F.col("doc_id"), (1500 + F.col("doc_id") % 500).cast("string")
    body = names.institution_name(F.coalesce("text", F.lit("")))
    docs = table(spark, sf_dir, "documents").select("doc_id", body.alias("body")).join(_named(spark, sf_dir), "doc_id")
    listed = F.array(F.lower(_name("ws")), F.array_join(F.reverse(F.slice("ws", 1, 2)), " "))
    whole, short = listed[0], listed[1]
    subject = pick(["", whole, short, "our university", "the institution", "nobody", F.concat(whole, F.lit(" of "), short)], 7)
    part = F.when(k % 5 == 0, "school").when(k % 5 == 1, "campuses").otherwise("")
    words = [F.col("body"), year, subject, F.repeat(F.lit("and "), (k % 45).cast("int")), part, pick([*evidence.TRIGGERS, "begun"], 8), F.repeat(F.lit("so "), (k * 7 % 90).cast("int")), year, F.lit("of"), F.col("body"), year]
    method = F.when(k % 19 == 0, "normalised").when(k % 17 == 0, "structured").otherwise("text")
    return docs.select("doc_id", listed.alias("names"), year.alias("year"), method.alias("method"), F.trim(F.regexp_replace(F.concat_ws(" ", *words), " +", " ")).alias("evidence"))


@query(f"""WITH {SAID}, parts AS (SELECT doc_id, names, method, year, string_split(evidence, year) AS ps FROM told),
befores AS (SELECT doc_id, names, ' ' || right(replace(array_to_string(ps[1 : k], '|'), '|', year), {evidence.BEFORE_YEAR}) AS ctx FROM parts, unnest(range(1, len(ps))) u(k)),
placed AS (SELECT doc_id, names, ctx, greatest({", ".join(LAST.format("ctx", f"' {t} '") for t in evidence.TRIGGERS)}) AS spot FROM befores),
subjects AS (SELECT doc_id, names, right(substr(ctx, 1, spot), {evidence.BEFORE_TRIGGER}) AS subject FROM placed WHERE spot >= 0),
hits AS (SELECT doc_id, subject, name, {LAST.format("subject", "name")} AS spot FROM subjects, unnest(names) u(name) WHERE length(name) >= {evidence.SHORTEST_NAME}),
direct AS (SELECT DISTINCT doc_id FROM hits WHERE spot >= 0 AND NOT regexp_matches(substr(subject, 1, spot) || ' ' || substr(subject, spot + length(name) + 1), '{PART}')),
general AS (SELECT DISTINCT doc_id FROM subjects WHERE regexp_matches(subject, '\\b(?:our|the|this) (?:institution|university)\\b') AND NOT regexp_matches(subject, '{PART}'))
SELECT told.doc_id, CASE WHEN method = 'normalised' THEN 140 WHEN method = 'structured' THEN 110 WHEN direct.doc_id IS NOT NULL THEN 80 WHEN general.doc_id IS NOT NULL THEN 55 ELSE 0 END AS score
FROM told LEFT JOIN direct USING (doc_id) LEFT JOIN general USING (doc_id)""")
def founding_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well each text supports a year as that of its institution's beginning."""
    score = evidence.founding_score(F.col("evidence"), F.col("year"), F.col("names"), F.col("method"))
    return _said(spark, sf_dir).select("doc_id", score.alias("score"))


@query(f"""WITH {SAID}, cut AS (SELECT doc_id, name, string_split(evidence, name) AS ps FROM told, unnest(names) u(name) WHERE length(name) >= {evidence.SHORTEST_NAME}),
after AS (SELECT doc_id, left(replace(array_to_string(ps[k + 1 :], '|'), '|', name), {evidence.AFTER_NAME + evidence.AFTER_EXISTENCE + 20}) AS rest FROM cut, unnest(range(1, len(ps))) u(k)),
found AS (SELECT doc_id, regexp_extract(rest, '^(.{{0,{evidence.AFTER_NAME}}}?)\\bcame into existence\\b.{{0,{evidence.AFTER_EXISTENCE}}}?\\b(1[0-9]{{3}}|20[0-9]{{2}})\\b', ['gap', 'year']) AS m FROM after)
SELECT doc_id, min(m.year)::INTEGER AS year FROM found WHERE m.year <> '' AND NOT regexp_matches(m.gap, '{PART}') GROUP BY 1 HAVING count(DISTINCT m.year) = 1""")
def existence_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year in which a text says that its institution came into existence, where it is one."""
    return _said(spark, sf_dir).select("doc_id", evidence.existence_year(F.col("evidence"), F.col("names")).alias("year")).where("year is not null")


@query(f"""WITH t AS (SELECT doc_id, {FOLDED} AS text FROM documents), n AS (SELECT item_id, string_split({FOLDED}, ' ') AS ws FROM benchmark),
x AS (SELECT DISTINCT item_id, array_to_string(ws[p : p + 2], ' ') AS name FROM n, unnest([1, len(ws) // 2]) u(p) WHERE len(ws) >= 3)
SELECT doc_id, item_id, count(*) AS names, min(name) AS first FROM t JOIN x ON contains(' ' || text || ' ', ' ' || name || ' ') GROUP BY 1, 2""")
def name_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which texts mention which names: three words from each item's begin and from its middle."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("text_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = table(spark, sf_dir, "benchmark").select("item_id", F.split(names.institution_name(F.coalesce("text", F.lit(""))), " ").alias("ws")).where(F.size("ws") >= 3)
    placed = items.withColumn("p", F.explode(F.array(F.lit(1), F.floor(F.size("ws") / 2).cast("int"))))
    sought = placed.select(F.col("item_id").alias("entity"), F.array_join(F.slice("ws", F.col("p"), F.lit(3)), " ").alias("name"))
    met = identity.mentions(docs, sought)
    return met.groupBy(F.col("text_id").alias("doc_id"), F.col("entity").alias("item_id")).agg(F.count("*").alias("names"), F.min("name").alias("first"))
