"""Constraints on the tables of a dataset, a table in one pass.

All rules on a table's own rows are aggregates of one scan; keys and references are aggregates
by key, joined by key; what the metadata says is compared with what those scans counted.  Of the rows
that break a rule a few are named, so that nothing grows with the faults.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.sources.landing import written

#: Rows that are named of those that break a rule.
NAMED = 5
FAULT = "check string, bad_rows long, offenders array<string>"
LEVELS = ("high", "medium", "low")


def _offenders(bad: Column, key: Column, most: int = NAMED) -> Column:
    """At most ``most`` keys of bad rows: the least of each of as many shares, so the aggregate has a fixed size."""
    share = F.pmod(F.xxhash64(key), F.lit(most))
    return F.array_sort(F.array_compact(F.array(*[F.min(F.when(bad & (share == k), key)) for k in range(most)])))


def checked(df: DataFrame, rules: dict[str, Column], key: str) -> DataFrame:
    """check, bad_rows, offenders: rows for which a rule is false or null, all rules in one scan."""
    named = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    aggregates = []
    for k, rule in enumerate(rules.values()):
        bad = ~F.coalesce(rule, F.lit(False))
        aggregates += [F.count_if(bad).alias(f"n{k}"), _offenders(bad, named).alias(f"o{k}")]
    row = df.agg(*aggregates)
    told = F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"n{k}").alias("bad_rows"), F.col(f"o{k}").alias("offenders")) for k, name in enumerate(rules)])
    return row.select(F.explode(told).alias("f")).select("f.*")


def unique(df: DataFrame, keys: list[str], check: str) -> DataFrame:
    """Rows beyond the first of each key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    named = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    bad = F.col("__n") > 1
    return counts.agg(F.lit(check).alias("check"), F.coalesce(F.sum(F.when(bad, F.col("__n") - 1)), F.lit(0)).alias("bad_rows"), _offenders(bad, named).alias("offenders"))


def referenced(df: DataFrame, key: str, parent: DataFrame, parent_key: str, check: str) -> DataFrame:
    """Rows whose key the parent lacks; null refers to nothing.  Keys are counted before they meet, so a hot one is one row."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("__n"))
    lost = counts.join(parent.select(F.col(parent_key).alias("__key")).distinct(), "__key", "anti")
    return lost.agg(F.lit(check).alias("check"), F.coalesce(F.sum("__n"), F.lit(0)).alias("bad_rows"), _offenders(F.lit(True), F.col("__key").cast("string")).alias("offenders"))


def dataset_faults(tables: dict[str, DataFrame]) -> DataFrame:
    """check, bad_rows, offenders for every check, those without faults too.

    metrics: metric, kind, unit.  institutions: entity, identity_source, website_source (may be null).  sources: source_id.
    observations: observation_id, entity, metric, source_id, kind, unit, value, frame, confidence, comparable, conflict (a
    group's id or null).  canonical: entity, metric, source_id, observation_id, value, frame, level, reason.
    meta: one row of institutions, sources, observations, canonical, conflicting, selected, unresolved and
    coverage (array of metric, observations, entities, canonical, sorted by metric).
    """
    metrics, institutions, sources, meta = (tables[t] for t in ("metrics", "institutions", "sources", "meta"))
    observations, canonical = written(tables["observations"], "observations"), written(tables["canonical"], "canonical")

    shapes = metrics.groupBy("metric").agg(F.first(F.struct("kind", "unit")).alias("__defined"))
    with_shape = observations.join(F.broadcast(shapes) if shapes.limit(1001).count() <= 1000 else shapes, "metric", "left")
    own = checked(with_shape, {
        "observation with another shape than its metric's": F.col("__defined").isNull() | F.struct("kind", "unit").eqNullSafe(F.col("__defined")),
        "confidence outside 0 to 1": F.col("confidence").between(0, 1),
    }, "observation_id")

    held = observations.dropDuplicates(["observation_id"]).select("observation_id", F.struct(*[F.col(c) for c in ("entity", "metric", "source_id", "value", "frame")]).alias("__held"), F.col("comparable").alias("__comparable"))
    chosen = canonical.join(held, "observation_id", "left")
    known = F.col("__held").isNotNull()
    of = F.struct(*[F.col(c) for c in ("entity", "metric", "source_id", "value", "frame")])
    picks = checked(chosen, {
        "canonical value of an unknown observation": known,
        "canonical value that its observation does not hold": ~known | of.eqNullSafe(F.col("__held")),
        "canonical value of an observation for display only": ~known | F.coalesce("__comparable", F.lit(False)),
        "selection without a level or reason": F.col("level").isin(*LEVELS) & (F.length(F.coalesce("reason", F.lit(""))) > 0),
    }, "observation_id")

    founded = observations.where((F.col("metric") == "founded") & F.col("comparable")).select("entity").distinct()
    unchosen = founded.join(canonical.where("metric = 'founded'").select("entity"), "entity", "anti")
    missing = unchosen.agg(F.lit("comparable founding year without a canonical one").alias("check"), F.count("*").alias("bad_rows"), _offenders(F.lit(True), F.col("entity").cast("string")).alias("offenders"))

    seen = observations.groupBy("metric").agg(F.count("*").alias("observations"), F.countDistinct("entity").alias("entities"))
    picked = canonical.groupBy("metric").agg(F.count("*").alias("canonical"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    coverage = metrics.select("metric").distinct().join(seen, "metric", "left").join(picked, "metric", "left").select("metric", zero("observations"), zero("entities"), zero("canonical"))
    told = coverage.agg(F.array_sort(F.collect_list(F.struct("metric", "observations", "entities", "canonical"))))  # a row a metric
    conflicts = observations.where("conflict is not null").select("entity", "metric").distinct()
    counted = {"institutions": institutions, "sources": sources, "observations": observations, "canonical": canonical, "conflicting": conflicts}
    facts = meta.withColumns({f"__{n}": df.agg(F.count("*")).scalar() for n, df in counted.items()} | {"__coverage": told.scalar()})
    recorded = checked(facts.withColumn("__meta", F.lit("meta")), {
        **{f"metadata: {n}": F.col(n) == F.col(f"__{n}") for n in counted},
        "metadata: selected": F.col("selected") == F.col("institutions") + F.col("unresolved"),
        "metadata: coverage": F.transform("coverage", lambda c: F.to_json(c)) == F.transform("__coverage", lambda c: F.to_json(c)),
    }, "__meta")

    parts = [
        unique(metrics, ["metric"], "repeated metric"), unique(institutions, ["entity"], "repeated institution"), unique(sources, ["source_id"], "repeated source"),
        unique(observations, ["observation_id"], "repeated observation"), unique(canonical, ["entity", "metric"], "several canonical values"),
        referenced(institutions, "identity_source", sources, "source_id", "institution of an unknown source"),
        referenced(institutions, "website_source", sources, "source_id", "website of an unknown source"),
        referenced(observations, "entity", institutions, "entity", "observation of an unknown institution"),
        referenced(observations, "source_id", sources, "source_id", "observation of an unknown source"),
        referenced(observations, "metric", metrics, "metric", "observation of an unknown metric"),
        own, picks, missing, recorded,
    ]
    return reduce(DataFrame.unionByName, parts)
