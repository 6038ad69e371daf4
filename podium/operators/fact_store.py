"""An observation store: conflicts, canonical values, coverage, integrity.

Observations have entity, metric, frame (period and scope), value, source, priority
(0 official, 1 registry) and score (evidence).  They are only ever added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.functions.facts import stable_id

STRONG, LEAD = 80, 25


def mark_conflicts(observations: DataFrame) -> DataFrame:
    """Adds ``conflicting``: two values or more in one (entity, metric, frame)."""
    keys = ["entity", "metric", "frame"]
    counts = observations.groupBy(*keys).agg((F.countDistinct("value") >= 2).alias("conflicting"))
    return observations.join(counts, keys)


def select_canonical(observations: DataFrame) -> DataFrame:
    """(entity, metric, value, confidence, reason): one value an entity and metric, by this table:

    one official value: high, or medium if the registry has another; several official values:
    the one the registry has (high), else the best if it scores ``STRONG`` and leads by ``LEAD``
    (medium), else the registry's (low), else the best (low); no official value: the registry's
    if there is one only (medium), else none.
    """
    values = observations.groupBy("entity", "metric", "priority", "value").agg(F.max("score").alias("score"))
    official, registry = values.where("priority = 0"), values.where("priority = 1")
    best = official.groupBy("entity", "metric").agg(
        F.count("*").alias("n"), F.max_by("value", F.struct("score", -F.col("value"))).alias("best"),
        F.array_sort(F.collect_list(-F.col("score"))).alias("scores"), F.collect_set("value").alias("values"),
    )
    other = registry.groupBy("entity", "metric").agg(F.count("*").alias("m"), F.min("value").alias("registered"))
    both = best.join(other, ["entity", "metric"], "full")
    n, m, top = F.coalesce("n", F.lit(0)), F.coalesce("m", F.lit(0)), F.get("scores", F.lit(0))
    lead = -top + F.coalesce(F.get("scores", F.lit(1)), F.lit(0))
    agreed = (m == 1) & F.coalesce(F.array_contains("values", F.col("registered")), F.lit(False))
    chosen = lambda value, confidence, reason: F.struct(F.col(value).alias("value"), F.lit(confidence).alias("confidence"), F.lit(reason).alias("reason"))
    rule = (
        F.when((n == 1) & ((m == 0) | agreed), chosen("best", "high", "official"))
        .when(n == 1, chosen("best", "medium", "official-registry-differs"))
        .when((n > 1) & agreed, chosen("registered", "high", "corroborated"))
        .when((n > 1) & (-top >= STRONG) & (lead >= LEAD), chosen("best", "medium", "strongest"))
        .when((n > 1) & (m == 1), chosen("registered", "low", "registry"))
        .when(n > 1, chosen("best", "low", "best-of-several"))
        .when(m == 1, chosen("registered", "medium", "registry-only"))
    )
    return both.select("entity", "metric", rule.alias("r")).where("r is not null").select("entity", "metric", "r.*")


def coverage(metrics: DataFrame, observations: DataFrame, canonical: DataFrame) -> DataFrame:
    """Per metric: observations, entities observed, entities with a canonical value; metrics without any keep zeros."""
    seen = observations.groupBy("metric").agg(F.count("*").alias("observations"), F.countDistinct("entity").alias("entities"))
    chosen = canonical.groupBy("metric").agg(F.count("*").alias("canonical"))
    out = metrics.join(seen, "metric", "left").join(chosen, "metric", "left")
    return out.select("metric", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("observations", "entities", "canonical")])


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def orphans(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")


def violations(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, bad_rows) of assertion tables, each of which should be empty."""
    parts = [df.agg(F.lit(name).alias("check"), F.count("*").alias("bad_rows")) for name, df in checks.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def build(observed: DataFrame, metrics: DataFrame) -> dict[str, DataFrame]:
    """The five tables of a fact dataset: sources, institutions, metrics, observations, canonical.

    ``observed`` has entity, metric, frame, value, source, retrieved, priority and score.  Ids are
    made of what they stand for, so the same facts have the same ids in every build; the same
    observation found twice is one row, with its best score and latest retrieval.  A canonical
    row points at the best observation that holds its value.
    """
    source_id = lambda: stable_id("src_", F.col("source"))
    own = ["entity", "metric", "frame", "value", "source"]
    once = observed.groupBy(*own, "priority").agg(F.max("score").alias("score"), F.max("retrieved").alias("retrieved"))
    observations = once.withColumns({"source_id": source_id(), "observation_id": stable_id("obs_", *[F.col(c) for c in own])})
    sources = once.groupBy("source").agg(F.max("retrieved").alias("retrieved"), F.count("*").alias("observations")).withColumn("source_id", source_id())
    institutions = once.groupBy("entity").agg(F.count("*").alias("observations"), F.countDistinct("metric").alias("metrics"))
    best = observations.groupBy("entity", "metric", "value").agg(F.max_by("observation_id", F.struct(-F.col("priority"), "score", "observation_id")).alias("observation_id"))
    canonical = select_canonical(observations).join(best, ["entity", "metric", "value"])
    return {"sources": sources, "institutions": institutions, "metrics": metrics, "observations": observations.drop("source"), "canonical": canonical}


def faults(dataset: dict[str, DataFrame], plausible: Column) -> DataFrame:
    """(check, bad_rows): what must not be in a dataset; ``plausible`` reads metric and value."""
    observations, canonical = dataset["observations"], dataset["canonical"]
    named = canonical.select("entity", "metric", "observation_id", F.col("value").alias("chosen"))
    held = observations.select("observation_id", F.col("entity").alias("of_entity"), F.col("metric").alias("of_metric"), F.col("value").alias("of_value"))
    differ = ~(F.col("entity").eqNullSafe(F.col("of_entity")) & F.col("metric").eqNullSafe(F.col("of_metric")) & F.col("chosen").eqNullSafe(F.col("of_value")))
    return violations({
        "repeated observation id": repeated_keys(observations, ["observation_id"]),
        "repeated source id": repeated_keys(dataset["sources"], ["source_id"]),
        "several canonical values": repeated_keys(canonical, ["entity", "metric"]),
        "observation without source": orphans(observations, dataset["sources"], "source_id", "source_id"),
        "observation without institution": orphans(observations, dataset["institutions"], "entity", "entity"),
        "observation of an unknown metric": orphans(observations, dataset["metrics"], "metric", "metric"),
        "canonical value without observation": orphans(canonical, observations, "observation_id", "observation_id"),
        "canonical value that its observation does not hold": named.join(held, "observation_id").where(differ),
        "implausible value": observations.where(~plausible),
    })
