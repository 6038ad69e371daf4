"""Which registry record an institution is: names compared by class, and a cascade of evidence with reasons for what it rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.functions import names as N
from podium.functions.places import TERRITORIES, same_country
from podium.sources.landing import written

#: Scores of the classes of agreement, the least Dice similarity and shared tokens, and the lead that a match needs.
OFFICIAL, ALIAS, ACRONYM, SAME_TOKENS = 100, 90, 80, 80
LEAST_DICE, LEAST_SHARED, LEAD = 0.82, 3, 5
SHORTEST_ACRONYM = 3
EVERYWHERE = "*"
#: A token of more sets of its block than this is often; sets of more tokens than ``LONG`` meet by single tokens all the same.
OFTEN, LONG = 100, 16
#: Keys with more than one row in so many are looked up by broadcast; there are at most as many.
HOT = 1000


def with_lookup(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``lookup`` (one row a key); the rows of a hot key do not meet in one task."""
    total = rows.count()
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).count()
    hot = [r[0] for r in counts.where(F.col("count") > max(HOT, total / HOT)).collect()]  # HOT at most
    if not hot:
        return rows.join(lookup, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return rows.where(~is_hot).join(lookup.where(~is_hot), key, how).unionByName(rows.where(is_hot).join(F.broadcast(lookup.where(is_hot)), key, how))


def _prefix(n: Column) -> Column:
    """How many of its rarest tokens a set of ``n`` must show, so that any set alike enough shows one of them too."""
    least_other = F.ceil(n * LEAST_DICE / (2 - LEAST_DICE) - 1e-9)
    needed = F.greatest(F.ceil(LEAST_DICE / 2 * (n + least_other) - 1e-9), F.lit(LEAST_SHARED))
    return F.greatest(n - needed + 1, F.lit(0))


def _joined(tokens: Column) -> Column:
    return F.array_join(tokens, "\u0001")


def _triples(tokens: Column) -> Column:
    """All three of ``tokens``, in their order."""

    def after(x: Column, rest: Column) -> Column:
        return F.flatten(F.transform(rest, lambda y, j: F.transform(F.slice(rest, j + 2, F.size(rest)), lambda z: _joined(F.array(x, y, z)))))

    return F.flatten(F.transform(tokens, lambda x, i: after(x, F.slice(tokens, i + 2, F.size(tokens)))))


def _met(left: DataFrame, right: DataFrame) -> DataFrame:
    """The sets of both sides that show a key in common, a row for each such key."""
    sides, ratio = {"left": left, "right": right}, LEAST_DICE / (2 - LEAST_DICE)
    shown = {side: df.select("block", "sig", "tokens", F.explode("tokens").alias("token")) for side, df in sides.items()}
    frequency = written(
        shown["left"].select("block", "token").unionByName(shown["right"].select("block", "token")).groupBy("block", "token").agg(F.count("*").alias("n")), "frequency"
    ).select(F.concat_ws("\u0001", "block", "token").alias("at"), "n")

    def prefixes(side: str) -> DataFrame:
        rows = written(shown[side].select("block", "sig", "token", F.concat_ws("\u0001", "block", "token").alias("at")), f"tokens_{side}")
        ordered = with_lookup(rows, frequency, "at").groupBy("block", "sig").agg(F.array_sort(F.collect_list(F.struct("n", "token"))).alias("order"))
        ordered = ordered.withColumn("size", F.size("order")).withColumn("single", _prefix(F.col("size")).cast("int")).where("single > 0")
        shows = ordered.withColumn("longer", F.slice("order", F.lit(1), F.col("single") + LEAST_SHARED - 1))
        shows = shows.withColumn("often", F.transform(F.filter("longer", lambda s: s["n"] > OFTEN), lambda s: s["token"]))
        alone = F.filter(F.slice("order", F.lit(1), F.col("single")), lambda s: (s["n"] <= OFTEN) | (F.col("size") > LONG * ratio))
        keys = F.transform(alone, lambda s: F.struct((s["n"] > OFTEN).alias("often"), s["token"].alias("by")))
        size, rare = F.col("size"), F.size("longer") - F.size("often")
        others = F.sequence(F.ceil(size * ratio - 1e-9).cast("int"), F.least(F.floor(size / ratio + 1e-9), F.lit(LONG)).cast("int"))

        def shown_to(other: Column) -> Column:  # the more two sets must share, the fewer tokens each shows
            needed = F.greatest(F.ceil(LEAST_DICE / 2 * (size + other) - 1e-9), F.lit(LEAST_SHARED)).cast("int")
            triples = _triples(F.slice("often", F.lit(1), F.greatest(size - needed + LEAST_SHARED - rare, F.lit(0))))
            return F.transform(triples, lambda t: F.struct(F.lit(None).cast("boolean").alias("often"), _joined(F.array(t, *(n.cast("string") for n in ((size, other) if side == "left" else (other, size))))).alias("by")))

        threes = F.flatten(F.transform(others, shown_to))
        met_by = F.when((F.size("often") >= LEAST_SHARED) & (F.col("size") <= LONG), F.concat(keys, threes)).otherwise(keys)
        out = shows.select("block", F.col("sig").alias(f"{side}_sig"), F.col("order.token").alias(f"{side}_tokens"), F.col("longer.token").alias(f"{side}_prefix"), F.explode(met_by).alias("key"))
        return out.select("*", "key.*").drop("key")

    return prefixes("left").join(prefixes("right").drop("often"), ["block", "by"])


def similar_token_sets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(block, left_sig, right_sig, shared, dice) of different token sets that are alike enough.

    Both sides have block, sig (unique in its block) and tokens.  A pair is found by the rarest token that
    both prefixes hold, and counted there only; sizes too far apart do not meet.  Where that token is often, so
    are all that the pair shares, and it is found by the rarest three, which stand in prefixes longer by two, and
    by both sizes, which tell how long those are.
    """
    a, b = F.size("left_tokens"), F.size("right_tokens")
    ratio = LEAST_DICE / (2 - LEAST_DICE)
    met = _met(left, right).where((a >= b * ratio - 1e-9) & (b >= a * ratio - 1e-9) & (F.col("left_sig") != F.col("right_sig")))
    common, is_long = F.array_intersect("left_prefix", "right_prefix"), F.greatest(a, b) > LONG
    by_three = F.col("often").isNull() & ~is_long & (F.col("by") == _joined(F.concat(F.slice(common, F.lit(1), F.lit(LEAST_SHARED)), F.array(a.cast("string"), b.cast("string")))))
    first = met.where(F.when(F.col("often").isNull(), by_three).otherwise((~F.col("often") | is_long) & (F.col("by") == F.get(common, F.lit(0)))))
    counted = first.withColumn("shared", F.size(F.array_intersect("left_tokens", "right_tokens"))).withColumn("dice", 2.0 * F.col("shared") / (a + b))
    return counted.where((F.col("shared") >= LEAST_SHARED) & (F.col("dice") >= LEAST_DICE)).select("block", "left_sig", "right_sig", "shared", "dice")


def name_scores(left: DataFrame, right: DataFrame) -> DataFrame:
    """(block, key, record, score): for each left name the records of its block with a name alike, by their best name.

    ``left`` has block and name; ``right`` has block, record, name and kind (official, alias or acronym).
    Equal names are compared once: ``key`` is the name as it is compared.  Of several records with one name the
    least and the greatest are returned, which shows that there are several.
    """
    held = F.concat_ws(" ", N.tokens(F.col("key")))
    asked = written(left.select("block", N.institution_name(F.col("name")).alias("key")).where("key <> ''").distinct().withColumn("sig", held), "asked")
    told = written(right.select("block", "record", "kind", N.institution_name(F.col("name")).alias("key")).where("key <> ''").withColumn("sig", held), "told")
    ends = (F.min("record").alias("low"), F.max("record").alias("high"))

    equal = told.groupBy("block", "key", "kind").agg(*ends).withColumn(
        "score", F.when(F.col("kind") == "official", OFFICIAL).when(F.col("kind") == "alias", ALIAS).when((F.col("kind") == "acronym") & (F.length("key") >= SHORTEST_ACRONYM), ACRONYM)
    ).where("score is not null")
    by_name = asked.join(equal, ["block", "key"]).select("block", "key", "low", "high", F.col("score").cast("double").alias("score"))

    official = told.where("kind = 'official' and sig <> ''").groupBy("block", "sig").agg(*ends)
    same = asked.where(F.size(F.split("sig", " ")) >= 2).join(official, ["block", "sig"]).select("block", "key", "low", "high", F.lit(float(SAME_TOKENS)).alias("score"))

    sets = [df.select("block", "sig").where(F.size(F.split("sig", " ")) >= LEAST_SHARED).distinct().withColumn("tokens", F.split("sig", " ")) for df in (asked, official)]
    pairs = similar_token_sets(*sets).withColumnRenamed("left_sig", "sig")
    found = pairs.join(official.withColumnRenamed("sig", "right_sig"), ["block", "right_sig"])
    alike = asked.join(found, ["block", "sig"]).select("block", "key", "low", "high", F.floor(40.5 + 50 * F.col("dice")).cast("double").alias("score"))

    each = by_name.unionByName(same).unionByName(alike).select("block", "key", "score", F.explode(F.array_distinct(F.array("low", "high"))).alias("record"))
    return each.groupBy("block", "key", "record").agg(F.max("score").alias("score"))


def leaders(scores: DataFrame, least_lead: float = LEAD, least_score: float = 0.0) -> DataFrame:
    """(block, key, record, score, lead): the best record of each name, if it leads the next by ``least_lead``."""
    order = Window.partitionBy("block", "key").orderBy(F.desc("score"), "record")
    ranked = scores.where(F.col("score") >= least_score).withColumns({"__n": F.row_number().over(order), "lead": F.col("score") - F.coalesce(F.lead("score").over(order), F.lit(0.0))})
    return ranked.where((F.col("__n") == 1) & (F.col("lead") >= least_lead)).drop("__n")


def _blocks(countries: Column) -> Column:
    """The countries whose institutions a record may be: its own, and those that hold its territories."""
    holders = [F.when(F.arrays_overlap(countries, F.array(*map(F.lit, held))), F.lit(country)) for country, held in TERRITORIES.items()]
    return F.array_distinct(F.filter(F.concat(countries, F.array(*holders)), lambda c: c.isNotNull()))


def resolved(seeds: DataFrame, records: DataFrame, names: DataFrame, affiliations: DataFrame, other_names: DataFrame, claims: DataFrame) -> DataFrame:
    """seed, record, method, other, failure, rejected (array of method, record, reason): who each seed is, and why not.

    seeds: seed, name, country (null: unknown), direct (a record id or null).  records: record, active,
    countries (array), other (its id in the other registry, or null).  names: record, name, kind.
    affiliations: seed, record, place, chosen.  other_names: other, name, kind.  claims: other, record (links of
    the other registry to this one).

    The kinds of evidence, in order; the next is asked only where one names nothing:
    direct id, and nothing else where a seed has one; the first chosen affiliation in the seed's country; the
    name, among active records of the country and with a lead of 5, or without a country anywhere and
    exactly; the other registry's only best name, if it claims one record only, which is active and names
    no other id itself.  A record outside the seed's country is rejected at last.

    Defined results: an unknown direct id is a failure; null names match nothing; rows that repeat count
    once; seeds are keyed by ``seed``, of which repeated rows are one; empty tables match nothing.
    """
    seeds = written(seeds.groupBy("seed").agg(*(F.min(c).alias(c) for c in ("name", "country", "direct"))).withColumnRenamed("direct", "asked"), "seeds")
    records = written(records.groupBy("record").agg(F.max("active").alias("active"), F.min("countries").alias("countries"), F.min("other").alias("own_other")), "records")
    country, has_direct = F.col("country"), F.col("asked").isNotNull()

    def looked_up(df: DataFrame, column: str) -> DataFrame:
        return with_lookup(df, records.withColumnRenamed("record", column), column, "left")

    def verdict(df: DataFrame, method: str, reason: Column) -> DataFrame:
        """One row a seed: what a kind of evidence names, and why that is rejected (null: it holds)."""
        return df.select("seed", F.struct(F.lit(method).alias("method"), F.col("record").cast("long").alias("record"), F.col("other").alias("other"), reason.alias("reason")).alias(method))

    outside = country.isNotNull() & ~F.coalesce(same_country(country, F.col("countries")), F.lit(False))
    none = F.lit(None).cast("string")
    direct = seeds.where(has_direct).select("seed", "country", F.col("asked").alias("record"), none.alias("other"))
    direct = verdict(looked_up(direct, "record"), "direct", F.when(F.col("active").isNull(), "unknown id").when(outside, "outside the country"))

    chosen = affiliations.where("chosen").groupBy("seed").agg(F.min_by("record", "place").alias("record"))
    chosen = written(seeds.where(~has_direct & country.isNotNull()).select("seed", "country").join(chosen, "seed").withColumn("other", none), "chosen")
    affiliation = verdict(looked_up(chosen, "record"), "affiliation", F.when(outside, "outside the country"))

    open_seeds = written(seeds.where(~has_direct).select("seed", "country", F.col("name"), F.coalesce("country", F.lit(EVERYWHERE)).alias("block")), "open")
    active = with_lookup(written(names, "names"), records.where("active").select("record", "countries"), "record")
    everywhere = active.withColumn("block", F.explode(F.concat(_blocks(F.col("countries")), F.array(F.lit(EVERYWHERE))))).select("block", "record", "name", "kind")
    scores = written(name_scores(open_seeds.select("block", "name"), everywhere), "scores").where((F.col("block") != EVERYWHERE) | (F.col("score") >= OFFICIAL))
    at = F.concat_ws("\u0001", "block", N.institution_name(F.col("name")))
    keyed = written(open_seeds.withColumn("at", at), "keyed")
    best = scores.groupBy("block", "key").agg(F.max_by("record", "score").alias("record")).join(leaders(scores).select("block", "key", F.col("record").alias("led")), ["block", "key"], "left")
    best = best.select(F.concat_ws("\u0001", "block", "key").alias("at"), F.coalesce("led", "record").alias("record"), F.col("led").isNull().alias("unclear"))
    query = verdict(with_lookup(keyed, best, "at").withColumn("other", none), "query", F.when(F.col("unclear"), "no lead"))

    others = name_scores(keyed.where(country.isNotNull()).select(F.lit(EVERYWHERE).alias("block"), "name"), other_names.select(F.lit(EVERYWHERE).alias("block"), F.col("other").alias("record"), "name", "kind"))
    only = leaders(others, 1e-9).select("key", F.col("record").alias("other"))
    claimed = claims.groupBy("other").agg(F.countDistinct("record").alias("n"), F.min("record").alias("record"))
    only = written(only.join(claimed, "other", "left").select("key", "other", "n", "record"), "only")  # a look-up reads it twice
    asked = written(keyed.where(country.isNotNull()).select("seed", "country", N.institution_name(F.col("name")).alias("key")), "asked")
    crossed = looked_up(written(with_lookup(asked, only, "key"), "crossed"), "record")
    reason = (
        F.when(F.coalesce(F.col("n"), F.lit(0)) == 0, "no claim").when(F.col("n") > 1, "several claims").when(~F.coalesce("active", F.lit(False)), "not active")
        .when(F.upper("own_other") != F.upper("other"), "ids disagree").when(outside, "outside the country")
    )
    cross = verdict(crossed, "cross", reason)

    out = seeds
    for kind in (direct, affiliation, query, cross):
        out = out.join(kind, "seed", "left")
    kinds = ("direct", "affiliation", "query", "cross")
    holds = {k: F.col(k).isNotNull() & F.col(f"{k}.reason").isNull() for k in kinds}
    decided = F.lit(None).cast("string")
    for k in reversed(kinds):
        decided = F.when(holds[k], k).otherwise(decided)
    out = out.withColumn("method", decided)
    place = F.coalesce(F.array_position(F.array(*map(F.lit, kinds)), F.col("method")), F.lit(len(kinds) + 1))
    asked_before = F.filter(F.array(*kinds), lambda s: s.isNotNull() & s["reason"].isNotNull() & (F.array_position(F.array(*map(F.lit, kinds)), s["method"]) < place))
    rejected = F.transform(asked_before, lambda s: F.struct(s["method"].alias("method"), s["record"].alias("record"), s["reason"].alias("reason")))
    picked = F.coalesce(*(F.when(F.col("method") == k, F.col(k)) for k in kinds))
    failure = F.when(F.col("method").isNotNull(), None).when(has_direct, F.col("direct_reason")).when(country.isNull(), "no exact match anywhere").when(
        F.col("cross.reason").isin("not active", "ids disagree", "outside the country"), F.concat(F.lit("cross: "), F.col("cross.reason"))).otherwise("no unambiguous match in the country")
    out = out.withColumn("direct_reason", F.col("direct.reason"))
    return out.select("seed", picked["record"].alias("record"), "method", picked["other"].alias("other"), failure.alias("failure"), rejected.alias("rejected"))


def mentions(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(text_id, entity, name) of names that stand in a text as whole words.

    ``texts`` has text_id and text, ``names`` has entity and name; both are folded to words.  A name is
    looked for where its rarest word occurs, by an equi-join of words; then its whole is looked for.
    """
    folded = written(texts.select("text_id", N.institution_name(F.col("text")).alias("text")), "folded")
    sought = written(names.select("entity", N.institution_name(F.col("name")).alias("name")).where("name <> ''").distinct(), "sought")
    spelt = sought.select("name").distinct().select("name", F.explode(F.array_distinct(F.split("name", " "))).alias("word"))
    words = spelt.select("word").distinct()
    held = folded.select("text_id", F.explode(F.array_distinct(F.split("text", " "))).alias("word"))
    held = written(with_lookup(written(held, "held"), words, "word"), "known")
    frequency = held.groupBy("word").agg(F.count("*").alias("n"))
    rare = spelt.join(frequency, "word", "left").groupBy("name").agg(F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), "word")).alias("word"))
    candidates = held.join(rare, "word").select("text_id", "name")
    met = candidates.join(folded, "text_id").where(F.contains(F.concat(F.lit(" "), F.col("text"), F.lit(" ")), F.concat(F.lit(" "), F.col("name"), F.lit(" "))))
    return met.select("text_id", "name").join(sought, "name").select("text_id", "entity", "name")
