"""Mixing sources to target weights under a limit of repetitions.

Weights share out all words of the corpus.  No source may be read more than ``epochs``
times: the targets are a water level, min(epochs * size, level * weight), found by clamping
the sources above their limit and sharing their excess by weight until none is above.

A source's target is met by whole repetitions of all its documents and one fractional one:
documents are drawn in the order of a seeded hash until the words still wanting are there,
the last of them in part.  The place in that order where a source stops is found digit by
digit of the hash, by sums over its buckets, so a source is never sorted whole.

Defined results: a null or wordless text has size 0 and is never taken; a null source is a
source of its own, after all others; rows that are equal in doc_id, text and source share a
hash, and where the draw stops among them each gives the same part (so up to one word a row
is left out); a corpus without words has targets of 0; an empty table gives an empty
result; other columns pass through, but ``size``, ``source_size``, ``target`` and ``taken``
are replaced.  Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.llm.common import in_order, materialise, met, table

WORD = r"[^\x20\x09-\x0D]+"
EPOCHS, SEED = 3, 17
#: The hash has 60 bits; buckets are told apart by so many at a time.
BITS, DIGIT = 60, 12
#: Digits that are fixed before single hashes are sorted: a source's last bucket holds 1 row in 2^24.
DIGITS = 2


def weighted(sources: DataFrame, weights: list[int]) -> DataFrame:
    """``sources`` (__key, source_size) with ``weight``, dealt in turn by the order of the keys."""
    placed = in_order(sources, ["__key"], [], "sources")
    turn = F.array(*map(F.lit, weights))
    return placed.withColumn("weight", F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int"))).drop("place")


def with_targets(sources: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``: weights share the sum of sizes, at most ``epochs`` of each size."""
    limit, weight = epochs * F.col("source_size"), F.col("weight")
    total, level, clamped = sources.agg(F.sum("source_size")).first()[0] or 0, None, -1
    while True:
        above = F.lit(False) if level is None else limit < F.lit(level) * weight
        full, n, open_weight = sources.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0)), F.count(F.when(above, 1)), F.coalesce(F.sum(F.when(~above, weight)), F.lit(0))
        ).first()  # one row: clamped sources only ever become more
        if n == clamped:
            break
        clamped, level = n, (total - full) / open_weight if open_weight else 0.0
    return sources.withColumn("target", F.least(limit.cast("double"), F.lit(float(level or 0.0)) * weight))


def _key(source: str) -> Column:
    """A source as text that sorts by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source).cast("string")), F.lit("1"))


def _digit(k: int) -> Column:
    return F.shiftright("__hash", BITS - DIGIT * (k + 1)).bitwiseAND((1 << DIGIT) - 1)


def _stops(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources`` with ``__stop``, the hash where its draw stops, and ``__part``, the words that each row of that hash gives.

    ``rows`` has __key, __hash and size; ``sources`` has __key and __need, the words of the fractional repetition.
    """
    state, left = sources.where("__need > 0").select("__key", F.col("__need").alias("__want"), F.lit(0).cast("long").alias("__prefix")), rows.where("size > 0")
    order = Window.partitionBy("__key")
    for k in range(DIGITS):
        inside = met(left, state, "__key").where(F.shiftright("__hash", BITS - DIGIT * k) == F.col("__prefix"))
        sums = inside.groupBy("__key", "__want", "__prefix", _digit(k).alias("__digit")).agg(F.sum("size").alias("__sum"))
        upto = F.sum("__sum").over(order.orderBy("__digit"))  # 2^DIGIT rows a source at most
        reached = sums.withColumn("__upto", upto).where("__upto >= __want and __upto - __sum < __want")
        state = materialise(
            reached.select("__key", (F.col("__want") - F.col("__upto") + F.col("__sum")).alias("__want"), (F.shiftleft("__prefix", DIGIT) + F.col("__digit")).alias("__prefix")), f"digit{k}"
        )
    inside = met(left, state, "__key").where(F.shiftright("__hash", BITS - DIGIT * DIGITS) == F.col("__prefix"))
    sums = inside.groupBy("__key", "__want", "__hash").agg(F.sum("size").alias("__sum"), F.count("*").alias("__n"))
    reached = sums.withColumn("__upto", F.sum("__sum").over(order.orderBy("__hash"))).where("__upto >= __want and __upto - __sum < __want")
    found = reached.select("__key", F.col("__hash").alias("__stop"), F.floor((F.col("__want") - F.col("__upto") + F.col("__sum")) / F.col("__n")).alias("__part"))
    return sources.join(found, "__key", "left")


def mixed(docs: DataFrame, weights: list[int], epochs: int = EPOCHS, seed: int = SEED, source: str = "source") -> DataFrame:
    """``docs`` with size (words), source_size, target (its source's words in the mix) and taken (its own, repeats counted)."""
    plain = docs.drop("size", "source_size", "target", "taken")
    # each word becomes one sign, with the white space before it
    signs = F.rtrim(F.regexp_replace("text", r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", "\u0001"), F.lit(" \t\n\u000b\u000c\r"))
    size = F.coalesce(F.length(signs), F.lit(0)).cast("long")
    coded = plain.withColumns({"__key": _key(source), "size": size, "__hash": F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text", source), 64 - BITS)})
    rows = materialise(coded.select("__key", "size", "__hash"), "sizes")
    sources = with_targets(weighted(rows.groupBy("__key").agg(F.sum("size").alias("source_size")), weights), epochs)
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    needs = sources.withColumn("__whole", whole).withColumn("__need", F.floor(F.col("target") + 0.5) - F.col("__whole") * F.col("source_size"))
    draws = materialise(_stops(rows, materialise(needs, "targets")), "draws")
    once = (
        F.when(F.col("__stop").isNull(), 0).when(F.col("__hash") < F.col("__stop"), F.col("size"))
        .when(F.col("__hash") == F.col("__stop"), F.least("size", "__part")).otherwise(0)
    )
    taken = met(coded, draws.drop("weight", "__need"), "__key").withColumn("taken", (F.col("__whole") * F.col("size") + once).cast("long"))
    return taken.select(*plain.columns, "size", "source_size", "target", "taken")


def repetitions(mix: DataFrame) -> DataFrame:
    """The mix itself: a row for each time a document is read, with ``text`` cut to the words taken of it the last time."""
    size, taken, nth = F.col("size"), F.col("taken"), F.col("repetition")
    read = mix.where(taken > 0).withColumn("repetition", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(taken / size))))
    rest = taken - (nth - 1) * size
    words = F.slice(F.regexp_extract_all("text", F.lit(WORD), 0), F.lit(1), rest.cast("int"))
    return read.withColumn("text", F.when(rest >= size, F.col("text")).otherwise(F.array_join(words, " ")))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; sources weigh 1, 2, 3 in turn."""
    return mixed(table(spark, sf_dir, "documents"), [1, 2, 3]).select("doc_id", "size", "source_size", "target", "taken")
