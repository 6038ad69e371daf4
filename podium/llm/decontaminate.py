"""Benchmark decontamination by templates; DataFrame functions only.

Words become template tokens: a number is ``<num>``, a unit after a number ``<unit>``, a
capitalised word ``<name>``, any other word its lower case.  Windows of five tokens are
hashed (64 bits of five 64-bit word hashes) and joined with the benchmark's.  A template
window needs ``MIN_LITERALS`` plain words: one with fewer is lengthened, forwards and
backwards, until it holds them (at most to the length of the benchmark's longest).
Besides, every window has a literal key (lower-case words), so that a passage is found
whatever its case.  An item of fewer than five tokens is one window of its own length.

Matched windows of a document and an item on one diagonal form an alignment.  In it each
slot value of the item must stand for one value of the document throughout; this admits
re-parameterised questions and drops chance meetings of templates.  A document leaks an
item when the consistent windows cover at least ``MIN_SIMILARITY`` of the item's.

Defined results: null or wordless texts and items have no windows and take no part; rows
without a doc_id are searched like others and reported with a null doc_id; rows of one
doc_id with different texts are searched each for itself; repeated rows give one result;
an empty table on either side gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import bounded, table
from podium.llm.secrets import let

WINDOW = 5
MIN_SIMILARITY = 0.8
MIN_LITERALS = 2
#: The benchmark's windows are broadcast up to this many rows (about 400 bytes each), else shuffled.
MOST_BROADCAST = 200_000
#: Codes of placeholders; other words have their hash.
NUMBER, UNIT, NAME = 1, 2, 3
TOKEN = r"[0-9]+(?:[.,][0-9]+)*|[\p{L}\p{M}]+|\p{N}"
#: Units of measure that may follow a number.
UNITS = """mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l s sec min h hr hrs ms ns kb mb gb tb hz khz mhz ghz
w kw mw v a ma j kj cal kcal pa kpa bar k c f percent usd eur gbp dollars dollar euros euro cents cent pounds pound
meters meter metres metre kilometers kilometer miles mile feet foot inches inch grams gram kilograms kilogram tons ton
liters liter litres litre seconds second minutes minute hours hour days day weeks week months month years year
degrees degree""".split()


def tokens(df: DataFrame) -> DataFrame:
    """Adds ``raw`` (words) and ``told``: for each word its literal hash ``l`` and template code ``c``."""
    raw = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(TOKEN), F.lit(0))
    units = F.lit(UNITS)
    number = lambda word: F.substring(word, 1, 1).between("0", "9")

    def coded(word: Column, i: Column) -> Column:
        before = F.element_at("raw", F.greatest(i, F.lit(1)))

        def of(low: Column) -> Column:
            literal = F.xxhash64(low)
            first = F.substring(word, 1, 1)
            code = (
                F.when(number(word), NUMBER)
                .when((i > 0) & number(before) & F.array_contains(units, low), UNIT)
                .when(first != F.lower(first), NAME)
                .otherwise(literal)
            )
            return F.struct(literal.alias("l"), code.alias("c"))

        return let(F.lower(word), of)

    return df.withColumn("raw", raw).withColumn("told", F.transform("raw", coded))


def _plain(word: Column) -> Column:
    return word["c"] == word["l"]


def _hash(words: Column, code: str) -> Column:
    """Of any number of tokens but ``WINDOW``."""
    return F.xxhash64(F.lit(code), F.transform(words, lambda w: w[code]))


def _lengthened(n: Column, most: Column) -> Column:
    """array<struct<at, template, first, length, hash>>: windows with too few plain words, until they hold ``MIN_LITERALS``.

    Only documents that have such windows pay for them: four slots among five tokens show in ``mask``.
    """
    at_most = F.greatest(F.least(most, n), F.lit(WINDOW))
    flag = F.transform("told", lambda w: _plain(w).cast("int"))

    def reach(marks: Column) -> Column:
        """Tokens until MIN_LITERALS plain ones are among ``marks``, null where they are not to be had."""
        length = F.lit(0)
        for _ in range(MIN_LITERALS):
            step = F.array_position(F.slice(marks, length + 1, F.greatest(F.size(marks) - length, F.lit(0))), F.lit(1)).cast("int")
            length = length + F.when(step > 0, step)
        return length

    def both(flags: Column, i: Column) -> Column:
        begin = F.greatest(i + WINDOW - at_most, F.lit(1))
        window = lambda first, length: F.struct(i.alias("at"), F.lit(True).alias("template"), first.alias("first"), length.alias("length"), F.when(length.isNotNull(), _hash(F.slice("told", first, F.coalesce(length, F.lit(0))), "c")).alias("hash"))
        ahead = let(reach(F.slice(flags, i, at_most)), lambda k: window(i, k))
        behind = let(reach(F.reverse(F.slice(flags, begin, i + WINDOW - begin))), lambda k: window(F.coalesce(i + WINDOW - k, i), k))
        return F.array(ahead, behind)

    def dense(flags: Column) -> Column:
        few = lambda i: F.aggregate(F.slice(flags, i, WINDOW), F.lit(0), lambda a, x: a + x) < MIN_LITERALS
        return F.flatten(F.transform(F.filter(F.sequence(F.lit(1), n - WINDOW + 1), few), lambda i: both(flags, i)))

    mask = F.array_join(F.transform("told", lambda w: F.when(_plain(w), "p").otherwise("s")), "")
    return F.when((n >= WINDOW) & mask.rlike("ssss|sspss|spsss|sssps"), let(flag, dense))


def _short(n: Column, lengths: list[int]) -> list[Column]:
    """Arrays of the windows of items that have fewer tokens than ``WINDOW``."""

    def windows(m: int) -> Column:
        def at(i: Column) -> Column:
            words = F.slice("told", i, m)
            plain = F.size(F.filter(words, _plain))
            keys = [(False, _hash(words, "l")), (True, F.when((plain >= MIN_LITERALS) & (plain < m), _hash(words, "c")))]
            return F.array(*[F.struct(i.alias("at"), F.lit(template).alias("template"), i.alias("first"), F.lit(m).alias("length"), key.alias("hash")) for template, key in keys])

        return F.when(n >= m, F.flatten(F.transform(F.sequence(F.lit(1), n - m + 1), at)))

    return [windows(m) for m in lengths]


def keyed(df: DataFrame, longest: Column | int, short: list[int]) -> DataFrame:
    """A row a window and key: ``df``'s columns, ``hash``, and what ``placed`` needs to tell the window.

    Windows longer than ``longest`` have no key; ``short`` are the lengths below ``WINDOW`` to look
    for.  All of a document's numbers stand in one array and a window's key is a hash of five of
    them, so that the loop over windows compiles to a small method that copies no arrays.
    """
    n = F.size("told")
    none = F.expr("cast(array() as array<struct<at:int,template:boolean,first:int,length:int,hash:bigint>>)")
    extra = F.concat(*[F.coalesce(x, none) for x in [_lengthened(n, F.lit(longest) if isinstance(longest, int) else longest), *_short(n, short)]])
    df = df.withColumn("extra", F.filter(extra, lambda x: x["hash"].isNotNull()))
    df = df.withColumns({"n": n, "usual": F.greatest(n - WINDOW + 1, F.lit(0)), "codes": F.concat(F.col("told")["l"], F.col("told")["c"], F.col("extra")["hash"])})
    total = 2 * F.col("usual") + F.size("extra")
    rows = df.select("*", F.explode(F.when(total > 0, F.sequence(F.lit(0), total - 1))).alias("k"))
    begin = F.when(F.col("k") < F.col("usual"), F.col("k")).otherwise(F.col("k") - F.col("usual") + F.col("n"))
    five = F.xxhash64(*[F.get("codes", begin + j) for j in range(WINDOW)])
    side = F.when(F.col("k") < F.col("usual"), F.lit(0)).otherwise(F.lit(-1)).cast("long")  # literal and template keys are apart
    rows = rows.withColumn("hash", F.when(F.col("k") < 2 * F.col("usual"), five.bitwiseXOR(side)).otherwise(F.get("codes", F.col("k") + 2 * (F.col("n") - F.col("usual")))))
    return rows.drop("codes")


def placed(rows: DataFrame) -> DataFrame:
    """``keyed`` rows with ``at`` (from 1), ``template`` and the tokens ``first``, ``length`` of the window."""
    usual = F.col("k") < 2 * F.col("usual")
    other = F.get("extra", F.col("k") - 2 * F.col("usual"))
    at = F.when(usual, F.pmod("k", F.greatest("usual", F.lit(1))) + 1)
    out = rows.withColumns({
        "at": F.coalesce(at, other["at"]), "template": F.when(usual, F.col("k") >= F.col("usual")).otherwise(other["template"]),
        "first": F.coalesce(at, other["first"]), "length": F.when(usual, WINDOW).otherwise(other["length"]),
    })
    return out.drop("k", "extra", "n", "usual")


def windows_of(benchmark: DataFrame) -> tuple[DataFrame, int, list[int]]:
    """The benchmark's windows, the tokens of the longest, and the lengths of items below ``WINDOW``."""
    told = tokens(benchmark.select("item_id", "text").dropDuplicates()).withColumn("item_of", F.xxhash64("text")).drop("text")
    few = F.size("raw") < WINDOW
    short = sorted(r["n"] for r in told.where(few & (F.size("raw") > 0)).select(F.size("raw").alias("n")).distinct().collect())
    rows = placed(keyed(told, F.size("raw"), short)).where(F.when(few, F.col("length") == F.size("raw")).otherwise(F.col("length") >= WINDOW))
    slots = F.size(F.filter(F.slice("told", F.col("first"), F.col("length")), lambda w: ~_plain(w)))
    rows = rows.where(~F.col("template") | (F.col("length") != WINDOW) | slots.between(1, WINDOW - MIN_LITERALS))
    items = rows.select(
        "item_id", "item_of", F.greatest(F.size("raw") - WINDOW + 1, F.lit(1)).alias("windows"), F.col("at").alias("item_at"), F.col("template").alias("item_template"), "hash",
        F.slice("raw", F.col("first"), F.col("length")).alias("item_raw"), F.slice("told", F.col("first"), F.col("length")).alias("item_told"),
    )
    longest = items.agg(F.max(F.size("item_raw")).alias("n")).first()["n"] or WINDOW
    return items, longest, short


def places(docs: DataFrame, longest: int, short: list[int]) -> DataFrame:
    """doc_id, of (a hash of the text), hash, raw and what ``narrow`` needs, a row a window and key."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("of"), "text")
    return keyed(tokens(texts).drop("text"), longest, short).drop("told")


def narrow(rows: DataFrame) -> DataFrame:
    """The window's own words, ``here``, instead of the text's: rows of bounded size."""
    rows = placed(rows)
    return rows.withColumn("here", F.slice("raw", F.col("first"), F.col("length"))).drop("raw", "first", "length")


def met(docs: DataFrame, items: DataFrame, longest: int, short: list[int]) -> DataFrame:
    """Windows of documents with the benchmark's windows of the same key."""
    rows, few = places(docs, longest, short), bounded(items, MOST_BROADCAST)
    if few is not items:  # probed where they are made: a text's words are looked at for matches only
        found = narrow(rows.join(few, "hash"))
    else:  # a shuffle follows, so rows get their own words before it
        found = narrow(rows).join(items, "hash")
    return found.where(F.col("template") == F.col("item_template")).drop("item_template", "hash")


def leaked_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What ``leaks`` returns, and ``of``, the hash of the document's text."""
    items, longest, short = windows_of(benchmark)
    here = F.col("here")
    kind = lambda i: F.element_at("item_told", i + 1)
    slot = lambda word, i: F.when(kind(i)["c"] != kind(i)["l"], F.struct(kind(i)["c"].alias("kind"), word.alias("asked"), F.element_at(here, i + 1).alias("said")))
    slots = F.when(F.col("template"), F.filter(F.transform("item_raw", slot), lambda x: x.isNotNull()))
    same = here == F.col("item_raw")
    pair = ["doc_id", "of", "item_id", "item_of", "windows"]
    rows = met(docs, items, longest, short).select(*pair, "item_at", (F.col("at") - F.col("item_at")).alias("diagonal"), "template", slots.alias("slots"), same.alias("same"))
    lined = rows.groupBy(*pair, "diagonal").agg(
        F.collect_set("item_at").alias("places"),
        F.collect_set(F.when(~F.col("template"), F.col("item_at"))).alias("literal_places"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
        F.collect_set(F.when(F.col("same"), F.col("item_at"))).alias("same"),
    )
    asked = F.array_distinct(F.transform("slots", lambda x: F.struct(x["kind"], x["asked"])))
    consistent = F.size("slots") == F.size(asked)
    lined = lined.select(*pair, F.when(consistent, F.col("places")).otherwise(F.col("literal_places")).alias("places"), "same")
    covered = lined.groupBy(*pair).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("matched"),
        F.size(F.array_distinct(F.flatten(F.collect_set("same")))).cast("long").alias("same"),
    )
    similarity = F.col("matched") / F.col("windows")
    leaked = covered.where(similarity >= MIN_SIMILARITY)
    return leaked.select("doc_id", "of", "item_id", similarity.alias("similarity"), "matched", F.col("windows").cast("long").alias("windows"), (F.col("same") == F.col("windows")).alias("verbatim"))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, similarity, matched, windows, verbatim: one row per leaked item of a document."""
    return leaked_rows(docs, benchmark).drop("of")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item, whether they have a doc_id or not."""
    leaked = leaked_rows(docs, benchmark).select(F.col("doc_id").alias("__leak_id"), F.col("of").alias("__leak_of")).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__leak_id")) & (F.xxhash64(docs["text"]) == F.col("__leak_of"))
    return docs.join(leaked.hint("merge"), same, "left_anti")  # the ids grow with the corpus: always a shuffled join


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
