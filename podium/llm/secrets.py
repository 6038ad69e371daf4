"""Secrets in whole texts, by patterns and by character Markov models; DataFrame functions only.

Base kinds are three patterns.  The method adds kind ``random``: a run of at least
``MIN_RUN`` token characters is compared under two character bigram models, one trained
on labelled random strings and one on labelled ordinary identifiers.  A run counts when
the log-likelihood ratio is at least ``MIN_RATIO`` nats and ``MIN_RATIO_PER_CHAR`` a
character, and when it does not overlap a base span.

Spark has no function for the places of all matches, so they come from the lengths of
the matches and of what lies between them, added up in blocks of blocks: work grows with
the number of matches of a long text.

Defined results: a null text is empty and has no spans; repeated rows are reported each;
an empty table gives an empty result; other columns pass through ``redact`` untouched.
Places are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import table

#: The base patterns of the contract.  ``{24,}`` and ``{16,}`` match what the
#: unbounded patterns match after short matches are dropped, because those are whole runs.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
MIN_VALUE = 6

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
MIN_RUN = 20
RUN = r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN
MIN_RATIO, MIN_RATIO_PER_CHAR = 12.0, 0.4
BLOCK = 64
MASK = "[SECRET]"

#: Labelled sample: words that ordinary identifiers are made of.
WORDS = """account action address agent alert array async author backup balance batch block branch buffer build
bucket button cache callback cancel catalog center channel charge check class client cluster column command comment
commit common compile component config connect constant container content context control convert cookie counter
create cursor customer database default delete deploy design detail device digest directory document domain download
driver dynamic editor element email enable encode engine entity entry error event example execute export extend factory
feature field file filter folder format forward frame function gateway generate global group handler header height
history identifier image import index initial input insert install instance integer interface internal invoice item
iterator journal kernel keyword label language layout length level library license limit listener loader location
logger manager mapping market master matrix memory merge message method metric middle migrate mobile model module
monitor network notice number object office offset operator option order origin output package parent parser partition
payload payment pending person picture pipeline platform player pointer policy position prefix preview printer private
process product profile project property protocol provider public publish query queue random range reader receipt
record recover reduce region register release remote render replace report request reset resource response restore
result return review router runtime sample schedule schema screen script search second section segment select sender
sequence server service session setting shadow shared shutdown signal simple single socket source spider split stable
standard station status storage stream string student summary support switch symbol system target template terminal
thread ticket timeline timeout toolbar topic tracker traffic transfer transform trigger tunnel update upload utility
validate value variable vector vendor verify version virtual visible volume warning weather website weight widget
window worker wrapper international understanding nevertheless communication administration responsibility
representation characteristic environnement developpement gouvernement etablissement naturellement generalement
wissenschaft gesellschaft entwicklung verantwortung geschwindigkeit zusammenarbeit veranstaltung desarrollo
conocimiento universidad aproximadamente responsabilidad organizacion comunicacion""".split()


def labelled_samples(spark: SparkSession, rows: int = 3000) -> DataFrame:
    """(random boolean, text): a bounded sample, ``rows`` of either label at most."""
    words = F.lit(WORDS)
    pick = lambda k: F.element_at(words, (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(WORDS))) + 1).cast("int"))
    ids = spark.range(rows)
    name = [pick(k) for k in range(4)]
    styles = F.array(
        F.concat(*name), F.concat_ws("_", *name), F.concat_ws("-", *name[:3]), F.upper(F.concat_ws("_", *name[:3])),
        F.concat(name[0], *[F.initcap(x) for x in name[1:]]), F.concat_ws("/", *name), F.concat(F.concat_ws("_", *name[:3]), F.pmod("id", F.lit(100))),
        F.repeat(F.substring(F.lit(ALPHABET), (F.floor(F.col("id") / 8) % len(ALPHABET) + 1).cast("int"), F.lit(1)), F.lit(400)),
    )
    ordinary = ids.select(F.lit(False).alias("random"), F.element_at(styles, (F.col("id") % 8 + 1).cast("int")).alias("text"))
    digest = F.sha2(F.col("id").cast("string"), 256)
    plain = F.base64(F.unhex(digest))
    kinds = F.array(digest, plain, F.upper(F.regexp_replace(plain, "[^A-Za-z0-9]", "")), F.translate(plain, "+/=", "-_"))
    secret = ids.select(F.lit(True).alias("random"), F.element_at(kinds, (F.col("id") % 4 + 1).cast("int")).alias("text"))
    return ordinary.union(secret)


def train(samples: DataFrame) -> list[float]:
    """log P(b | a, random) - log P(b | a, ordinary), a after a of the alphabet; at most two counts a pair reach the driver."""
    size = len(ALPHABET)
    chars = samples.select("random", F.filter(F.split("text", ""), lambda c: F.lit(ALPHABET).contains(c) & (c != "")).alias("chars"))
    at = F.sequence(F.lit(1), F.size("chars") - 1)
    pairs = chars.where(F.size("chars") > 1).select("random", F.explode(F.transform(at, lambda i: F.concat(F.element_at("chars", i), F.element_at("chars", i + 1)))).alias("pair"))
    counts = {True: {}, False: {}}
    for row in pairs.groupBy("random", "pair").count().collect():
        counts[row["random"]][row["pair"]] = row["count"]
    ratios = []
    for a in ALPHABET:
        logs = {}
        for label, seen in counts.items():
            total = sum(seen.get(a + b, 0) for b in ALPHABET)
            logs[label] = [math.log((seen.get(a + b, 0) + 0.5) / (total + 0.5 * size)) for b in ALPHABET]
        ratios += [round(r - o, 3) for r, o in zip(logs[True], logs[False])]
    return ratios


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` computed once however often ``then`` uses it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def located(text: Column, pattern: str) -> Column:
    """array<struct<s, e, found>> of all leftmost non-overlapping matches."""

    def places(found: Column, between: Column) -> Column:
        steps = F.transform(found, lambda x, i: F.length(F.element_at(between, i + 1)) + F.when(i > 0, F.length(F.element_at(found, F.greatest(i, F.lit(1))))).otherwise(0))

        def sums(values: Column) -> Column:
            blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
            return F.transform(blocks, lambda k: _sum(F.slice(values, k * BLOCK + 1, BLOCK)))

        def before(values: Column, i: Column, starts: Column) -> Column:
            """The sum of the first ``i`` values, from those before each block."""
            k = F.floor(i / BLOCK).cast("int")
            return F.element_at(starts, k + 1) + _sum(F.slice(values, k * BLOCK + 1, i - k * BLOCK))

        def add_up(d: Column) -> Column:
            def spots(b: Column, c: Column) -> Column:
                tops = F.transform(c, lambda x, k: _sum(F.slice(c, 1, k)))  # a value for BLOCK * BLOCK matches
                starts = let(tops, lambda t: F.transform(b, lambda x, k: before(b, k, t)))
                return let(starts, lambda s: F.transform(found, lambda x, i: spot(d, s, x, i)))

            return let(sums(d), lambda b: let(sums(b), lambda c: spots(b, c)))

        def spot(d: Column, starts: Column, x: Column, i: Column) -> Column:
            s = before(d, i, starts) + F.element_at(d, i + 1)
            return F.struct(s.alias("s"), (s + F.length(x)).alias("e"), x.alias("found"))

        return let(steps, add_up)

    none = F.expr("cast(array() as array<struct<s:int,e:int,found:string>>)")
    matched = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(let(F.split(text, pattern, -1), lambda between: places(found, between))))
    return matched


def find(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """Adds ``base`` and ``spans``, arrays of struct<s, rank, e, kind> by place."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def of(kind: str, rank: int, matches: Column) -> Column:
        return F.transform(matches, lambda m: F.struct(m["s"].alias("s"), F.lit(rank).alias("rank"), m["e"].alias("e"), F.lit(kind).alias("kind")))

    assigns = F.filter(located(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["found"], ASSIGN, 2)) >= MIN_VALUE)
    base = F.array_sort(F.concat(of("assign", 0, assigns), of("access", 1, located(text, ACCESS)), of("hex", 2, located(text, HEX))))
    weights = F.split(F.lit(" ".join(map(str, ratios))), " ").cast("array<double>")
    place = lambda c: F.instr(F.lit(ALPHABET), c)

    def ratio(run: Column) -> Column:
        pair = lambda codes, i: F.element_at(weights, (F.element_at(codes, i) - 1) * len(ALPHABET) + F.element_at(codes, i + 1))
        codes = F.transform(F.filter(F.split(run, ""), lambda c: c != ""), place)
        return let(codes, lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda a, i: a + pair(c, i)))

    def counts(m: Column) -> Column:
        return let(ratio(m["found"]), lambda r: (r >= MIN_RATIO) & (r >= MIN_RATIO_PER_CHAR * F.length(m["found"])))

    based = docs.withColumns({"base": base, "runs": F.filter(located(text, RUN), counts)})
    free = F.filter("runs", lambda m: ~F.exists("base", lambda b: (b["s"] < m["e"]) & (m["s"] < b["e"])))
    return based.withColumn("spans", F.array_sort(F.concat("base", of("random", 3, free)))).drop("runs")


def redact(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """``docs`` with every span of the text replaced; all columns stay, n_chars follows the text."""
    clash = {c: f"_kept_{c}" for c in docs.columns if c in ("base", "runs", "spans")}
    found = find(docs.withColumnsRenamed(clash), ratios)
    begin = F.struct(F.expr("cast(array() as array<string>)").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, span: Column) -> Column:
        piece = F.array(F.substring("text", acc["at"] + 1, span["s"] - acc["at"]), F.lit(MASK))
        out = F.when(span["s"] >= acc["at"], F.concat(acc["out"], piece)).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], span["e"]).alias("at"))

    finish = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text")))
    cleaned = F.when(F.size("spans") > 0, F.aggregate("spans", begin, step, finish)).otherwise(F.col("text"))
    out = found.withColumn("text", cleaned).drop("base", "spans")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.withColumnsRenamed({v: k for k, v in clash.items()}).select(*[f"`{c}`" for c in docs.columns])


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, train(labelled_samples(spark)))
    joined = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
