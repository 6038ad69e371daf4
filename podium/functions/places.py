"""Countries as a dimension: codes, names and territories.

Codes and English names are the JDK's, all of ISO 3166-1.  What else publishers call a country is a
table of the user's (alias, code); a dimension of one's own can be passed wherever one is taken
(columns alpha2, alpha3, name).
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.functions.names import ascii_fold, words

#: Fixed values of ISO 3166-1: English short names that differ from the JDK's, and the code that it reserves for a country.
ISO_NAMES = """BO Bolivia (Plurinational State of);BN Brunei Darussalam;CD Congo (Democratic Republic of the);CG Congo (Republic of the);CV Cabo Verde
CI C\u00f4te d'Ivoire;CZ Czech Republic;FM Micronesia (Federated States of);GB United Kingdom of Great Britain and Northern Ireland;GB UK;HK Hong Kong
IR Iran (Islamic Republic of);KP Korea (Democratic People's Republic of);KR Korea (Republic of);LA Lao People's Democratic Republic
MD Moldova (Republic of);MK North Macedonia;MM Myanmar;MO Macao;NL Netherlands (Kingdom of the);PS Palestine (State of);RU Russian Federation
SY Syrian Arab Republic;SZ Eswatini;TL Timor-Leste;TR T\u00fcrkiye;TW Taiwan (Province of China);TZ Tanzania (United Republic of)
US United States of America;VA Holy See;VE Venezuela (Bolivarian Republic of);VN Viet Nam"""
#: Names to show in place of the official English ones.
DISPLAY = """BO Bolivia;BN Brunei;CN China;CZ Czechia;GB United Kingdom;HK Hong Kong;IR Iran;KR South Korea;MD Moldova;MO Macau;PS Palestine
RU Russia;TW Taiwan;TZ Tanzania;US United States;VN Vietnam;XK Kosovo"""
#: Territories that a country's registry may hold.
TERRITORIES = {"CN": ("HK", "MO"), "FR": ("GF", "GP", "MQ", "RE"), "NO": ("SJ",), "US": ("GU", "PR", "VI")}
MULTINATIONAL = ("mul", "multinational")


@lru_cache(maxsize=4)
def _countries(spark: SparkSession) -> tuple[tuple[str, str, str], ...]:
    locale = spark.sparkContext._jvm.java.util.Locale
    there = [locale("", code) for code in locale.getISOCountries()]
    return tuple((x.getCountry(), x.getISO3Country(), x.getDisplayCountry(locale.ENGLISH)) for x in there)


def country_dim(spark: SparkSession) -> DataFrame:
    """alpha2, alpha3, name of all countries."""
    return spark.createDataFrame(list(_countries(spark)), "alpha2 string, alpha3 string, name string")


def _spellings(name: str) -> list[str]:
    """"Iran (Islamic Republic of)" is also the Islamic Republic of Iran."""
    if not name.endswith(")"):
        return [name]
    short, form = name[:-1].split(" (")
    return [f"{short} {form}", f"{form} {short}"] if form.split()[-1] in ("of", "the") else [f"{short} {form}"]


def country_keys(spark: SparkSession, dim: DataFrame | None = None, aliases: DataFrame | None = None) -> DataFrame:
    """key → code: alpha-2, alpha-3, names and the user's ``aliases`` (alias, code), normalised; one row a key."""
    dim = country_dim(spark) if dim is None else dim
    key = lambda c: words(ascii_fold(F.col(c)))
    parts = [dim.select(key(c).alias("key"), F.col("alpha2").alias("code")) for c in ("alpha2", "alpha3", "name")]
    listed = [(spelt, code) for line in ISO_NAMES.splitlines() for code, name in (x.split(" ", 1) for x in line.split(";")) for spelt in _spellings(name)]
    named = spark.createDataFrame(listed, "alias string, code string")
    parts += [df.select(key("alias").alias("key"), "code") for df in (named, aliases) if df is not None]
    return reduce(DataFrame.union, parts).groupBy("key").agg(F.min("code").alias("code"))


def _key(text: Column) -> Column:
    """Normalised; single letters, as in "U.S.A.", are one word."""
    plain = words(ascii_fold(text))
    return F.when(plain.rlike("^[a-z]( [a-z])+$"), F.replace(plain, F.lit(" "))).otherwise(plain)


def country_texts(raw: Column) -> list[Column]:
    """A cell as keys, the first that is known counts: the whole without a trailing "(XXX)", what follows its last comma."""
    bare = F.regexp_replace(F.trim(raw), r"\s*\([A-Za-z]{2,3}\)\s*$", "")
    return [_key(bare), _key(F.element_at(F.split(bare, ","), -1))]


def with_country(df: DataFrame, raw: str, keys: DataFrame, code: str = "country_code") -> DataFrame:
    """Adds ``code`` by joins with the (small, fixed) key dimension."""
    out = df
    for k, key in enumerate(country_texts(F.col(raw))):
        told = F.broadcast(keys.select(F.col("key").alias("__key"), F.col("code").alias(f"__code_{k}")))
        out = out.withColumn("__key", key).join(told, "__key", "left").drop("__key")
    return out.withColumn(code, F.coalesce("__code_0", "__code_1")).drop("__code_0", "__code_1")


def country_labels(spark: SparkSession, dim: DataFrame | None = None) -> DataFrame:
    """code → label: what ``DISPLAY`` says, else the English name."""
    dim = country_dim(spark) if dim is None else dim
    shown = spark.createDataFrame([tuple(x.split(" ", 1)) for line in DISPLAY.splitlines() for x in line.split(";")], "alpha2 string, shown string")
    return dim.join(shown, "alpha2", "full").select(F.col("alpha2").alias("code"), F.coalesce("shown", "name").alias("label"))


def row_country(df: DataFrame, columns: list[str], keys: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds country_code and country: of the first of ``columns`` that resolves; else no code and the fallback
    label of the first one that is not blank.  A small broadcast join for each column."""
    there = [c for c in columns if c in df.columns]
    out, codes = df, []
    for k, c in enumerate(there):
        out = with_country(out, c, keys, f"__code{k}")
        codes.append(F.col(f"__code{k}"))
    blank_is_null = [F.when(F.trim(c) != "", F.col(c)) for c in there]
    out = out.withColumn("country_code", F.coalesce(*codes)).drop(*[f"__code{k}" for k in range(len(there))])
    named = out.join(F.broadcast(labels.select(F.col("code").alias("country_code"), F.col("label").alias("__label"))), "country_code", "left")
    return named.withColumn("country", F.coalesce("__label", fallback_label(F.coalesce(*blank_is_null)))).select(*df.columns, "country_code", "country")


def fallback_label(raw: Column) -> Column:
    """What to show where no code resolves."""
    text = F.trim(raw)
    multi = F.lower(text).isin(*MULTINATIONAL)
    return F.when(text.isNull() | (text == "") | text.rlike("^[A-Za-z]{2,3}$"), "Unknown").when(multi, "Multinational").otherwise(text)


def same_country(expected: Column, found: Column) -> Column:
    """``found`` (an array of codes) holds the expected country or one of its territories."""
    hit = F.array_contains(found, expected)
    for country, held in TERRITORIES.items():
        hit |= (expected == country) & F.arrays_overlap(found, F.array(*map(F.lit, held)))
    return hit
