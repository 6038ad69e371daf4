"""Names: folding, normalising, tokens and similarity.

NFKD folding has no built-in, so it is an Arrow-batched UDF for the rows that are not ASCII; all else is built in.
"""

import html
import re
import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The named references that publishers' tables use; others stay as they are.
ENTITIES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "#39": "'"}
#: Words that carry no identity in an institution's name.
STOP_WORDS = ("the", "of", "and", "at", "in", "for", "de", "du", "des", "la", "le", "der", "die", "das", "und", "et", "di", "del", "y", "university", "universitat", "universite", "universidad")
#: Rows of a batch that are Python strings at once.
SLICE = 128
#: Every byte as a lower-case letter A to Z, or else a blank.
_LETTERS = bytes(b | 32 if bytes([b]).isalpha() else 32 for b in range(256))
_REFERENCE = re.compile(r"&(#\d+|#[xX][0-9a-fA-F]+|[a-zA-Z]+|#39);")


def _decode(text: str) -> str:
    def one(match: re.Match) -> str:
        name = match[1]
        if name in ENTITIES:
            return ENTITIES[name]
        if name.startswith("#"):
            return html.unescape(match[0])
        return match[0]

    return _REFERENCE.sub(one, text)


def _fold(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def _ascii(text: str) -> str:
    return unicodedata.normalize("NFKD", text).encode("ascii", "ignore").decode()


def _mapped(function: Callable[[str], str], column: Column, needed: Column, plain: Column) -> Column:
    """An Arrow-batched UDF for the rows that need it; the others stay in the JVM as ``plain``.

    A batch holds thousands of whole texts, so ``SLICE`` of them at a time become Python strings.
    """

    def run(text: pa.Array) -> pa.Array:  # made where it is used, as workers import this module too
        parts = [pa.array([None if x is None else function(x) for x in text.slice(at, SLICE).to_pylist()], pa.string()) for at in range(0, len(text), SLICE)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return F.when(needed, F.arrow_udf(run, "string")(F.when(needed, column))).otherwise(plain)


def _is_ascii(column: Column) -> Column:
    return F.length(column) == F.octet_length(column)


def decode_entities(text: Column | str) -> Column:
    """Numeric references and the few named ones of ``ENTITIES``."""
    column = F.col(text) if isinstance(text, str) else text
    return _mapped(_decode, column, F.contains(column, F.lit("&")), column)


def fold(text: Column | str) -> Column:
    """Lower case without combining marks (NFKD); other letters stay."""
    column = F.col(text) if isinstance(text, str) else text
    return _mapped(_fold, column, ~_is_ascii(column), F.lower(column))


def ascii_fold(text: Column | str) -> Column:
    """NFKD without anything that is not ASCII."""
    column = F.col(text) if isinstance(text, str) else text
    return _mapped(_ascii, column, ~_is_ascii(column), column)


def words(text: Column) -> Column:
    """Lower-case words of ASCII letters and digits, blanks between."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "&", " and "), "['’`]", "")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def normalize_name(name: Column) -> Column:
    """A key for institution names: references decoded, marks and dashes gone, no leading "the"."""
    plain = F.translate(decode_entities(name), "*‐‑‒–—―", "       ")
    return F.regexp_replace(words(ascii_fold(plain)), "^the ", "")


def institution_name(name: Column) -> Column:
    """A key for comparing an institution's names: marks folded, & is "and", words of ASCII letters and digits."""
    return F.trim(F.regexp_replace(F.regexp_replace(fold(name), "&", " and "), "[^a-z0-9]+", " "))


def searchable_names(name_list: Column, shortest: int = 8) -> Column:
    """Folded names of at least ``shortest`` characters, longest first: what is looked for in a page's text."""
    kept = F.filter(F.array_distinct(name_list), lambda n: F.length(n) >= shortest)
    return F.transform(F.array_sort(F.transform(kept, lambda n: F.struct((-F.length(n)).alias("n"), n.alias("name")))), lambda s: s["name"])


def _longest(text: bytes, most: int) -> list[str]:
    words = text.translate(_LETTERS).split()
    for least in (12, 8, 0):  # most texts have enough long words, so that few are sorted
        found = {w for w in words if len(w) >= least}
        if len(found) >= most:
            break
    return [w.decode() for w in sorted(found, key=lambda w: (-len(w), w))[:most]]


def longest_words(text: Column, most: int) -> Column:
    """The ``most`` longest distinct words of the letters A to Z, in lower case, ties by the alphabet; none of null.

    An Arrow-batched UDF, as built-in functions would make and sort all words of a text.
    """

    def run(text: pa.Array) -> pa.Array:
        parts = [pa.array([_longest(x or b"", most) for x in text.slice(at, SLICE).cast(pa.binary()).to_pylist()], pa.list_(pa.string())) for at in range(0, len(text), SLICE)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(text)


def subject_labels(df: DataFrame, scope: str, labels: DataFrame) -> DataFrame:
    """Adds ``label``: what ``labels`` (scope, label) says, else the scope in title case without "field-"."""
    known = labels.select(F.col("scope").alias("__scope"), F.col("label").alias("__label"))
    plain = title_case(F.regexp_replace(scope, "^field-", ""))
    return df.join(F.broadcast(known), F.col(scope) == F.col("__scope"), "left").withColumn("label", F.coalesce("__label", plain)).drop("__scope", "__label")


#: How registries write their ids.
IDS = {"openalex": r"\b(I[0-9]+)\b", "ror": r"(?:ror\.org/|^)(0[a-z0-9]{8})\b", "wikidata": r"\b(Q[0-9]+)\b"}


def captured_id(text: Column, registry: str) -> Column:
    found = F.regexp_extract(text, IDS[registry], 1)
    return F.when(found != "", found)


def with_aliases(df: DataFrame, key: str, aliases: DataFrame) -> DataFrame:
    """``key`` replaced by its canonical form where ``aliases`` (alias, canonical) has one."""
    out = df.join(aliases.select(F.col("alias").alias("__alias"), F.col("canonical").alias("__canonical")), df[key] == F.col("__alias"), "left")
    return out.withColumn(key, F.coalesce("__canonical", key)).drop("__alias", "__canonical")


def slug(text: Column, separator: str = "-") -> Column:
    return F.replace(words(text), F.lit(" "), F.lit(separator))


def plain_text(markup: Column) -> Column:
    """Tags dropped, references decoded, white space collapsed."""
    return F.trim(F.regexp_replace(decode_entities(F.regexp_replace(markup, "<[^>]*>", " ")), r"\s+", " "))


def title_case(text: Column) -> Column:
    return F.initcap(F.regexp_replace(text, "[-_]+", " "))


def truncate(text: Column, length: int) -> Column:
    cut = F.concat(F.rtrim(F.substring(text, 1, length - 1)), F.lit("…"))
    return F.when(F.length(text) > length, cut).otherwise(text)


def tokens(name: Column, shortest: int = 1) -> Column:
    """Distinct words of a normalised name that are no stop words, sorted."""
    stop = F.array(*map(F.lit, STOP_WORDS))
    kept = F.filter(F.split(words(name), " "), lambda w: (F.length(w) >= shortest) & ~F.array_contains(stop, w))
    return F.array_sort(F.array_distinct(kept))


def signature(name: Column) -> Column:
    return F.array_join(tokens(name), " ")


def dice(a: Column, b: Column) -> Column:
    """Twice the common tokens over all tokens; null if there are none."""
    total = F.size(a) + F.size(b)
    return F.when(total > 0, 2.0 * F.size(F.array_intersect(a, b)) / total)


def overlap(a: Column, b: Column) -> Column:
    """Common tokens over the larger set; null if both are empty."""
    larger = F.greatest(F.size(a), F.size(b))
    return F.when(larger > 0, F.size(F.array_intersect(a, b)) / larger)


def has_all_tokens(haystack: Column, query: str) -> Column:
    """Every blank-separated word of ``query`` stands somewhere in the folded haystack."""
    condition = F.lit(True)
    for word in query.lower().split():
        condition &= F.contains(haystack, F.lit(word))
    return condition
