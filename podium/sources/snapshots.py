"""Snapshots of ranking tables: catalogue, editions, canonical rows.

A snapshot is a CSV file with a JSON manifest beside it (``x.csv``, ``x.manifest.json``).
The catalogue is a DataFrame with a row a snapshot; editions are chosen on it, and only
the chosen files are read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.functions.numbers import missing

MANIFEST = """source string, country string, coverage string, ranking_year int, retrieval_method string,
data_license string, data_attribution string, retrieved_at string, records bigint,
records_by_scope map<string,bigint>, failures array<struct<source:string,ranking_scope:string,error:string>>"""
LEADING = ("source", "retrieved_at", "ranking_scope", "ranking_year")
CSV = {"header": True, "multiLine": True, "escape": '"', "encoding": "UTF-8"}


def read_table(spark: SparkSession, paths: str | list[str], separator: str = ",", multi_line: bool = True) -> DataFrame:
    """All cells as strings (blank is null), with ``__path`` and ``__ord``, the row's place in its file.

    Without line breaks inside cells, pass ``multi_line=False``: Spark then splits large files.
    """
    df = spark.read.options(**(CSV | {"multiLine": multi_line}), sep=separator).csv(paths)
    return df.withColumn("__path", F.col("_metadata.file_path")).withColumn("__ord", F.monotonically_increasing_id())


def read_records(spark: SparkSession, path: str, schema: str, field: str | None = None) -> DataFrame:
    """JSON documents, or the objects of a list field of theirs."""
    df = spark.read.schema(schema).json(path, multiLine=True)
    if field is None:
        return df
    return df.select(F.explode(F.filter(field, lambda x: x.isNotNull())).alias("x")).select("x.*")


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """A row a snapshot whose CSV is there: path, file_name, edition, is_global and the manifest's fields.

    The edition is the manifest's year, else the one in the file's name; having neither is an error.
    """
    manifests = (
        spark.read.schema(MANIFEST).option("recursiveFileLookup", True).option("pathGlobFilter", "*.manifest.json")
        .json(folder, multiLine=True).withColumn("stem", F.regexp_replace(F.col("_metadata.file_path"), r"\.manifest\.json$", ""))
    )
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
        .load(folder).select(F.regexp_replace("path", r"\.csv$", "").alias("stem"))
    )
    bare = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    found = manifests.withColumn("__s", bare("stem")).join(files.select(bare("stem").alias("__s")), "__s", "left_semi").drop("__s")
    name = F.element_at(F.split("stem", "/"), -1)
    in_name = F.regexp_extract(name, r"_rankings_(\d{4})", 1)
    edition = F.coalesce("ranking_year", F.when(in_name != "", in_name.cast("int")))
    return found.select(
        F.concat("stem", F.lit(".csv")).alias("path"), F.concat(name, F.lit(".csv")).alias("file_name"),
        F.coalesce(edition, F.raise_error(F.concat(F.lit("no edition: "), name)).cast("int")).alias("edition"),
        F.contains(name, F.lit("_worldwide_")).alias("is_global"), *[c for c in manifests.columns if c != "stem"],
    )


def latest(snapshots: DataFrame, keys: Iterable[str] = ("source",)) -> DataFrame:
    """The snapshot of the greatest (edition, file name) of each key."""
    rest = [c for c in snapshots.columns if c not in set(keys)]
    row = F.max_by(F.struct(*rest), F.struct("edition", "file_name")).alias("row")
    return snapshots.groupBy(*keys).agg(row).select(*keys, "row.*")


def latest_named(snapshots: DataFrame, pattern: str) -> DataFrame:
    """The snapshot of the greatest year in its file name, of those whose name fits; the year is group 1."""
    year = F.regexp_extract("file_name", pattern, 1)
    fits = snapshots.where(F.col("file_name").rlike(pattern)).withColumn("edition", year.try_cast("int"))
    return fits.orderBy(F.desc("edition"), F.desc("file_name")).limit(1)


def latest_with_rows(boards: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the newest edition of each key that has any: an edition without rows falls back to an older one."""
    newest = boards.groupBy(*keys).agg(F.max(F.struct("edition", "file_name")).alias("__newest"))
    joined = boards.join(newest, keys)
    return joined.where(F.struct("edition", "file_name") == F.col("__newest")).drop("__newest")


def first_path(snapshots: DataFrame) -> DataFrame:
    """One snapshot a source and edition: the first path."""
    w = Window.partitionBy("source", "edition").orderBy("path")
    return snapshots.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def first_present(df: DataFrame, columns: Iterable[str]) -> Column:
    """The first non-missing cell among those of ``columns`` that the table has."""
    there = [F.when(~missing(F.col(c)), F.trim(c)) for c in columns if c in df.columns]
    return F.coalesce(*there) if there else F.lit(None).cast("string")


def stamped(df: DataFrame, source: str, scope: str, year: int | None, retrieved_at: str, drop: Iterable[str] = ()) -> DataFrame:
    """Leading columns first, constants stamped, unwanted columns gone."""
    out = df.drop(*drop).withColumns(
        {"source": F.lit(source), "retrieved_at": F.lit(retrieved_at), "ranking_scope": F.lit(scope), "ranking_year": F.lit(year).cast("int")}
    )
    return out.select(*LEADING, *[c for c in out.columns if c not in LEADING])


def backfilled(df: DataFrame, target: str, source: str) -> DataFrame:
    return df.withColumn(target, F.when(missing(F.col(target)), F.col(source)).otherwise(F.col(target)))


def canonical(df: DataFrame, rank: list[str], name: list[str], country: list[str]) -> DataFrame:
    """Provider columns mapped to rank_display, name, country_raw; other columns stay."""
    return df.withColumns({"rank_display": first_present(df, rank), "name": first_present(df, name), "country_raw": first_present(df, country)})


def union_all(tables: list[DataFrame]) -> DataFrame:
    """By name; columns that a table lacks are null in it."""
    out = tables[0]
    for df in tables[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def labelled(values: Column, label: str) -> Column:
    """The value of the first struct with this label in array<struct<value, label>>."""
    return F.get(F.transform(F.filter(values, lambda x: x["label"] == label), lambda x: x["value"]), F.lit(0))


def of_year(values: Column, year: int) -> Column:
    """The struct of a year in an array of yearly structs."""
    return F.get(F.filter(values, lambda x: x["year"] == year), F.lit(0))


def indicators(df: DataFrame, payload: str, names: dict[str, str]) -> DataFrame:
    """A JSON object of coded indicators as columns by their names."""
    held = F.from_json(payload, "map<string,string>")
    return df.withColumns({name: F.try_element_at(held, F.lit(code)) for code, name in names.items()})


def open_scopes(scopes: DataFrame, launches: DataFrame, year: int) -> DataFrame:
    """Scopes that exist in ``year``: those launched later drop out, unknown ones stay."""
    return scopes.join(launches, "ranking_scope", "left").where(F.coalesce("first_year", F.lit(year)) <= year).select(*scopes.columns)


def subject_rows(df: DataFrame) -> DataFrame:
    """Rows of subjects: neither overall, nor blank, nor an academic-only scope."""
    scope = F.coalesce(F.trim("ranking_scope"), F.lit(""))
    return df.where(~scope.isin("overall", "") & ~F.startswith(scope, F.lit("academic-")))


def seeds(df: DataFrame, id_column: str, countries: list[str] | None = None) -> DataFrame:
    """Overall rows with an id, which must be unique, by rank and name."""
    kept = df.where((F.col("ranking_scope") == "overall") & F.col(id_column).isNotNull())
    if countries:
        kept = kept.where(F.col("country_code").isin(countries))
    repeated = kept.groupBy(id_column).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"repeated {id_column}: {repeated[0][0]}")
    return kept.orderBy("rank", "name")


def seed_union(first: DataFrame, directory: DataFrame, provider: str) -> DataFrame:
    """``first`` (name, country_code, rank) and the directory's entities that ``provider`` does not rank.

    ``directory`` has name, country_code, consensus_rank and ranks, a map of provider to rank.
    """
    lacking = directory.where(F.try_element_at("ranks", F.lit(provider)).isNull())
    rank = F.coalesce(F.col("consensus_rank").cast("long"), F.array_min(F.map_values("ranks")).cast("long"))
    return first.select("name", "country_code", F.col("rank").cast("long").alias("rank")).unionByName(lacking.select("name", "country_code", rank.alias("rank")))


def registry_records(df: DataFrame) -> DataFrame:
    """Registry items (id, status, names, links, domains, locations) flattened: one website, one label, codes.

    The website is the first https link, else the first link, else the first domain; the
    label is the display name, else the first name.
    """
    urls = F.transform(F.filter("links", lambda x: x["type"] == "website"), lambda x: x["value"])
    secure = F.filter(urls, lambda u: F.startswith(u, F.lit("https://")))
    domains = F.transform("domains", lambda d: F.concat(F.lit("https://"), d))
    shown = F.filter("names", lambda n: F.array_contains(n["types"], "ror_display"))
    return df.select(
        "id", "status",
        F.coalesce(F.get(shown, F.lit(0))["value"], F.get("names", F.lit(0))["value"]).alias("label"),
        F.coalesce(F.get(secure, F.lit(0)), F.get(urls, F.lit(0)), F.get(domains, F.lit(0))).alias("website"),
        F.array_distinct(F.transform("locations", lambda x: x["geonames_details"]["country_code"])).alias("country_codes"),
        F.array_distinct(F.transform("names", lambda n: n["value"])).alias("aliases"),
    )
