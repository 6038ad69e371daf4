"""Sinks: scope upserts, failure logs, manifests, CSV and JSON, incremental stores, encoded details."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.operators.relational import numbered


def upserted(existing: DataFrame, batch: DataFrame, scope_order: DataFrame | None = None, order: str = "__ord") -> DataFrame:
    """Rows of scopes that the batch does not refresh, then the batch; scopes in their configured order,
    unknown ones last.  ``__place`` numbers the rows of a scope."""
    kept = existing.join(batch.select("ranking_scope").distinct(), "ranking_scope", "left_anti")
    rows = kept.withColumn("__new", F.lit(0)).unionByName(batch.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    if scope_order is not None:
        rows = rows.join(scope_order.select("ranking_scope", F.col("position").alias("__scope")), "ranking_scope", "left")
    else:
        rows = rows.withColumn("__scope", F.lit(None).cast("int"))
    w = Window.partitionBy("ranking_scope").orderBy("__new", order)
    rows = rows.withColumn("__place", F.row_number().over(w)).withColumn("__scope", F.coalesce("__scope", F.lit(2**31 - 1)))
    return rows.drop("__new")


def write_scopes(batch: DataFrame, path: str) -> None:
    """Overwrite only the scopes that the batch holds (dynamic partition overwrite)."""
    batch.write.option("partitionOverwriteMode", "dynamic").partitionBy("ranking_scope").mode("overwrite").parquet(path)


def merged_failures(log: DataFrame, attempted: DataFrame, failures: DataFrame) -> DataFrame:
    """Old failures of scopes that were not tried again, and the new ones."""
    return log.join(attempted.select("ranking_scope").distinct(), "ranking_scope", "left_anti").unionByName(failures)


def manifest(rows: DataFrame, keys: list[str], licences: DataFrame | None = None) -> DataFrame:
    """records and records_by_scope of each snapshot, with the licence of its source where ``licences`` (source, ...) are given."""
    counts = rows.groupBy(*keys, "ranking_scope").count()
    by_scope = F.map_from_entries(F.array_sort(F.collect_list(F.struct("ranking_scope", "count"))))
    out = counts.groupBy(*keys).agg(F.sum("count").alias("records"), by_scope.alias("records_by_scope"))
    return out if licences is None else out.join(F.broadcast(licences), "source", "left")


def spaced_json(cell: Column) -> Column:
    """The JSON of a nested cell with a blank after commas and colons, as other tools of such archives write it."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: json.dumps(json.loads(t), ensure_ascii=False), na_action="ignore")

    return F.pandas_udf(run, "string")(F.to_json(cell, {"ignoreNullFields": "false"}))


def cells(df: DataFrame) -> DataFrame:
    """All columns as CSV cells: nested ones as JSON, booleans as True and False."""
    out = []
    for name, kind in df.dtypes:
        value = F.col(f"`{name}`")
        if kind.startswith(("array", "map", "struct")):
            value = spaced_json(value)
        elif kind == "boolean":
            value = F.when(value, "True").when(~value, "False")
        out.append(value.alias(name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    """Nested cells as JSON, booleans as True and False, quotes doubled."""
    cells(df).write.mode("overwrite").options(header=True, escape='"', sep=separator).csv(path)


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_snapshots(df: DataFrame, folder: str, stem: str, kind: str = "csv", ending: str = ".csv") -> int:
    """One file a value of column ``stem``, ``<folder>/<value><ending>``; returns how many.

    A snapshot is one publisher's table of one year, so it fits one task; all are written by one
    job under Spark's commit protocol and then moved to their names, one rename each.
    """
    spark = df.sparkSession
    written = f"{folder}/_written-{uuid.uuid4().hex}"
    rows = df if kind == "json" else cells(df)
    writer = rows.repartition(stem).write.partitionBy(stem)
    (writer.options(header=True, escape='"').csv if kind == "csv" else writer.json)(written)
    fs, root = _files(spark, written)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = 0
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{stem}="):
            for part in fs.listStatus(status.getPath()):
                if part.getPath().getName().startswith("part-"):
                    fs.rename(part.getPath(), hadoop(f"{folder}/{name.split('=', 1)[1]}{ending}"))
                    names += 1
    fs.delete(root, True)
    return names


def write_json(df: DataFrame, path: str, most_rows: int = 100_000) -> None:
    """One JSON file, written beside its place and moved there; for results of a bounded size only."""
    rows = [row.asDict(recursive=True) for row in df.limit(most_rows + 1).collect()]
    if len(rows) > most_rows:
        raise ValueError(f"more than {most_rows} rows; write them with Spark")
    handle, name = tempfile.mkstemp(dir=os.path.dirname(path) or ".")
    with os.fdopen(handle, "w") as file:
        json.dump(rows, file, default=str)
    os.replace(name, path)


def pending(seeds: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Seeds without a result yet."""
    return seeds.join(done.select(key).distinct(), key, "left_anti")


def append_results(results: DataFrame, path: str) -> None:
    """A further batch of results beside the earlier ones; what was written before a failure stays."""
    results.write.mode("append").parquet(path)


def latest_results(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    """The newest result of each key among all batches."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r")).select(key, "r.*")


def write_details(df: DataFrame, path: str) -> DataFrame:
    """A folder per provider and subject, stale ones gone; returns the index with counts."""
    df.write.partitionBy("provider", "subject").mode("overwrite").parquet(path)
    return df.groupBy("provider", "subject").count()


def dictionary(df: DataFrame, value: str, order: str) -> DataFrame:
    """(value, code): codes from 0 in order of first appearance; ``order`` is numeric.  The values are numbered in ranges."""
    firsts = df.where(F.col(value).isNotNull()).groupBy(value).agg((-F.min(order)).alias("__first"))
    return numbered(firsts, "__first", [value], "code").select(value, (F.col("code") - 1).cast("int").alias("code"))


def encoded(df: DataFrame, value: str, codes: DataFrame) -> DataFrame:
    return df.join(codes.withColumnRenamed("code", f"{value}_code"), value, "left").drop(value)


def decoded(df: DataFrame, value: str, codes: DataFrame) -> DataFrame:
    """The inverse of ``encoded``; a code without an entry is an error.  A table that holds plain values (of an older
    version) stays as it is."""
    if f"{value}_code" not in df.columns and value in df.columns:
        return df
    out = df.join(codes.withColumnRenamed("code", f"{value}_code"), f"{value}_code", "left")
    bad = F.col(f"{value}_code").isNotNull() & F.col(value).isNull()
    return out.withColumn(value, F.when(bad, F.raise_error(F.lit(f"unknown {value} code")).cast("string")).otherwise(F.col(value))).drop(f"{value}_code")
