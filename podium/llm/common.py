"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; one of our own only where it is unset and Spark is one local process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not folder:
        folder = getattr(shared_dir, "own", None)
        if folder is None:
            folder = shared_dir.own = "file://" + tempfile.mkdtemp(prefix="podium-")
    return folder.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which goes when the session ends."""
    path = f"{shared_dir(spark)}/podium-{uuid.uuid4().hex}/{name}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def materialise(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor takes nothing with it, because the rows
    are in the shared store under Spark's commit protocol.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast if a count proves it small, else unmarked.

    Beyond the bound Spark's shuffled joins take over, so the result is the same.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


#: A key with more rows than this, and than one row in as many, is hot: there are at most so many hot keys.
HOT_ROWS = 1000
#: Below so many rows no key is looked for: all of them together are little for one task.
HOT_TOTAL = 50_000


def looked_up(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``lookup``, which has one row a key; rows of keys that it lacks go.

    Rows of hot keys would meet in one task, so they meet a broadcast instead: at most
    ``HOT_ROWS`` keys can have more than one row in ``HOT_ROWS`` each.  The others shuffle.
    """
    total = rows.count()
    if total < HOT_TOTAL:
        return rows.join(lookup, key)
    hot = rows.groupBy(key).count().where(F.col("count") > max(HOT_ROWS, total / HOT_ROWS))
    names = [r[0] for r in hot.collect()]  # HOT_ROWS at most
    if not names:
        return rows.join(lookup, key)
    is_hot = F.col(key).isin(names)
    return rows.where(~is_hot).join(lookup.where(~is_hot), key).unionByName(rows.where(is_hot).join(F.broadcast(lookup.where(is_hot)), key))


#: Look-up tables of so many rows or fewer are broadcast.
BROADCAST_ROWS = 100_000


def met(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """``looked_up`` for tables that are mostly small: counted, they are broadcast whole."""
    small = bounded(lookup, BROADCAST_ROWS)
    return rows.join(small, key) if small is not lookup else looked_up(rows, lookup, key)


def in_order(df: DataFrame, by: list[str], sums: list[str], name: str) -> DataFrame:
    """``df`` with ``place``, the rows before each in the order of ``by``, and for each of ``sums`` its sum before, ``<sum>_before``.

    Two passes: ranges of the order are sorted and summed each, and written with their running
    sums; the ranges' totals, a row each, then shift them.  Rows that tie may stand in either order.
    """
    names = ["place", *(f"{c}_before" for c in sums)]
    schema = StructType([*df.schema.fields, *StructType.fromDDL(", ".join(f"{c} long" for c in ["__part", *names])).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, totals = TaskContext.get().partitionId(), np.zeros(len(names), np.int64)
        for batch in batches:
            values = [np.ones(batch.num_rows, np.int64), *(np.asarray(batch.column(batch.schema.get_field_index(c)), np.int64) for c in sums)]
            upto = np.cumsum(np.stack(values), axis=1) + totals[:, None]
            before = upto - np.stack(values)
            if batch.num_rows:
                totals = upto[:, -1]
            made = [pa.array(np.full(batch.num_rows, part, np.int64)), *(pa.array(row) for row in before)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "__part", *names])

    local = materialise(df.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, schema), name)
    totals = local.groupBy("__part").agg(F.count("*").alias("place"), *(F.sum(c).alias(f"{c}_before") for c in sums))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("__part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__{c}") for c in names))
    moved = local.join(F.broadcast(shifts), "__part")
    return moved.select(*df.columns, *((F.col(c) + F.col(f"__{c}")).alias(c) for c in names))


def ascii_lower(column):
    """Lower-case A-Z only, code point for code point."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def map_batches(fn: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """A ``mapInArrow`` function out of a function on one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


def hand_back() -> None:
    """Returns to the system what this worker holds but does not use: workers live on from stage to stage."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it has
        pass


def utf8(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """A string column as str; null counts as empty."""
    return [value or "" for value in batch.column(batch.schema.get_field_index(name)).to_pylist()]
