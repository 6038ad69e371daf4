"""Where a session lands intermediate tables, and memoised sources."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []
_memo: dict[tuple, DataFrame | str] = {}


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which goes when the session ends.

    Where that is unset, a folder of our own will do for Spark in one local process only.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="podium-"))
        base = _own[0]
    path = f"{base.rstrip('/')}/podium-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return f"{path}/{name}"


def memoised(spark: SparkSession, key: tuple, make: Callable[[], str]) -> str:
    """The path that ``make`` wrote, written once a session and key."""
    full = (spark.sparkContext.applicationId, *key)
    if full not in _memo:
        _memo[full] = make()
    return _memo[full]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once and read again: for what several branches of a query need."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
