"""A decorator that registers a query and its SQL in a module's tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def registry(queries: dict, oracles: dict[str, str]):
    def query(sql: str | None = None):
        def register(function):
            @functools.wraps(function)
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                """Exact sums are decimals inside a query and doubles in its result."""
                df = function(spark, sf_dir)
                return df.withColumns({c: F.col(c).cast("double") for c, kind in df.dtypes if kind.startswith("decimal")})

            queries[function.__name__] = run
            if sql:
                oracles[function.__name__] = sql
            return run

        return register

    return query
