"""Streaming forms: landing-folder upserts and event-time windows.

An extension: batch queries give the same results over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from podium.sources.sinks import write_scopes


def landing_upsert(spark: SparkSession, schema: str, landing: str, store: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of landed CSV rows replaces the scopes it holds."""
    rows = spark.readStream.schema(schema).options(header=True, escape='"').csv(landing)

    def upsert(batch: DataFrame, _epoch: int) -> None:
        if not batch.isEmpty():
            write_scopes(batch, store)

    return rows.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _watermarked(events: DataFrame, time: str, late: str) -> DataFrame:
    """Streams need a time with a zone and a watermark; batches are left as they are."""
    if not events.isStreaming:
        return events
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Tumbling or sliding event-time counts and sums; later rows than ``late`` drop out of a stream."""
    events = _watermarked(events, time, late)
    window = F.window(time, width, slide) if slide else F.window(time, width)
    out = events.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
    return out.select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Sessions of a key with no gap longer than ``gap``."""
    events = _watermarked(events, time, late)
    out = events.groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def running_best(rows: DataFrame, key: str = "entity", score: str = "score") -> DataFrame:
    """Custom state: a row a key and micro-batch with the best score so far and the rows seen."""

    def step(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best, seen = state.get if state.exists else (float("-inf"), 0)
        for pdf in frames:
            best, seen = max(best, float(pdf[score].max())), seen + len(pdf)
        state.update((best, seen))
        yield pd.DataFrame({key: [keys[0]], "best": [best], "seen": [seen]})

    kind = dict(rows.dtypes)[key]
    return rows.groupBy(key).applyInPandasWithState(
        step, f"{key} {kind}, best double, seen long", "best double, seen long", "update", GroupStateTimeout.NoTimeout
    )
