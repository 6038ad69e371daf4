"""Running values in the order of very large keys, where no task may sort a whole key.

Two passes.  Rows are cut into ranges of (keys, order), each sorted by one task and written with the
range and the place in it.  A range's state (its count, last value, openings) is one row; the states
of earlier ranges of the same key are carried into the range whose beginning stands in the middle
of a key, of which there is one a range at most, so carries are broadcast.

Defined results: ``order`` should be total, else rows that tie may stand in either order; null
keys are keys; nulls of an order come first or last as its columns say; an empty table gives an
empty result; columns that begin with two underscores are the operators' own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.sources.landing import written

#: ``monotonically_increasing_id`` holds the row's place in so many low bits, the partition above them.
PLACE_BITS = 33


def placed(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``df`` written in ranges of keys and order, with ``__part`` (ranges ascend) and ``__at`` (the place in the range)."""
    by = [*keys, *order]
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__id", F.monotonically_increasing_id())
    number = F.col("__id")
    return written(ordered.withColumns({"__part": F.shiftright(number, PLACE_BITS), "__at": number.bitwiseAND((1 << PLACE_BITS) - 1)}).drop("__id"), "placed")


def _carried(rows: DataFrame, keys: list[str], state: Column, earlier: Callable[[Column], Column], name: str) -> DataFrame:
    """``rows`` with ``name``: what earlier ranges of the same key leave; null in a key's first range."""
    per = rows.groupBy(*keys, "__part").agg(state.alias("__state"))
    by_part = Window.partitionBy(*keys).orderBy("__part")
    told = per.withColumns({"__nth": F.row_number().over(by_part), "__left": earlier(F.col("__state")).over(by_part.rowsBetween(Window.unboundedPreceding, -1))})
    of = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0))
    carries = told.where("__nth > 1").select("__part", of.alias("__of"), "__left")  # one a range at most
    met = rows.join(F.broadcast(carries), "__part", "left")
    return met.withColumn(name, F.when(F.col("__of").eqNullSafe(of), F.col("__left"))).drop("__of", "__left")


def _within(keys: list[str]) -> Window:
    return Window.partitionBy(*keys, "__part").orderBy("__at")


def with_previous(df: DataFrame, keys: list[str], order: list, value: str, name: str) -> DataFrame:
    """``value`` of the row before in its key; null for the first."""
    rows = _carried(placed(df, keys, order), keys, F.max_by(F.struct(value), "__at"), lambda s: F.last(s), "__before")
    here = F.lag(F.struct(value)).over(_within(keys))
    return rows.withColumn(name, F.coalesce(here, F.col("__before"))[value]).drop("__before", "__part", "__at")


def with_segments(df: DataFrame, keys: list[str], order: list, opens: Column, name: str) -> DataFrame:
    """The running number of the segment that a row belongs to; 0 before the first opening row of its key."""
    opening = F.coalesce(opens, F.lit(False)).cast("long")
    rows = _carried(placed(df.withColumn("__opens", opening), keys, order), keys, F.sum("__opens"), lambda s: F.sum(s), "__before")
    here = F.sum("__opens").over(_within(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn(name, here + F.coalesce("__before", F.lit(0))).drop("__opens", "__before", "__part", "__at")


def with_last_known(df: DataFrame, keys: list[str], order: list, value: str, name: str) -> DataFrame:
    """The last ``value`` in its key that is not null, the row's own included."""
    held = F.max_by(value, F.when(F.col(value).isNotNull(), F.col("__at")))
    rows = _carried(placed(df, keys, order), keys, held, lambda s: F.last(s, ignorenulls=True), "__before")
    here = F.last(value, ignorenulls=True).over(_within(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn(name, F.coalesce(here, F.col("__before"))).drop("__before", "__part", "__at")


def with_numbers(df: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """Row numbers from 1 in each key."""
    return with_segments(df, keys, order, F.lit(True), name)


def falls_back(df: DataFrame, keys: list[str], order: list, value: str, name: str = "falls") -> DataFrame:
    """Whether a row's value is below that of the row before: a rank list must not have such rows."""
    told = with_previous(df, keys, order, value, "__value_before")
    return told.withColumn(name, F.coalesce(F.col(value) < F.col("__value_before"), F.lit(False))).drop("__value_before")


def in_intervals(df: DataFrame, intervals: DataFrame, low: list[str], high: list[str], at: list[str], label: str) -> DataFrame:
    """``df`` with ``label`` of the interval that holds each row's place ``at``, null where none does.

    ``intervals`` are disjoint and have the columns ``low``, ``high`` (both inclusive) and ``label``; ``at``, ``low`` and
    ``high`` name as many columns, compared in turn.  Starts and places are put in one order, and each place
    takes the last start before it: neither side is broadcast, and none meets the whole other.
    """
    marks = [f"__m{k}" for k in range(len(at))]
    first = intervals.select(*[F.col(c).alias(m) for c, m in zip(low, marks)], F.lit(0).alias("__kind"), F.struct(F.struct(*high).alias("end"), F.col(label).alias("label")).alias("__interval"), F.lit(None).cast(df.select(F.struct("*")).schema[0].dataType).alias("__row"))
    second = df.where(F.col(at[0]).isNotNull()).select(*[F.col(c).alias(m) for c, m in zip(at, marks)], F.lit(1).alias("__kind"), F.lit(None).cast(first.schema["__interval"].dataType).alias("__interval"), F.struct(*df.columns).alias("__row"))
    told = with_last_known(first.unionByName(second), [], [*marks, "__kind"], "__interval", "__held").where("__kind = 1")
    end, place = F.col("__held.end"), F.struct(*[F.col(m).alias(h) for m, h in zip(marks, high)])
    found = told.select("__row.*", F.when(place <= end, F.col("__held.label")).alias(label))
    return found.unionByName(df.where(F.col(at[0]).isNull()).withColumn(label, F.lit(None).cast(intervals.schema[label].dataType)))
