"""Merges: left wins, checked keys and ids, first values, unions of lists, ranked arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merged(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``left`` with what only ``right`` knows: a value of the left side is never overwritten."""
    shared = [c for c in right.columns if c in left.columns and c not in keys]
    out = left.join(right.withColumnsRenamed({c: f"__{c}" for c in shared}), keys, "left")
    return out.withColumns({c: F.coalesce(c, f"__{c}") for c in shared}).drop(*[f"__{c}" for c in shared])


def unique_left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join whose right side must have one row a key; a key that repeats is an error.

    The check is part of the aggregate that the join needs anyway, so no extra pass is made.
    """
    rest = [c for c in right.columns if c not in keys]
    one = right.groupBy(*keys).agg(F.count("*").alias("__n"), F.min(F.struct(*rest)).alias("__row"))
    repeated = F.raise_error(F.concat(F.lit("repeated key "), F.to_json(F.struct(*keys))))
    checked = one.select(*keys, F.when(F.col("__n") == 1, F.col("__row")).otherwise(repeated).alias("__row"))
    return left.join(checked, keys, "left").select(*left.columns, "__row.*")


def consistent_left_join(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """``unique_left_join`` of rows that name the same thing twice: ids that differ are an error."""
    out = unique_left_join(left, right, keys)
    differ = F.col(left_id) != F.col(right_id)
    message = F.concat(F.lit("ids differ: "), F.col(left_id).cast("string"), F.lit(", "), F.col(right_id).cast("string"))
    return out.withColumn(left_id, F.when(differ, F.raise_error(message)).otherwise(F.col(left_id)))


def longest(text: Column) -> Column:
    """Aggregate: the longest string, the greatest of equally long ones."""
    return F.max_by(text, F.struct(F.length(text), text))


def first_present(value: Column, order: Column) -> Column:
    """Aggregate: the first value that is not null."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def united(values: Column, order: Column, most: int | None = None) -> Column:
    """Aggregate: distinct elements of array columns in the order in which they come first."""
    rows = F.array_sort(F.collect_list(F.struct(order.alias("at"), values.alias("held"))))
    flat = F.array_distinct(F.flatten(F.transform(F.filter(rows, lambda r: r["held"].isNotNull()), lambda r: r["held"])))
    return F.slice(flat, 1, most) if most else flat


def in_both(first: Column, second: Column, most: int) -> Column:
    """Aggregate: rows that both ranks place within ``most``."""
    return F.count_if((first <= most) & (second <= most))


def collected(keys: Column, *values: Column) -> Column:
    """Aggregate: an array of structs in ascending order of ``keys``."""
    return F.array_sort(F.collect_list(F.struct(keys.alias("key"), *values)))


def split_at(df: DataFrame, column: str, cut) -> tuple[DataFrame, DataFrame]:
    """What lies up to ``cut`` and from ``cut`` on; the cut itself belongs to both."""
    return df.where(F.col(column) <= cut), df.where(F.col(column) >= cut)


def quality_filter(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Rows that meet the conditions on the columns that the table has."""
    for column, condition in conditions.items():
        if column in df.columns:
            df = df.where(condition)
    return df
