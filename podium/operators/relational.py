"""Relational building blocks with exact tie rules.

Where a rule depends on row order, the order is an explicit column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType


def first_wins(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def pick(df: DataFrame, keys: list[str], order: Column, values: list[str], last: bool = False) -> DataFrame:
    """``values`` of each key's first (or last) row; aggregates before it shuffles, so hot keys do no harm."""
    best = F.max_by if last else F.min_by
    chosen = df.groupBy(*keys).agg(best(F.struct(*values), order).alias("__row"))
    return chosen.select(*keys, "__row.*")


def mode_first_seen(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Each key's most frequent value; of equally frequent ones that seen first."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(order).alias("__first"))
    return counts.groupBy(*keys).agg(
        F.max_by(value, F.struct("n", -F.col("__first"))).alias("mode"), F.max("n").alias("n")
    )


def rank_min(value: Column, keys: list, descending: bool = True) -> Column:
    """Equal values share their lowest rank; null has none."""
    order = value.desc_nulls_last() if descending else value.asc_nulls_last()
    return F.when(value.isNotNull(), F.rank().over(Window.partitionBy(*keys).orderBy(order)))


def rank_average(value: Column, keys: list, descending: bool = False) -> Column:
    """Equal values share their average rank; null has none."""
    order = value.desc_nulls_last() if descending else value.asc_nulls_last()
    peers = F.count("*").over(Window.partitionBy(*keys, value))
    return F.when(value.isNotNull(), F.rank().over(Window.partitionBy(*keys).orderBy(order)) + (peers - 1) / 2)


def best_per_key(df: DataFrame, keys: list[str], rank: str, ordinal: str) -> DataFrame:
    """The row of least rank of each key; the first on a tie."""
    rest = [c for c in df.columns if c not in keys]
    return pick(df, keys, F.struct(rank, ordinal), rest)


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int, rank: str = "position") -> DataFrame:
    """The first ``k`` rows of each group; Spark keeps only ``k`` a group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def _exact(df: DataFrame, value: str) -> Column:
    """True where no two values are one double."""
    kind = df.schema[value].dataType
    if isinstance(kind, (LongType, DecimalType)):
        return F.abs(F.col(value).cast("double")) < 2.0**50 / 10 ** getattr(kind, "scale", 0)
    return F.lit(True)


def _cut(df: DataFrame, keys: list[str], value: str, descending: bool, ranges: int | None, deal_nulls: bool = True) -> DataFrame:
    """Adds ``__range``, the range of ``value`` in its key, the first ranges first, ``__start``, the rows before it, and ``__size``, its rows.

    Approximate quantiles cut each key's values (numeric) into as many ranges as Spark has
    shuffle partitions, so that no task sorts a whole key.  Keys are few (publishers, years,
    none): their cuts and sizes are a row a key or range, and are broadcast.  Equal values
    share a range, and those that equal a cut have an odd one for themselves.  Nulls come after all ranges, dealt out evenly or, where their order counts, in one.
    """
    ranges = ranges or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    number = F.col(value).cast("double")
    quantiles = F.array_distinct(F.percentile_approx(number, [k / ranges for k in range(1, ranges)], 1000))

    def met(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
        side = right.withColumnsRenamed({k: f"__of_{k}" for k in names})
        same = [left[k].eqNullSafe(side[f"__of_{k}"]) for k in names]
        return left.join(F.broadcast(side), reduce(lambda x, y: x & y, same)).drop(*[f"__of_{k}" for k in names])

    if keys:
        cut = met(df, df.groupBy(*keys).agg(quantiles.alias("__cuts")), keys)
    else:
        cut = df.withColumn("__cuts", df.agg(quantiles).scalar())
    passed = F.size(F.filter("__cuts", (lambda c: c > number) if descending else (lambda c: c < number)))
    last = F.lit(2 * ranges) + (F.pmod(F.xxhash64(*df.columns), F.lit(ranges)) if deal_nulls else F.lit(0))
    alone = F.array_contains("__cuts", number) & _exact(df, value)
    cut = cut.withColumn("__range", F.when(number.isNull(), last).otherwise(2 * passed + F.when(alone, 1).otherwise(0)).cast("int")).drop("__cuts")
    sizes = cut.groupBy(*keys, "__range").agg(F.count("*").alias("__size"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = sizes.select(*keys, "__range", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"), "__size")
    return met(cut, starts, [*keys, "__range"])


def range_ranked(df: DataFrame, keys: list[str], value: str, name: str = "rank", descending: bool = True, average: bool = False, ranges: int | None = None) -> DataFrame:
    """``df`` with the rank of ``value`` in its key: equal values share their lowest rank, or their average one; null has none.

    As ``rank_min`` and ``rank_average``, for keys too large to be sorted by one task.
    """
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    dealt = _dealt(_cut(df, keys, value, descending, ranges), keys, df.columns, ranges)
    alone = F.col("__deal") >= 0
    place = F.col("__start") + F.when(alone, 1).otherwise(F.rank().over(Window.partitionBy(*keys, "__range", "__deal").orderBy(order)))
    if average:
        peers = F.when(alone, F.col("__size")).otherwise(F.count("*").over(Window.partitionBy(*keys, "__range", "__deal", value)))
        place = place + (peers - 1) / 2
    return dealt.withColumn(name, F.when(F.col(value).isNotNull(), place)).drop("__range", "__start", "__size", "__deal")


def _dealt(cut: DataFrame, keys: list[str], columns: list[str], ranges: int | None) -> DataFrame:
    """Adds ``__deal``: rows of one value that has a range for itself need no order and are dealt out; the others have -1.

    Spark does not join these partitions to larger ones, as their number is given.
    """
    ranges = ranges or max(2, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    deal = F.pmod(F.xxhash64(*columns), F.lit(ranges)).cast("int")
    dealt = cut.withColumn("__deal", F.when((F.col("__range") < 2 * ranges) & (F.col("__range") % 2 == 1), deal).otherwise(-1))
    return dealt.repartition(ranges, *keys, "__range", "__deal")


def numbered(df: DataFrame, key: str, ties: list, name: str = "position", buckets: int | None = None) -> DataFrame:
    """A global row number by ``key`` descending, nulls last, without one task that sorts everything."""
    cut = _cut(df, [], key, True, buckets, deal_nulls=False)
    within = F.row_number().over(Window.partitionBy("__range").orderBy(F.col(key).desc_nulls_last(), *ties))
    return cut.withColumn(name, F.col("__start") + within).drop("__range", "__start", "__size")


def concentration(counts: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Herfindahl-Hirschman index of counts per key, and their total."""
    total = F.sum(n).cast("double")
    return counts.groupBy(*keys).agg(F.sum(n).alias("total"), (F.sum(F.col(n).cast("double") * F.col(n)) / (total * total)).alias("hhi"))


def zero_filled(df: DataFrame, rows: DataFrame, columns: DataFrame, values: list[str]) -> DataFrame:
    """A dense grid of two small dimensions: combinations without a row get zeros."""
    grid = rows.join(columns)  # two dimensions of fixed size
    keys = [*rows.columns, *columns.columns]
    return grid.join(df, keys, "left").select(*keys, *[F.coalesce(v, F.lit(0)).alias(v) for v in values])


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with average ranks; rows with a null in either column do not count."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = range_ranked(range_ranked(both.select(x, y), [], x, "rx", False, True), [], y, "ry", False, True)
    return ranked.agg(F.corr("rx", "ry").alias("spearman"), F.count("*").alias("n"))


def quantile_cuts(df: DataFrame, value: str, parts: int) -> DataFrame:
    """Nearest-rank cuts: of n sorted values those at round((n - 1) * i / parts), without repeats.

    The values are numbered in ranges, not gathered: only the cuts come together.
    """
    placed = numbered(df.where(F.col(value).isNotNull()).select((-F.col(value)).alias("__v")), "__v", [], "__p")
    n = placed.count()
    wanted = sorted({int((n - 1) * i / parts + 0.5) + 1 for i in range(1, parts)}) if n else []
    return placed.where(F.col("__p").isin(wanted)).select((-F.col("__v")).alias("cut")).distinct()


def rebased(df: DataFrame, keys: list[str], year: str, value: str) -> Column:
    """100 in each key's first year."""
    w = Window.partitionBy(*keys).orderBy(year).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.first(value).over(w)
    return F.when(first != 0, 100.0 * F.col(value) / first)


def margin_to_next(keys: list, score: str, ties: list) -> Column:
    """Lead of a row over the next best of its key; its whole score if there is none."""
    w = Window.partitionBy(*keys).orderBy(F.desc(score), *ties)
    return F.col(score) - F.coalesce(F.lead(score).over(w), F.lit(0))


def falls_back(value: str, keys: list, order: list) -> Column:
    """True where a value is below its predecessor's: a rank list must not have such rows."""
    return F.coalesce(F.col(value) < F.lag(value).over(Window.partitionBy(*keys).orderBy(*order)), F.lit(False))


def rank_gaps(df: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Ranks that break competition ranking: the first is 1, the next is this plus its holders."""
    counts = df.groupBy(*keys, rank).agg(F.count("*").alias("held"))
    w = Window.partitionBy(*keys).orderBy(rank)
    expected = F.coalesce(F.lag(F.col(rank) + F.col("held")).over(w), F.lit(1))
    return counts.withColumn("expected", expected).where(F.col(rank) != F.col("expected"))


def every_nth(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """Every n-th row of each key and its last."""
    w = Window.partitionBy(*keys)
    placed = df.withColumn("__n", F.row_number().over(w.orderBy(*order))).withColumn("__of", F.count("*").over(w))
    return placed.where(((F.col("__n") - 1) % n == 0) | (F.col("__n") == F.col("__of"))).drop("__n", "__of")


def segments(opens: Column, keys: list, order: list) -> Column:
    """The running number of the segment that a row belongs to; 0 before the first opening row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(F.when(opens, 1).otherwise(0)).over(w)


def page(df: DataFrame, order: list, size: int, number: int) -> DataFrame:
    """Page ``number`` (from 1) of sorted rows; past the end it is the last page."""
    total = df.count()
    last = max(1, -(-total // size))
    return df.orderBy(*order).offset((min(max(number, 1), last) - 1) * size).limit(size)


def cascade(candidates: DataFrame, keys: list[str], priority: str, ties: list[str]) -> DataFrame:
    """The candidate of best priority for each key."""
    return pick(candidates, keys, F.struct(priority, *ties), [c for c in candidates.columns if c not in keys])
