"""A paged source: Spark's Python data source API over a user-supplied page function.

Pages are partitions, so they are fetched in parallel; a lost task fetches its page again.
The library itself opens no network connection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Page(InputPartition):
    def __init__(self, number: int) -> None:
        self.number = number


def register(spark: SparkSession, name: str, schema: str, pages: int, fetch: Callable[[int], Iterable[tuple]]) -> None:
    """Make ``spark.read.format(name)`` read pages 1 to ``pages`` of ``fetch(page)``."""

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [_Page(k) for k in range(1, pages + 1)]

        def read(self, partition: _Page) -> Iterator[tuple]:
            yield from fetch(partition.number)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    spark.dataSource.register(Source)


def register_cursor(spark: SparkSession, name: str, schema: str, fetch: Callable[[str], tuple[Iterable[tuple], str | None]]) -> None:
    """The same for cursors: ``fetch(cursor)`` gives rows and the next cursor, which only it knows,
    so one task follows them from "*" until there is none."""

    def follow(_page: int) -> Iterator[tuple]:
        cursor: str | None = "*"
        while cursor:
            rows, cursor = fetch(cursor)
            yield from rows

    register(spark, name, schema, 1, follow)
