"""CSV files with line breaks inside quoted cells, read in as many tasks as they have byte ranges.

A line alone does not say whether it begins a record.  The parity of quotes does: it is counted by byte
range first, a row a range; running over the ranges it tells each range whether it begins inside a
cell.  Ranges then put their lines together by themselves, and only what is open at a range's bounds
is joined afterwards.  A doubled quote inside a cell leaves the parity as it is.

Defined results: quotes stand only around cells, as the format says; a record that never closes
lasts to its file's end; blank lines between records are no records; a trailing carriage return of a record
goes, those inside cells stay; empty files have no records; a header is the first record of each file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PIECE = "file string, block long, seq long, kind string, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (where the byte range begins) and line, in the order of the file within each range."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """file, block, seq and record: the text of each record; (file, block, seq) is their order."""
    lines = _lines(spark, path)
    quotes = F.length("line") - F.length(F.translate("line", quote, ""))
    parities = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    order = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = parities.select("file", "block", (F.coalesce(F.sum("odd").over(order), F.lit(0)) % 2 == 1).alias("inside"))
    told = lines.join(F.broadcast(inside), ["file", "block"])  # a row a byte range, of 128 MB by default

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, odd, seq = None, [], False, 0
        out: list[tuple] = []

        def close(kind: str) -> None:
            nonlocal held, seq
            text = "\n".join(held)
            if kind != "whole" or text.strip("\r"):
                out.append((*at, seq, kind, text))
                seq += 1
            held = []

        def ended() -> None:
            """A range ends: what is open goes on in the next one, or went on all along."""
            if held:
                close("middle" if first else "tail")

        first = False  # the lines held are the rest of an earlier range's record
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file", "block", "line", "inside")]
            for file, block, line, within in zip(*columns):
                if (file, block) != at:
                    if at is not None:
                        ended()
                    at, held, odd, seq, first = (file, block), [], within, 0, within
                held.append(line)
                odd ^= line.count(quote) % 2 == 1
                if not odd:
                    close("head" if first else "whole")
                    first = False
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], ["file", "block", "seq", "kind", "record"])
                out.clear()
        if at is not None:
            ended()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()))], ["file", "block", "seq", "kind", "record"])

    pieces = told.mapInArrow(run, PIECE)
    whole = pieces.where("kind = 'whole'").drop("kind")
    # an open record: its tail, whole ranges in the middle, the head that closes it; three pieces a range at most
    by_file = Window.partitionBy("file").orderBy("block", "seq")
    open_pieces = pieces.where("kind <> 'whole'").withColumn("nth", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(by_file))
    joined = open_pieces.groupBy("file", "nth").agg(
        F.min_by(F.struct("block", "seq"), F.struct("block", "seq")).alias("at"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "record"))), lambda s: s["record"]), "\n").alias("record"),
    ).select("file", "at.block", "at.seq", "record")
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))


def read(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """The cells of all records as strings, an empty cell null, as Spark's own reader has them."""
    rows = records(spark, path)
    if header:
        first = rows.groupBy("file").agg(F.min(F.struct("block", "seq")).alias("__first"))  # a row a file
        rows = rows.join(F.broadcast(first), "file").where(F.struct("block", "seq") != F.col("__first")).drop("__first")
    schema = StructType([StructField(c, StringType()) for c in columns])
    cells = F.from_csv("record", F.lit(schema.simpleString()[len("struct<") : -1].replace(":", " ")), {"multiLine": "true", "quote": '"', "escape": '"'})
    return rows.select(cells.alias("cells")).select("cells.*")
