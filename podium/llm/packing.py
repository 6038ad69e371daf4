"""Concatenate-and-cut packing of documents into fixed windows.

Pass one encodes every document once and writes its ids with the place it has in its
partition.  Partition totals, one row each, give the partitions' global offsets; pass
two adds them up and cuts every document at the multiples of the window, natively.

Defined results: a null or empty text is its end id alone; repeated rows are packed
each; a null doc_id stays null; an empty table gives an empty result; other columns
are ignored.  Documents follow in the order in which their partitions were written.
"""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.llm.common import hand_back, materialise, table, texts
from podium.llm.tokens import encoder

WINDOW = 2048
END_ID = 1


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int, keep_blank: bool = True) -> DataFrame:
    """doc_id, part, before (ids before it in its partition), doc_tokens, ids (uint32, little endian)."""
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()
        encode, part, total = encoder(tokenizer_path, keep_blank), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                ids = [x + end for x in encode(texts(rows, "text"))]
                lengths = [len(x) // 4 for x in ids]
                before = []
                for n in lengths:
                    before.append(total)
                    total += n
                columns = [rows.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(before, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "before", "doc_tokens", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, part int, before long, doc_tokens long, ids binary"
    )


def with_offsets(rows: DataFrame) -> DataFrame:
    """Adds ``at``, the ids before each document; the offsets are one row a partition, so they are broadcast."""
    totals = rows.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("part_at"))
    return rows.join(F.broadcast(offsets), "part").withColumn("at", F.col("part_at") + F.col("before"))


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    All sequences but the last are full; the last one is padded by whoever writes it.
    """
    placed = with_offsets(materialise(encoded(docs, tokenizer_path, end_id), "ids"))
    end = F.col("at") + F.col("doc_tokens")
    cut = placed.select(
        "doc_id", "doc_tokens", "ids", "at",
        F.explode(F.sequence(F.expr(f"at div {window}"), F.expr(f"(at + doc_tokens - 1) div {window}"))).alias("sequence_id"),
    )
    begin = F.greatest(F.col("at"), F.col("sequence_id") * window)
    stop = F.least(end, (F.col("sequence_id") + 1) * window)
    cut = cut.withColumn("start", begin - F.col("at")).withColumn("length", stop - begin)
    return cut.select(
        "doc_id", "start", "length",
        F.expr("substring(ids, cast(start * 4 + 1 as int), cast(length * 4 as int))").alias("ids"),
        "doc_tokens", "sequence_id", (begin - F.col("sequence_id") * window).alias("offset"),
    )


def packed_digests(docs: DataFrame) -> DataFrame:
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digests(table(spark, sf_dir, "documents"))
