"""Token ids on disk: Simple-8b words of 64 bits, in blocks with offsets.

A word's top four bits select how many ids share its lower 60 bits.  Selectors 0 to
13 pack ``COUNTS[s]`` ids of ``WIDTHS[s]`` bits each, lowest bits first.  Selector 15
is an escape: the next word is one id in full.  Ids are coded in blocks of ``BLOCK``,
and a shard stores each block's first word, so blocks decode by themselves and many
at a time.

A shard (one binary value, rows in ascending doc_id order) is, little endian:
magic ``PS8B``, version, ids, documents, blocks, words (5 x uint64), then doc ids
(int64; flags for null doc ids, uint8), ids per document (uint64), first word of each block (uint64) and words.

Defined results: a null or empty text is its end id alone; rows of equal doc_id follow
in the order of their texts; a null doc_id comes first; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.llm.common import shared_path, table, texts
from podium.llm.tokens import encoder

MAGIC = b"PS8B"
END_ID = 2
BLOCK = 1024
#: Ids that a shard holds before the next one begins.
SHARD_IDS = 1 << 20
#: Fixed values of the format.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) of unsigned 64-bit ids.

    Every place gets the selector that packs most ids from there on; then all blocks
    walk from word to word side by side.  A block's last word may be partly empty: it
    holds what is left, which the block's length tells.
    """
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    blocks, most = -(-n // block), int(COUNTS[0])
    grid = np.zeros(blocks * block + most, np.uint64)
    grid[:n] = ids
    top = int(grid.max())
    small = grid[: blocks * block].reshape(blocks, block).astype(np.min_scalar_type(top))
    selector = np.full((blocks, block), ESCAPE, np.int8)
    fits = np.ones((blocks, block + most), bool)  # beyond a block's end anything does
    for s in range(len(COUNTS) - 1, -1, -1):  # from one id a word to sixty: the later, the better
        if not top >> int(WIDTHS[s]):
            selector[:] = s
            continue
        fits[:, :block] = small < (1 << int(WIDTHS[s]))
        row, held = fits, 1
        while held < COUNTS[s]:  # whether so many in a row do
            step = min(held, int(COUNTS[s]) - held)
            row, held = row[:, :-step] & row[:, step:], held + step
        np.putmask(selector, row[:, :block], s)
    selector = selector.ravel()
    taken = np.append(COUNTS, [0, 1])[selector]  # a block's last word holds fewer
    walk, heads = np.arange(blocks) * block, []
    limit = np.minimum(walk + block, n)
    active = np.arange(blocks)
    while len(active):
        heads.append(walk[active])
        walk[active] += taken[walk[active]]
        active = active[walk[active] < limit[active]]
    head = np.sort(np.concatenate(heads))
    chosen = selector[head].astype(np.int64)
    left = np.minimum(taken[head], limit[head // block] - head)
    size = np.where(chosen == ESCAPE, 2, 1)
    at = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    words[at] = chosen.astype(np.uint64) << np.uint64(60)
    escaped = chosen == ESCAPE
    words[at[escaped] + 1] = grid[head[escaped]]
    for s in range(len(COUNTS)):
        mine = np.flatnonzero(chosen == s)
        if not len(mine):
            continue
        begin, packed, ends = head[mine], np.zeros(len(mine), np.uint64), left[mine]
        whole = ends.min() == COUNTS[s]
        for j in range(int(COUNTS[s])):
            ids_j = grid[begin + j]
            packed |= (ids_j if whole else np.where(j < ends, ids_j, np.uint64(0))) << np.uint64(j * int(WIDTHS[s]))
        words[at[mine]] |= packed
    first = at[np.searchsorted(head, np.arange(blocks) * block)]
    return words, first.astype(np.uint64)


def decode_blocks(words: np.ndarray, first: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """All ids: blocks step from word to word side by side, then each selector's words decode at once."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    blocks = len(first)
    word, place = first.astype(np.int64), np.arange(blocks) * block
    limit = np.minimum(place + block, n)
    select = (words >> np.uint64(60)).astype(np.int64)
    steps, active = [], np.arange(blocks)
    while len(active):
        w, p = word[active], place[active]
        steps.append((w.copy(), p.copy(), limit[active]))
        s = select[w]
        word[active] += np.where(s == ESCAPE, 2, 1)
        place[active] += np.where(s == ESCAPE, 1, COUNTS[np.minimum(s, 13)])
        active = active[place[active] < limit[active]]
    w, p, end = (np.concatenate(x) for x in zip(*steps))
    s = select[w]
    escaped = s == ESCAPE
    out[p[escaped]] = words[w[escaped] + 1]
    for k in range(len(COUNTS)):
        mine = np.flatnonzero(s == k)
        if not len(mine):
            continue
        mask, room = np.uint64((1 << int(WIDTHS[k])) - 1), end[mine] - p[mine]
        for these, whole in (mine[room >= COUNTS[k]], True), (mine[room < COUNTS[k]], False):
            held, begin, some = words[w[these]], p[these], end[these] - p[these]
            for j in range(int(COUNTS[k]) if whole else int(some.max(initial=0))):
                part = (held >> np.uint64(j * int(WIDTHS[k]))) & mask
                if whole:
                    out[begin + j] = part
                else:  # a block's last word
                    out[begin[some > j] + j] = part[some > j]
    return out


def write_shard(doc_ids: list[int | None], docs: list[bytes]) -> bytes:
    ids = np.frombuffer(b"".join(docs), "<u4").astype(np.uint64)
    words, first = encode_blocks(ids)
    head = np.array([1, len(ids), len(docs), len(first), len(words)], "<u8")
    named = np.array([x or 0 for x in doc_ids], "<i8")
    nulls = np.array([x is None for x in doc_ids], np.uint8)
    sizes = np.array([len(d) // 4 for d in docs], "<u8")
    return b"".join([MAGIC, head.tobytes(), named.tobytes(), nulls.tobytes(), sizes.tobytes(), first.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def read_shard(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc ids, ids per document, all ids."""
    if data[:4] != MAGIC:
        raise ValueError("not a shard")
    version, n, docs, blocks, words = np.frombuffer(data, "<u8", 5, 4).tolist()
    if version != 1:
        raise ValueError(f"shard version {version}")
    at = 44
    named = np.frombuffer(data, "<i8", docs, at).tolist()
    nulls = np.frombuffer(data, np.uint8, docs, at + 8 * docs)
    at += 9 * docs
    sizes = np.frombuffer(data, "<u8", docs, at).astype(np.int64)
    first = np.frombuffer(data, "<u8", blocks, at + 8 * docs)
    packed = np.frombuffer(data, "<u8", words, at + 8 * docs + 8 * blocks)
    return [None if z else x for x, z in zip(named, nulls)], sizes, decode_blocks(packed, first, n)


#: Characters of a text that cut ranges of rows with one doc_id.
RANGE_CHARS = 64


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Shards in ascending doc_id order under ``path``.

    The container is a Parquet table with a shard a row (part, seq, n_ids, shard): so Spark's
    commit protocol covers lost executors, and any store that Spark can write to will do.
    Range partitions hold ascending doc ids; a partition is written shard by shard.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = encoder(tokenizer_path, False), TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            columns = [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([size], pa.int64()), pa.array([write_shard(names, held)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "seq", "n_ids", "shard"])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                for name, ids in zip(rows.column(0).to_pylist(), encode(texts(rows, "text"))):
                    names.append(name)
                    held.append(ids + end)
                    size += len(ids) // 4 + 1
                    if size >= SHARD_IDS:
                        yield flush()
                        seq, names, held, size = seq + 1, [], [], 0
        if held:
            yield flush()

    # rows that share a doc_id, or have none, may fill many ranges; how a text begins keeps the order of whole texts
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id", F.left("text", F.lit(RANGE_CHARS))).sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(run, "part int, seq long, n_ids long, shard binary")
    shards.write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the shards: doc_id, start, n_tokens, ids_crc32."""
    shards = spark.read.schema("part int, seq long, n_ids long, shard binary").parquet(path)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("part_at"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("seq_at"))
    places = sizes.join(F.broadcast(parts), "part").select("part", "seq", (F.col("part_at") + F.col("seq_at")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
                names, sizes, ids = read_shard(data)
                flat = ids.astype("<u4").tobytes()
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(flat[4 * (e - n) : 4 * e]) for n, e in zip(sizes.tolist(), ends.tolist())]
                columns = [pa.array([part] * len(names), pa.int32()), pa.array([seq] * len(names), pa.int64()), pa.array(names, pa.int64()), pa.array(ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "seq", "doc_id", "inner", "n_tokens", "ids_crc32"])

    decoded = shards.select("part", "seq", "shard").mapInArrow(
        run, "part int, seq long, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return decoded.join(places, ["part", "seq"]).select("doc_id", (F.col("at") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def op9_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token_ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_ids(spark, path)
