"""SimHash near-duplicates by a self-join of the fingerprints' binary trie.

A document's fingerprint has a bit set when more than half of its shingle hashes
have it.  Fingerprints with at most ``max_bits`` differing bits are linked, and
linked documents form a component named after its smallest doc_id.

The trie is the sorted list of distinct fingerprints: a node is a range of it.  The
join walks pairs of nodes from the top, adds up the bits in which their paths
differ, and drops a pair as soon as the sum exceeds the budget.  The first
``prefix_bits`` levels are walked in Spark: each fingerprint goes to the pairs of
subtries that its own subtrie can still be linked with, and each pair of subtries is
one bounded group.  The number of levels grows with the number of fingerprints.

Defined results: a null or wordless text has fingerprint zero and links like any
other; repeated rows and ties share fingerprint and component; a null doc_id takes
part in linking but never names a component (a component of null ids has a null id);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import looked_up, map_batches, materialise, table, utf8

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Fingerprints that one subtrie holds on average, and levels that are walked in Spark at least.
SUBTRIE_ROWS = 4096
LEAST_LEVELS, MOST_LEVELS = 6, 24
#: Node pairs with at most this many leaf pairs are compared directly.
PAGE = 64


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """Of UTF-8 bytes, unsigned, one a place; a shorter text is one shingle, a wordless text has none."""
    words = text.lower().split()  # bytes: only A-Z, only \x20 and \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: len(words) - shingle].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())]
    return np.array(hashes, np.uint64)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Of UTF-8 bytes, unsigned."""
    return majority(shingle_hashes(text, shingle))


def majority(values: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(values), 65536):
        part = values[at : at + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(values), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(text, shingle) for text in utf8(batch, "text")], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(map_batches(run), "doc_id long, fp long")


def _pairs_within(x: np.ndarray, y: np.ndarray, same: bool, bits: int, budget: int, groups: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two sorted subtries that differ in at most ``budget`` of the lower ``bits`` bits.

    ``groups``: of the members of both; pairs within one group are not wanted, and nodes that
    hold one group only are not compared with their like.
    """
    one = np.ones(1, np.int64)
    frontier = [one * 0, one * len(x), one * 0, one * len(y), one * budget]
    found_x, found_y = [], []
    if groups is not None:
        gx, gy = groups
        changes_x, changes_y = (np.concatenate(([0], np.cumsum(g[1:] != g[:-1]))) for g in groups)

    def compare(node: list[np.ndarray]) -> None:
        xl, xh, yl, yh, left = node
        size = (xh - xl) * (yh - yl)
        at = np.repeat(np.arange(len(size)), size)
        k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        width = (yh - yl)[at]
        i, j = xl[at] + k // width, yl[at] + k % width
        near = np.bitwise_count((x[i] ^ y[j]) & np.uint64((1 << bits) - 1)) <= budget
        if same:
            near &= i < j
        if groups is not None:
            near &= gx[i] != gy[j]
        found_x.append(i[near])
        found_y.append(j[near])

    for bit in range(bits - 1, -2, -1):
        xl, xh, yl, yh, left = frontier
        if groups is not None:
            alike = (changes_x[xh - 1] == changes_x[xl]) & (changes_y[yh - 1] == changes_y[yl]) & (gx[xl] == gy[yl])
            xl, xh, yl, yh, left = frontier = [column[~alike] for column in frontier]
        small = ((xh - xl) * (yh - yl) <= PAGE) | (bit < 0)
        if small.any():
            for part in np.array_split(np.flatnonzero(small), max(1, int(small.sum()) // 20000)):
                compare([column[part] for column in frontier])
            xl, xh, yl, yh, left = frontier = [column[~small] for column in frontier]
        if not len(xl):
            break
        ones_x = np.concatenate(([0], np.cumsum((x >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        ones_y = ones_x if same else np.concatenate(([0], np.cumsum((y >> np.uint64(bit)) & np.uint64(1)))).astype(np.int64)
        xm, ym = xh - (ones_x[xh] - ones_x[xl]), yh - (ones_y[yh] - ones_y[yl])
        twin = (xl == yl) & same
        parts = [(xl, xm, yl, ym, left), (xm, xh, ym, yh, left), (xl, xm, ym, yh, left - 1), (xm, xh, yl, ym, left - 1)]
        kept = []
        for n, part in enumerate(parts):
            keep = (part[1] > part[0]) & (part[3] > part[2]) & (part[4] >= 0)
            if n == 3:
                keep &= ~twin
            kept.append([column[keep] for column in part])
        frontier = [np.concatenate(columns) for columns in zip(*kept)]
    return np.concatenate(found_x or [one[:0]]), np.concatenate(found_y or [one[:0]])


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links that connect the same values: each value with the least of its component."""
    values, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    root = np.arange(len(values))
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    other = root != np.arange(len(values))
    return values[other], values[root[other]]


def trie_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints within ``max_bits`` bits.

    Each group of the join returns a forest of its links: components stay the same,
    and no group returns more links than it has fingerprints.
    """
    rows = distinct.count()
    levels = min(MOST_LEVELS, max(LEAST_LEVELS, math.ceil(math.log2(max(1, rows / SUBTRIE_ROWS)))))
    bits = 64 - levels
    masks = [0]
    for _ in range(max_bits):
        masks = sorted({mask ^ extra for mask in masks for extra in [0, *(1 << k for k in range(levels))]})
    own = F.shiftrightunsigned("fp", bits)
    paired = (
        distinct.select("fp", own.alias("own"), F.explode(F.lit(masks).cast("array<long>")).alias("mask"))
        .select("fp", "own", F.col("own").bitwiseXOR(F.col("mask")).alias("other"))
        .select("fp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))
    )

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        values = np.sort(pdf["fp"].to_numpy(np.int64).view(np.uint64))
        cut = np.searchsorted(values >> np.uint64(bits), hi)
        x, y = (values, values) if lo == hi else (values[:cut], values[cut:])
        if not len(x) or not len(y):
            return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
        i, j = _pairs_within(x, y, lo == hi, bits, max_bits - (lo ^ hi).bit_count())
        a, b = _forest(x[i].view(np.int64), y[j].view(np.int64))
        return pd.DataFrame({"a": a, "b": b})

    return paired.groupBy("lo", "hi").applyInPandas(join, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node: least-label propagation with shortcuts.

    Each round takes the least label among a node's own and its neighbours', then the
    label of that label.  The aggregation is partial before it shuffles, so a node with
    very many links is no hot key, and rounds are written to the shared folder.
    """
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels")
    if edges.isEmpty():
        return labels
    while True:
        near = (
            looked_up(edges, labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        stepped = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("root").alias("jumped"))
        moved = materialise(
            looked_up(materialise(stepped, "stepped"), jump, "next").select("node", "was", F.least("next", "jumped").alias("root")), "labels"
        )
        labels = moved.select("node", "root")
        if moved.where("root <> was").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fp (signed long), component_id for every row of ``docs``."""
    fps = materialise(fingerprints(docs), "fingerprints")
    distinct = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    links = materialise(trie_links(distinct, max_bits), "links")
    roots = components(links)
    named = distinct.join(roots, distinct["fp"] == roots["node"])
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = looked_up(named, least, "root").select("fp", "component_id")
    of_fp = distinct.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return looked_up(fps, of_fp, "fp").select("doc_id", "fp", "component_id")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
