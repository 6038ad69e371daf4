"""Token counts that follow edits: a segment tree of pre-tokens per document, kept in a table.

Leaves are the vocabulary's own pre-tokens, with their lengths and token counts, in pages;
a binary tree holds the pages' sums.  An edit finds its place by descending the tree, cuts
the text anew from the last pre-token that it cannot have changed, until a cut meets one
of before, encodes only what lies between, and updates the sums above the pages it touched.

``trees`` writes every document with its leaves once; ``edited`` applies a later table of
edits to the stored trees and can return them for the next one.

Defined results: a null text is empty and has no tokens; edits beyond the text's end are
clipped to it; null places count as the end, a null replacement as empty; edits of a
document apply in the order of ``seq``, each to the text its predecessors left, so they
are one task's work; rows that share a doc_id get the same edits each; rows without a
doc_id get none; documents without edits keep their counts; repeated rows are counted
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import materialise, table, texts
from podium.llm.tokens import Pretokens

PAGE = 64
EDITS = "array<struct<start:long,end:long,replacement:string>>"


class CountTree:
    """The token counts of one text under edits."""

    def __init__(self, text: str, leaves: np.ndarray, by: Pretokens) -> None:
        """``leaves``: rows (length, ids) of the text's pre-tokens."""
        self.text, self.by, self.recoded = text, by, 0
        self._build([leaves[i : i + PAGE].astype(np.int64) for i in range(0, len(leaves), PAGE)])

    def _build(self, pages: list[np.ndarray]) -> None:
        self.pages = pages or [np.zeros((0, 2), np.int64)]
        self.leaves = 1 << (len(self.pages) - 1).bit_length()
        self.sums = np.zeros((2 * self.leaves, 2), np.int64)
        self.sums[self.leaves : self.leaves + len(self.pages)] = [page.sum(axis=0) for page in self.pages]
        level = self.leaves
        while level > 1:
            self.sums[level // 2 : level] = self.sums[level : 2 * level].reshape(-1, 2, 2).sum(axis=1)
            level //= 2

    @property
    def total(self) -> int:
        return int(self.sums[1, 1])

    @property
    def size(self) -> int:
        return sum(map(len, self.pages))

    def table(self) -> np.ndarray:
        return np.concatenate(self.pages)

    def _at(self, place: int) -> tuple[int, int, int]:
        """(page, index in it, begin) of the pre-token that holds ``place``; the end of the last page for the end."""
        node, before = 1, 0
        while node < self.leaves:
            left = int(self.sums[2 * node, 0])
            node = 2 * node if place < before + left else 2 * node + 1
            before += left if node % 2 else 0
        page = min(node - self.leaves, len(self.pages) - 1)
        before = before if page == node - self.leaves else int(self.sums[1, 0] - self.sums[self.leaves + page, 0])
        ends = before + np.cumsum(self.pages[page][:, 0])
        k = int(np.searchsorted(ends, place, side="right"))
        return page, k, int(ends[k - 1]) if k else before

    def _ends(self, page: int, index: int, begin: int) -> Iterator[tuple[int, int, int]]:
        """(page, index after, end) of the pre-tokens from there on."""
        for p in range(page, len(self.pages)):
            for k, length in enumerate(self.pages[p][index:, 0].tolist(), index + 1):
                begin += length
                yield p, k, begin
            index = 0

    def edit(self, start: int, end: int, replacement: str) -> None:
        """Replace text[start:end]."""
        old = self.text
        start = min(max(start, 0), len(old))
        end = min(max(end, start), len(old))
        self.text = text = old[:start] + replacement + old[end:]
        first_page, first, left = self._at(max(start - self.by.context, 0))
        grown = len(replacement) - (end - start)
        before = self._ends(first_page, first, left)
        last_page, last, at = first_page, first, left
        stops = []
        for stop in self.by.ends(text, left):
            stops.append(stop)
            if stop >= start + len(replacement):
                while at < stop - grown and (step := next(before, None)):
                    last_page, last, at = step
                if at == stop - grown and at >= end:
                    break
        else:  # to the text's end
            for last_page, last, at in before:
                pass
        fresh = self.by.table(text, left, stops).astype(np.int64)
        self.recoded += len(fresh)
        merged = np.concatenate([self.pages[first_page][:first], fresh, self.pages[last_page][last:]])
        if len(merged) > 8 * PAGE:
            parts = [merged[i : i + PAGE] for i in range(0, len(merged), PAGE)]
            self._build([*self.pages[:first_page], *parts, *self.pages[last_page + 1 :]])
            return
        for page in range(first_page, last_page + 1):
            self.pages[page] = merged if page == first_page else merged[:0]
            self._update(page)

    def _update(self, page: int) -> None:
        node = self.leaves + page
        change = self.pages[page].sum(axis=0) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2


def dump(leaves: np.ndarray) -> bytes:
    """A byte a pre-token (length and ids in half a byte each), zero where either is too large; those follow in full."""
    small = (leaves[:, 0] < 16) & (leaves[:, 1] < 16)
    short = np.where(small, leaves[:, 0] + 16 * leaves[:, 1], 0).astype(np.uint8)
    return len(leaves).to_bytes(8, "little") + short.tobytes() + leaves[~small].astype("<u4").tobytes()


def load(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    short = np.frombuffer(data, np.uint8, n, 8)
    out = np.stack([short & 15, short >> 4], axis=1).astype(np.int64)
    out[short == 0] = np.frombuffer(data, "<u4", -1, 8 + n).reshape(-1, 2)
    return out


STORED = "doc_id long, text string, tree binary"


def trees(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, text, tree: every document with the leaves of its tree, to be written and edited later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Pretokens(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = [dump(leaves) for leaves in by.tables(texts(rows, "text"))]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(found, pa.binary())], ["doc_id", "text", "tree"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, STORED)


def attach_edits(stored: DataFrame, edits: DataFrame) -> DataFrame:
    """``stored`` rows with their edits as an array: ``edits`` has doc_id, seq, start, end, replacement."""
    listed = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("seq", "start", "end", "replacement"))).alias("edits"))
    told = stored.select("doc_id", "text", "tree").join(listed, "doc_id", "left")
    plain = F.transform("edits", lambda e: F.struct(e["start"].cast("long").alias("start"), e["end"].cast("long").alias("end"), e["replacement"].alias("replacement")))
    return told.select("doc_id", "text", "tree", plain.alias("edits"))


COUNTS = "doc_id long, n_edits long, tokens_before long, tokens_after long, n_pieces long, n_recoded long, chars_after long"


def edited(stored: DataFrame, tokenizer_path: str, keep: bool = False) -> DataFrame:
    """Counts of rows (doc_id, text, tree, edits) before and after their edits, and the work it took.

    ``keep``: with the text and the tree as the edits left them, ready to be stored again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Pretokens(tokenizer_path)
        for batch in batches:
            rows, states = [], []
            for doc_id, text, data, edits in zip(*(batch.column(k).to_pylist() for k in range(4))):
                tree = CountTree(text or "", load(data), by)
                before, pieces = tree.total, tree.size
                for e in edits or []:
                    if e is not None:
                        far = len(tree.text)
                        tree.edit(far if e["start"] is None else e["start"], far if e["end"] is None else e["end"], e["replacement"] or "")
                rows.append((doc_id, len(edits or []), before, tree.total, pieces, tree.recoded, len(tree.text)))
                if keep:
                    states.append((tree.text if text is not None or tree.text else None, dump(tree.table())))
            columns = [pa.array(list(c), pa.int64()) for c in zip(*rows)]
            names = [part.split()[0] for part in COUNTS.split(", ")]
            if keep:
                columns += [pa.array([x for x, _ in states], pa.string()), pa.array([x for _, x in states], pa.binary())]
                names += ["text", "tree"]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = stored.select(F.col("doc_id").cast("long"), "text", "tree", F.col("edits").cast(EDITS))
    return rows.mapInArrow(run, COUNTS + (", text string, tree binary" if keep else ""))


def sample_edits(stored: DataFrame) -> DataFrame:
    """Every row with four edits at hashed places: an insertion, a deletion, a replacement, an append."""
    n = F.length(F.coalesce("text", F.lit(""))).cast("long")
    place = lambda k: F.pmod(F.xxhash64("doc_id", F.lit(k)), n + 1)
    edit = lambda start, length, text: F.struct(start.alias("start"), (start + length).alias("end"), F.lit(text).alias("replacement"))
    edits = F.array(edit(place(1), 0, " a few new words"), edit(place(2), 12, ""), edit(place(3), 7, "re-placed 2x"), edit(n * 2, 0, "\nThe end."))
    return stored.select("doc_id", "text", "tree", edits.alias("edits"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    stored = materialise(trees(table(spark, sf_dir, "documents"), path), "trees")
    return edited(sample_edits(stored), path)
