"""Periodic runs of words: where a text repeats itself over and over.

A run is a stretch of words with smallest period q that no neighbour extends, at least
``min_length`` words and ``min_periods`` periods long.  By the runs theorem each run has a
Lyndon root that is the longest Lyndon word at its start under one of two orders of the
words, the second being the first reversed.  Longest Lyndon words end before the next
smaller value of the inverse suffix array; each is extended both ways by the longest common
extensions, which are minima of the LCP arrays of the text and of its mirror image, found in
sparse tables.

A run of that size repeats a stretch of ``repeated(...)`` words, so a text without such a
repeat (told by rolling hashes; a false alarm costs time only) has no run and needs no arrays.

Defined results: a null or wordless text has no run and an empty collapsed text; rows that
repeat are treated each; ties do not arise, as a run is given by start, length and period;
texts of any length are read whole, in memory of some 8 log2(words) bytes a word for texts
that repeat themselves; an empty table gives an empty result; other columns pass through,
but ``words``, ``runs`` and ``collapsed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from podium.llm.common import table, utf8

MIN_LENGTH, MIN_PERIODS = 24, 3
#: Texts are searched for repeats together, up to so many words.
WORDS_AT_ONCE = 200_000
WORD = r"[^\x20\x09-\x0D]+"
RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def repeated(min_length: int, min_periods: int) -> int:
    """Every run contains two copies, a period apart, of a stretch of at least so many words."""
    return min(max(min_length - q, (min_periods - 1) * q) for q in range(1, min_length + 1))


def inverse_suffix_array(ids: np.ndarray) -> np.ndarray:
    """The rank of each suffix, by prefix doubling; a text's end sorts before every word."""
    n = len(ids)
    ranks = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = ranks[step:] + 1
        key = ranks * (n + 1) + after
        order = np.argsort(key, kind="stable")
        fresh = np.empty(n, np.int64)
        fresh[order] = np.cumsum(np.concatenate([[0], key[order[1:]] != key[order[:-1]]]))
        ranks, step = fresh, 2 * step
        if ranks[order[-1]] == n - 1 or step >= n:
            return ranks


def lcp_array(ids: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Entry k: the common prefix of the suffixes of ranks k and k + 1, in linear time."""
    words, rank, n = ids.tolist(), ranks.tolist(), len(ids)
    suffix = np.argsort(ranks).tolist()
    out, shared = [0] * max(0, n - 1), 0
    for i in range(n):
        if rank[i] == n - 1:
            shared = 0
            continue
        j = suffix[rank[i] + 1]
        top = n - max(i, j)
        while shared < top and words[i + shared] == words[j + shared]:
            shared += 1
        out[rank[i]] = shared
        shared -= shared > 0
    return np.array(out, np.int32)


class Extensions:
    """Longest common extensions of pairs of positions: range minima of the LCP array in a sparse table."""

    def __init__(self, ids: np.ndarray, ranks: np.ndarray) -> None:
        self.n, self.ranks = len(ids), ranks
        self.levels = [lcp_array(ids, ranks)]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            last, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``a`` and ``b`` differ; a position at the text's end has no extension."""
        out = np.zeros(len(a), np.int64)
        inside = np.flatnonzero(np.maximum(a, b) < self.n)
        x, y = self.ranks[a[inside]], self.ranks[b[inside]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            row = self.levels[k]
            out[inside[at]] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return out


def next_smaller(values: list[int]) -> list[int]:
    """For each place the next one with a smaller value; past the end if there is none."""
    out, waiting = [len(values)] * len(values), []
    for place, value in enumerate(values):
        while waiting and values[waiting[-1]] > value:
            out[waiting.pop()] = place
        waiting.append(place)
    return out


def runs_of(ids: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """(start, length, period) of the runs of a sequence of numbers, by start, then period."""
    n = len(ids)
    if n < max(2, min_length):
        return np.zeros((0, 3), np.int64)
    ranks = inverse_suffix_array(ids)
    found = []
    for order, last in ((ranks, n), (-ranks, n - 1)):  # reversed, the text's end is the largest, so words that reach it are none
        stops = np.array(next_smaller(order.tolist()))
        starts = np.flatnonzero(stops <= last)
        periods = stops[starts] - starts
        if min_periods >= 3:  # the first root of such a run has a whole copy behind it
            starts, periods = starts[starts + 2 * periods <= n], periods[starts + 2 * periods <= n]
            alike = (ids[starts] == ids[starts + periods]) & (ids[starts + periods - 1] == ids[starts + 2 * periods - 1])
            starts, periods = starts[alike], periods[alike]
        found.append(np.stack([starts, periods]))
    start, period = np.unique(np.concatenate(found, axis=1), axis=1)
    if not len(start):
        return np.zeros((0, 3), np.int64)
    mirror = ids[::-1].copy()
    ahead = Extensions(ids, ranks)(start, start + period)
    back = Extensions(mirror, inverse_suffix_array(mirror))(n - start, n - start - period)
    begin, length = start - back, period + ahead + back
    whole = (length >= min_length) & (length >= min_periods * period)
    held = np.unique(np.stack([begin[whole], period[whole], length[whole]], axis=1), axis=0)
    return held[:, [0, 2, 1]]


def _may_repeat(ids: np.ndarray, sizes: np.ndarray, span: int) -> np.ndarray:
    """Which of the texts, laid end to end in ``ids``, contain some ``span`` words twice."""
    mixed = ids.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        mixed = (mixed * np.uint64(0x9E3779B97F4A7C15)) ^ (mixed << np.uint64(29))
        base, codes = np.uint64(0xD6E8FEB86659FD93), np.zeros(max(0, len(ids) - span + 1), np.uint64)
        for k in range(span):
            codes = codes * base + mixed[k : k + len(codes)]
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(codes)]
    last = np.repeat(np.cumsum(sizes), sizes)[: len(codes)]
    fits = np.flatnonzero(np.arange(len(codes)) + span <= last)
    owner, codes = owner[fits], codes[fits]
    order = np.lexsort((codes, owner)) if len(sizes) > 1 else np.argsort(codes)
    owner, codes = owner[order], codes[order]
    out = np.zeros(len(sizes), bool)
    out[owner[1:][(codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])]] = True
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if len(runs):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
        np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
        words = [words[k] for k in kept.tolist()]
    return b" ".join(words)


def periodic(texts: list[bytes], min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, np.ndarray, bytes]]:
    """(words, runs, collapsed text) of each text."""
    span, none = repeated(min_length, min_periods), np.zeros((0, 3), np.int64)
    cut = [text.split() for text in texts]  # of bytes: at ASCII white space alone
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(word, len(number)) for words in cut for word in words], np.int64)
    sizes = np.array([len(words) for words in cut])
    ends = np.cumsum(sizes)
    found = [none] * len(cut)
    for k in np.flatnonzero(_may_repeat(ids, sizes, span) & (sizes >= min_length)).tolist():
        found[k] = runs_of(ids[ends[k] - sizes[k] : ends[k]], min_length, min_periods)
    return [(len(words), runs, collapsed(words, runs)) for words, runs in zip(cut, found)]


def with_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """``docs`` with ``words`` (their number), ``runs`` and ``collapsed`` in place of the text column."""
    passed = docs.drop("words", "runs", "collapsed")
    others = [c for c in passed.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, at = utf8(batch, text), 0
            while at < len(whole):
                stop, held = at, 0
                while stop < len(whole) and (stop == at or held + len(whole[stop]) < 6 * WORDS_AT_ONCE):
                    held += len(whole[stop])
                    stop += 1
                words, runs, short = zip(*periodic(whole[at:stop], min_length, min_periods))
                flat = np.concatenate(runs)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32()),
                    pa.StructArray.from_arrays([pa.array(flat[:, k], pa.int64()) for k in range(3)], ["start", "length", "period"]),
                )
                rows = batch.slice(at, stop - at)
                columns = [rows.column(batch.schema.get_field_index(c)) for c in others]
                fresh = [pa.array(words, pa.int64()), lists, pa.array([s.decode("utf-8", "replace") for s in short], pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, *fresh], [*others, "words", "runs", "collapsed"])
                at = stop

    made = StructType.fromDDL(f"words long, runs {RUN}, collapsed string")
    schema = StructType([*passed.select(*others).schema.fields, *made.fields])
    return passed.mapInArrow(run, schema)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; in one document of ten (by doc_id) the words from a place on repeat with a period, both set by doc_id."""
    code = F.crc32(F.col("doc_id").cast("string"))
    words, n, g, a, p = (F.col(f"__{name}") for name in ("words", "n", "g", "a", "p"))
    cut = docs.select("doc_id", "text", F.floor(code / 10).alias("__g"), F.when(code % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), 0)).alias("__words"))
    sized = cut.withColumn("__n", F.size("__words")).withColumn("__a", F.when(n > 0, (g % n).cast("int")))
    placed = sized.withColumn("__p", (1 + F.floor((n - a) / (3 + g % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    tail = F.slice(again, F.lit(1), n - a)
    return placed.select("doc_id", F.when(a.isNull(), F.col("text")).otherwise(F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the runs and of the collapsed texts, and the run of greatest exponent."""
    found = with_runs(planted(table(spark, sf_dir, "documents")))

    def better(best: Column, run: Column) -> Column:
        """Runs come by start, then period, so the first of equal exponents stays."""
        ahead = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | ahead, run).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    digest = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return digest.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
