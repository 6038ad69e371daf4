"""SimHash near-dedup at a similarity: groups of texts whose shingle sets have a Jaccard similarity of 0.8 or more.

At that similarity 64-bit fingerprints differ in about 10 bits, seldom in more than
``MAX_BITS``.  With so large a budget the binary trie alone prunes little, so the trie is
walked within blocks: texts that share one of ``BANDS`` keys, each the hash of ``ROWS``
minima of the text's shingles.  Similar texts share one but for a chance of
(1 - 0.8 ** ROWS) ** BANDS, texts with some passages in common seldom do.  Every pair that
comes out is confirmed by the whole shingle sets before it counts.

Equal sets are one node from the start.  Pairs come in three rounds, so that large groups
of copies cost rows in proportion to their size:

1. each node with one of those that lead its blocks: that which has most company in its own;
2. each node with the leads of its blocks that are not of its group yet;
3. in blocks that still hold several groups, the pairs of different groups within
   ``MAX_BITS``, by the trie.  Subtries of one group are never compared with their like.
   Members bring their whole sets, so the task that finds pairs confirms them and returns
   only those that link groups not linked yet: fewer than it has members.

Defined results: null and wordless texts have the empty set and are alike; a text of
fewer words is one shingle; rows without a doc_id link like others but name a group only
where no row of it has one; repeated rows and rows that share a doc_id are rows of their
own, of which ``one_per_group`` leaves one a group; an empty table gives an empty result;
other columns pass through.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.common import bounded, looked_up, map_batches, materialise, utf8
from podium.llm.simhash import SEED, _pairs_within, components, majority, shingle_hashes

SHINGLE = 5
SIMILARITY = Fraction(4, 5)
#: Bits in which fingerprints of candidates may differ; keys of a text and minima in each.
MAX_BITS, BANDS, ROWS = 18, 16, 3
#: Members of a block that one task compares with as many others, on average at most.
BLOCK_ROWS = 4096
#: Shingles of a part, on average at most (16 MB).
BLOCK_SHINGLES = 2_000_000
#: Rows (of two longs) whose sets are compared are broadcast up to this many, else shuffled.
MOST_BROADCAST = 500_000

_MIX = np.random.default_rng(20).integers(1, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes, ascending."""
    return np.unique(shingle_hashes(text, shingle))


def block_keys(values: np.ndarray) -> np.ndarray:
    """One key a band, as signed longs; none for the empty set."""
    if not len(values):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), 8192):
        part = values[at : at + 8192, None] * _MIX[0]
        least = np.minimum(least, (((part ^ (part >> np.uint64(29))) * _MIX[1]) >> np.uint64(7)).min(axis=0))
    bands = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(bands)], np.uint64).view(np.int64)


def text_hash(text: Column) -> Column:
    """With doc_id it tells rows apart: 64 bits, within one doc_id only."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _node(values: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(values.tobytes(), SEED)


def described(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, of (a hash of the text), node (hash of the shingle set), n (its size), fp (its fingerprint), keys."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(text, shingle) for text in utf8(batch, "text")]
        signed = lambda made: pa.array(np.array([made(x) for x in sets], np.uint64).view(np.int64))
        columns = [batch.column(0), batch.column(2), signed(_node), pa.array([len(x) for x in sets], pa.int32()), signed(majority), pa.array([block_keys(x) for x in sets], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "of", "node", "n", "fp", "keys"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", text_hash(F.col("text")).alias("of"))
    return rows.mapInArrow(map_batches(run), "doc_id long, of long, node long, n int, fp long, keys array<long>")


def _same_row(docs: DataFrame) -> Column:
    return F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (text_hash(docs["text"]) == F.col("__of"))


def _sets(wanted: DataFrame, docs: DataFrame, distinct: DataFrame, shingle: int) -> DataFrame:
    """node, whole (its shingle set, ascending) of the nodes ``wanted``, a written table; written."""
    ids = distinct.join(wanted, "node").select(F.col("who.doc_id").alias("__id"), F.col("who.of").alias("__of"))

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(text, shingle) for text in utf8(batch, "text")]
        nodes = np.array([_node(x) for x in found], np.uint64).view(np.int64)
        flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
        ends = np.concatenate([[0], np.cumsum([len(x) for x in found])])
        return pa.RecordBatch.from_arrays([pa.array(nodes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))], ["node", "whole"])

    rows = docs.select("doc_id", "text").join(bounded(ids, MOST_BROADCAST), _same_row(docs), "left_semi")
    return materialise(rows.select("text").mapInArrow(map_batches(whole), "node long, whole array<long>").dropDuplicates(["node"]), "sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, distinct: DataFrame, shingle: int, similarity: Fraction) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar; ``pairs`` is a written table."""
    if pairs.isEmpty():
        return pairs
    sets = _sets(materialise(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "wanted"), docs, distinct, shingle)
    held = pairs.join(sets.select(F.col("node").alias("a"), F.col("whole").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("whole").alias("y")), "b")

    # pair by pair in the JVM: a batch of pairs would hold all their sets at once
    both, sizes = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    similar = both * (similarity.numerator + similarity.denominator) >= similarity.numerator * sizes
    return materialise(held.where(similar).select("a", "b"), "links")


def _linking(i: np.ndarray, j: np.ndarray, sets: tuple[list, list], roots: tuple[np.ndarray, np.ndarray], similarity: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs (i, j) of two sides as many similar ones as link what all the similar ones link.

    A pair whose groups are linked already is left out, so there are fewer than members of both sides.
    """
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    sizes_x, sizes_y = (np.array([len(x) for x in side], np.int64) for side in sets)
    codes = np.unique(np.concatenate([*sets[0], *sets[1]]), return_inverse=True)[1]
    ends = np.concatenate([[0], np.cumsum(np.concatenate([sizes_x, sizes_y]))])
    held = np.zeros(int(codes.max()) + 1 if len(codes) else 0, bool)
    group = np.unique(np.concatenate(roots), return_inverse=True)[1]
    of_x, of_y = group[: len(sizes_x)], group[len(sizes_x) :]
    label = np.arange(int(group.max()) + 1)
    above, below = similarity.numerator, similarity.numerator + similarity.denominator
    links = []
    firsts = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
    for k, stop in zip(firsts, [*firsts[1:], len(i)]):
        x, ys = i[k], j[k:stop]
        ys = ys[label[of_y[ys]] != label[of_x[x]]]
        if not len(ys):
            continue
        mine = codes[ends[x] : ends[x + 1]]
        held[mine] = True
        for at in range(0, len(ys), 1024):
            some = ys[at : at + 1024]
            starts = np.cumsum(sizes_y[some]) - sizes_y[some]
            flat = np.arange(sizes_y[some].sum()) + np.repeat(ends[len(sizes_x) + some] - starts, sizes_y[some])
            both = np.add.reduceat(held[codes[flat]].astype(np.int64), starts)
            for y in some[both * below >= above * (sizes_x[x] + sizes_y[some])]:
                old, new = label[of_y[y]], label[of_x[x]]
                if old != new:
                    label[label == old] = new
                    links.append((x, y))
        held[mine] = False
    found = np.array(links, np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def _trie_pairs(members: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs (a, b) that link the groups of a block which similar texts within ``MAX_BITS`` link.

    ``members``: key, node, n, fp, root, parts (of the block) and whole.  A task meets two parts, compares the
    whole sets of what the trie finds there, and returns fewer pairs than it has members.
    """
    dealt = members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    met = met.select("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "node", "n", "fp", "root", "whole")
    share = float(similarity)

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        sides = []
        for part in (lo, hi):
            side = pdf[pdf["part"] == part]
            order = np.argsort(side["fp"].to_numpy(np.int64).view(np.uint64), kind="stable")
            sides.append([side[c].to_numpy()[order] for c in ("fp", "node", "n", "root", "whole")])
        (fx, nx, sx, rx, wx), (fy, ny, sy, ry, wy) = sides
        empty = pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
        if not len(fx) or not len(fy):
            return empty
        i, j = _pairs_within(fx.view(np.uint64), fy.view(np.uint64), lo == hi, 64, MAX_BITS, (rx, ry))
        fits = np.minimum(sx[i], sy[j]) >= share * np.maximum(sx[i], sy[j])
        if not fits.any():
            return empty
        i, j = _linking(i[fits], j[fits], (list(wx), list(wy)), (rx, ry), similarity)
        a, b = nx[i], ny[j]
        return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return met.groupBy("key", "lo", "hi").applyInPandas(join, "a long, b long").distinct()


def _grouped(docs: DataFrame, shingle: int, similarity: Fraction) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, of, node), and for each node the ``first`` row of its group, a struct<nameless, doc_id, of>."""
    rows = materialise(described(docs, shingle), "described")
    who = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "of")
    distinct = materialise(rows.groupBy("node", "n", "fp").agg(F.min(who).alias("who"), F.min_by("keys", who).alias("keys")), "distinct")
    keys = distinct.select("node", "n", "fp", F.explode("keys").alias("key"))
    held = keys.groupBy("key").agg(F.count("*").alias("held")).where("held > 1")
    met = materialise(looked_up(keys, held, "key"), "met")
    # a text that others were made from is in more and larger blocks than they are: it leads them
    weights = met.groupBy("node").agg(F.sum("held").alias("weight"))
    weighed = materialise(met.drop("held").join(weights, "node"), "weighed")
    leads = weighed.groupBy("key").agg(F.max(F.struct("weight", F.bitwise_not("node").alias("minus"), F.col("node").alias("node"))).alias("l"))
    shared = materialise(looked_up(weighed, leads.select("key", F.col("l.node").alias("lead"), F.col("l.weight").alias("lead_weight")), "key"), "shared")
    nodes = distinct.select("node")

    def rooted(links: DataFrame) -> DataFrame:
        return materialise(nodes.join(components(links), "node", "left").select("node", F.coalesce("root", "node").alias("root")), "roots")

    pair = [F.greatest("node", "lead").alias("a"), F.least("node", "lead").alias("b")]
    top = shared.groupBy("node").agg(F.max_by("lead", F.struct("lead_weight", F.bitwise_not("lead"))).alias("lead"))
    def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
        """``roots`` after further links, of which each pair of groups counts once."""
        side = lambda name: roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
        met = links.join(side("a"), "a").join(side("b"), "b").where("a_root <> b_root")
        pairs = met.select(F.greatest("a_root", "b_root").alias("a"), F.least("a_root", "b_root").alias("b")).distinct()
        above = components(materialise(pairs, "between")).select(F.col("node").alias("root"), F.col("root").alias("above"))
        return materialise(roots.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "roots")

    first = materialise(top.where("node <> lead").select(*pair).distinct(), "pairs")
    links = _confirmed(first, docs, distinct, shingle, similarity)
    roots = rooted(links)
    apart = looked_up(shared.select("node", "lead").distinct().join(roots, "node"), roots.select(F.col("node").alias("lead"), F.col("root").alias("lead_root")), "lead")
    second = materialise(apart.where("root <> lead_root").select(*pair).distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    confirmed = _confirmed(second, docs, distinct, shingle, similarity)
    if not confirmed.isEmpty():
        roots = joined(roots, confirmed)
    placed = shared.select("key", "node", "n", "fp").join(roots, "node")
    still = placed.groupBy("key").agg((F.min("root") < F.max("root")).alias("open")).where("open").select("key")
    members = materialise(looked_up(placed, still, "key").select("key", "node", "n", "fp", "root"), "open")
    # parts of about BLOCK_ROWS texts and BLOCK_SHINGLES shingles
    parts = members.groupBy("key").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("parts"))
    sets = _sets(materialise(members.select("node").distinct(), "wanted"), docs, distinct, shingle)
    confirmed = materialise(_trie_pairs(looked_up(looked_up(members, parts, "key"), sets, "node"), similarity), "links")
    if not confirmed.isEmpty():
        roots = joined(roots, confirmed)
    named = distinct.select("node", "who").join(roots, "node")
    firsts = looked_up(named.select("node", "root"), named.groupBy("root").agg(F.min("who").alias("first")), "root").select("node", "first")
    return rows.select("doc_id", "of", "node"), firsts


def groups(docs: DataFrame, shingle: int = SHINGLE, similarity: Fraction = SIMILARITY) -> DataFrame:
    """doc_id, component_id (the least doc_id of the group) for every row of ``docs``."""
    rows, firsts = _grouped(docs, shingle, similarity)
    return looked_up(rows, firsts, "node").select("doc_id", F.col("first.doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, similarity: Fraction = SIMILARITY) -> DataFrame:
    """The first row of each group (least doc_id, null last), with the columns of ``docs``."""
    rows, firsts = _grouped(docs, shingle, similarity)
    first = firsts.select("first").distinct().select(F.col("first.doc_id").alias("__id"), F.col("first.of").alias("__of"))
    kept = materialise(first, "kept")
    # always a shuffled join: the kept rows grow with the corpus, and small runs should behave like large ones
    found = docs.join(kept.hint("merge"), _same_row(docs), "left_semi")
    times = rows.groupBy("doc_id", "of").count().where("count > 1").select(F.col("doc_id").alias("__id"), F.col("of").alias("__of"))
    again = materialise(times.join(kept, times["__id"].eqNullSafe(kept["__id"]) & (times["__of"] == kept["__of"]), "left_semi"), "repeated")
    if again.isEmpty():
        return found
    lots = found.join(again, _same_row(docs), "left_semi").dropDuplicates(["doc_id", "text"])
    return found.join(again, _same_row(docs), "left_anti").unionByName(lots)
