"""Exact top-k by inner product with M-trees and best-first search.

Inner product is no metric, so every vector gets one coordinate more, sqrt(M - |x|^2) with
M the largest squared norm of its dimension, and queries get 0 there.  Then
|q - x|^2 = |q|^2 + M - 2 q.x: the nearest vectors are those of the highest score, and
the triangle inequality holds.

The top of the tree is a table: vectors belong to the nearest of at most ``MOST_CELLS``
pivots (a bounded sample by hash; only the cells' shapes depend on it), and a cell's
covering radius is kept.  A cell is dealt to shards of about ``SHARD_ROWS`` vectors, each
a paged M-tree: every node has a pivot, a covering radius and the distance to its parent's
pivot; leaf entries have theirs.  The search takes the node with the least bound first;
stored parent distances rule out nodes and entries before any distance to them is
computed.  Bounds are floating-point with a margin, scores exact integers, so ties are
settled exactly.

A query first searches the shards of its own cell.  Its k-th score then rules out cells
by pivot and radius, and it visits only the others: queries move, trees stay.  Where
vectors are so spread that no bound excludes anything, every query meets every shard and
the work grows with queries times rows.

Defined results: vectors that are null, empty or hold null or non-finite components take
no part; vectors compare with vectors of their own dimension; a repeated row is a row of
its own and finds its twin; ties go to the smaller vec_id (null last); rows with a null
vec_id are candidates but no queries; scores outside the range of a long are cut to it;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from podium.llm.common import bounded, materialise, table

SCALE = 256
SHARD_ROWS = 2048
#: Pivots of a dimension, and dimensions that have pivots: those of the most vectors; others are one cell.
MOST_CELLS, MOST_DIMENSIONS = 256, 16
#: Queries that meet a shard in one task, on average at most.
SLICE_ROWS = 8192
PAGE, FANOUT = 256, 8
#: Sums of integer products below this are exact in double precision.
EXACT = 2.0**53
#: Stands for a null id: the largest long, so that it comes last among ties.
NO_ID = 2**63 - 1


def _margin(base: float) -> float:
    return 1e-6 * (1 + math.sqrt(base))


def _lift(plain: np.ndarray, top: float) -> np.ndarray:
    return np.sqrt(np.maximum(top - (plain**2).sum(axis=1), 0))


class MTree:
    """Over whole numbers in doubles; ``rows`` tells equal ids apart, ``top`` is M."""

    def __init__(self, plain: np.ndarray, ids: np.ndarray, rows: np.ndarray | None = None, top: float | None = None) -> None:
        self.top = float((plain**2).sum(axis=1).max()) if top is None else top
        extra = _lift(plain, self.top)

        def distance(members: np.ndarray, pivot: int) -> np.ndarray:
            dots = plain[members] @ plain[pivot] + extra[members] * extra[pivot]
            return np.sqrt(np.maximum(2 * self.top - 2 * dots, 0))

        rng = np.random.default_rng(0)
        everything = np.arange(len(plain))
        middle = int(np.argmin(((plain - plain.mean(axis=0)) ** 2).sum(axis=1)))
        nodes = [(everything, middle, 0.0)]
        kids: list[tuple[int, int]] = []
        self.radius, leaf_parts, leaf_dists, filled = [], [], [], 0
        at = 0
        while at < len(nodes):
            members, pivot, _ = nodes[at]
            to_pivot = distance(members, pivot)
            self.radius.append(float(to_pivot.max()))
            if len(members) <= PAGE:
                kids.append((-1 - filled, -1 - filled - len(members)))
                leaf_parts.append(members)
                leaf_dists.append(to_pivot)
                filled += len(members)
            else:
                seeds = rng.choice(members, FANOUT, replace=False)
                own = np.argmin(np.stack([distance(members, s) for s in seeds]), axis=0)
                groups = [(members[own == k], int(s)) for k, s in enumerate(seeds)]
                if max(len(g) for g, _ in groups) == len(members):  # all alike
                    groups = [(g, int(g[0])) for g in np.array_split(members, FANOUT)]
                groups = [(g, s) for g, s in groups if len(g)]
                kids.append((len(nodes), len(nodes) + len(groups)))
                nodes += [(g, s, float(distance(np.array([s]), pivot)[0])) for g, s in groups]
            at += 1
        order = np.concatenate(leaf_parts)
        self.vectors, self.ids = plain[order], ids[order]
        self.rows = (np.arange(len(plain)) if rows is None else rows)[order]
        self.entry_parent = np.concatenate(leaf_dists)
        self.kids = np.array(kids)
        self.radius = np.array(self.radius)
        self.parent = np.array([d for _, _, d in nodes])
        self.pivots = plain[[p for _, p, _ in nodes]]

    def search(self, query: np.ndarray, k: int, skip: int) -> list[tuple[int, int]]:
        """The k best (score, entry) by score, then id; ``skip``: an entry that takes no part, or -1."""
        plain = query
        base = float((plain**2).sum()) + self.top
        exact = base < EXACT / 4  # else whole numbers of any size
        vectors = self.vectors if exact else self._whole()
        query = query if exact else np.array([int(x) for x in query], dtype=object)
        margin = _margin(base)
        reach = lambda score: math.sqrt(max(base - 2 * score, 0))
        best: list[tuple] = []  # a heap, worst first: (score, -id, entry)
        limit = math.inf
        root = reach(float(self.pivots[0] @ plain))
        queue = [(max(root - self.radius[0], 0), 0, root)]
        while queue:
            bound, node, own = heapq.heappop(queue)
            if bound > limit:
                break
            a, b = self.kids[node].tolist()
            if a < 0:
                a, b = -1 - a, -1 - b
                near = np.flatnonzero(np.abs(self.entry_parent[a:b] - own) <= limit) + a
                scores = vectors[near] @ query
                if exact and len(best) == k:
                    hold = scores >= best[0][0]
                    near, scores = near[hold], scores[hold]
                for entry, score in zip(near.tolist(), scores.tolist()):
                    if entry == skip:
                        continue
                    item = (int(score), -self.ids[entry], entry)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                    else:
                        continue
                    if len(best) == k:
                        limit = reach(float(best[0][0])) + margin
            else:
                child = np.arange(a, b)
                child = child[np.abs(self.parent[a:b] - own) - self.radius[a:b] <= limit]
                dists = np.sqrt(np.maximum(base - 2 * (self.pivots[child] @ plain), 0))
                for c, d, r in zip(child.tolist(), dists.tolist(), self.radius[child].tolist()):
                    if d - r <= limit:
                        heapq.heappush(queue, (max(d - r, 0), c, d))
        return [(score, entry) for score, _, entry in sorted(best, reverse=True)]

    def _whole(self) -> np.ndarray:
        if not hasattr(self, "whole"):
            self.whole = np.array([[int(x) for x in row] for row in self.vectors], dtype=object)
        return self.whole

    FIELDS = ("top", "vectors", "ids", "rows", "entry_parent", "kids", "radius", "parent", "pivots")

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in self.FIELDS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> MTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as held:
            for name in cls.FIELDS:
                setattr(tree, name, held[name])
        tree.top = float(tree.top)
        return tree


class Cells(NamedTuple):
    """The top of one dimension's tree: M, pivots, the cells' radii and shards."""

    top: float
    pivots: np.ndarray
    radius: np.ndarray
    shards: np.ndarray

    def nearest(self, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's cell and its distance to the pivot."""
        dots = plain @ self.pivots.T + np.outer(_lift(plain, self.top), _lift(self.pivots, self.top))
        cell = dots.argmax(axis=1)
        return cell, np.sqrt(np.maximum(2 * self.top - 2 * dots[np.arange(len(cell)), cell], 0))

    def within(self, query: np.ndarray, score: float | None) -> np.ndarray:
        """Cells that may hold a vector of at least ``score``."""
        base = float((query**2).sum()) + self.top
        away = np.sqrt(np.maximum(base - 2 * (self.pivots @ query), 0)) - self.radius
        limit = math.inf if score is None else math.sqrt(max(base - 2 * score, 0)) + 2 * _margin(base)
        return np.flatnonzero((away <= limit) & (self.shards > 0))


class Index(NamedTuple):
    """``vectors``: dim, row, vec_id, vector, cell; ``trees``: dim, cell, part, tree; ``shards``: dim, cell, parts."""

    vectors: DataFrame
    trees: DataFrame
    shards: DataFrame
    cells: dict[int, Cells]


def _floor(x: Column) -> Column:
    """floor(SCALE * x) as a double: Spark's floor gives a long, which large components exceed."""
    scaled = x * float(SCALE)
    return F.when(F.abs(scaled) < EXACT, F.floor(scaled).cast("double")).otherwise(scaled)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> Index:
    """Of rows (vec_id, embedding)."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == math.inf))
    usable = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & ~F.coalesce(bad, F.lit(True)))
    scaled = F.transform("embedding", _floor)
    rows = materialise(usable.select(F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("row"), "vec_id", scaled.alias("vector")), "vectors")
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    stats = rows.groupBy("dim").agg(F.count("*").alias("n"), F.max(square).alias("top"))
    large = stats.where(F.col("n") > shard_rows).orderBy(F.desc("n"), "dim").limit(MOST_DIMENSIONS).collect()
    cells = {}
    if large:
        drawn = Window.partitionBy("dim").orderBy(F.xxhash64("row"), "row")
        sample = rows.where(F.col("dim").isin([r["dim"] for r in large])).select("dim", "vector", F.row_number().over(drawn).alias("k")).where(F.col("k") <= MOST_CELLS).collect()
        for r in large:
            most = math.ceil(r["n"] / shard_rows)
            pivots = np.array([x["vector"] for x in sorted((x for x in sample if x["dim"] == r["dim"]), key=lambda x: x["k"]) if x["k"] <= most])
            cells[r["dim"]] = Cells(r["top"], pivots, np.zeros(len(pivots)), np.zeros(len(pivots), int))
    tops = cells

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for dim, part in pdf.groupby("dim"):
                cell, away = tops[dim].nearest(_matrix(part["vector"])) if dim in tops else (0, 0.0)
                yield part.assign(cell=cell, away=away)

    placed = materialise(rows.mapInPandas(assign, "dim int, row long, vec_id long, vector array<double>, cell int, away double"), "placed")
    shards = materialise(placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("parts"), F.max("away").alias("radius")), "shards")
    for r in shards.where(F.col("dim").isin(list(cells))).collect() if cells else []:
        cells[r["dim"]].radius[r["cell"]] = r["radius"]
        cells[r["dim"]].shards[r["cell"]] = r["parts"]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        dim = int(pdf["dim"].iloc[0])
        ids = pdf["vec_id"].astype("Int64").fillna(NO_ID).to_numpy(np.int64)
        tree = MTree(_matrix(pdf["vector"]), ids, pdf["row"].to_numpy(), tops[dim].top if dim in tops else None)
        return pdf.iloc[:1][["dim", "cell", "part"]].assign(tree=[tree.dump()])

    dealt = placed.join(bounded(shards.drop("radius"), 100_000), ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    trees = dealt.select("dim", "cell", "part", "row", "vec_id", "vector").groupBy("dim", "cell", "part").applyInPandas(build, "dim int, cell int, part int, tree binary")
    return Index(placed.drop("away"), materialise(trees, "trees", "uncompressed"), shards.select("dim", "cell", "parts"), cells)


def visit(index: Index, visits: DataFrame, slices: int, k: int) -> DataFrame:
    """row, query_id, vec_id, score: the k best of each visited shard.  ``visits``: dim, cell, part, row, query_id, vector.

    Each shard meets its queries once, in ``slices`` lots: both sides shuffle by shard and lot.
    """
    keys = ["dim", "cell", "part", "slice"]

    def run(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(held):
            tree = MTree.load(held["tree"].iloc[0])
            place = {row: at for at, row in enumerate(tree.rows.tolist())}
            for row, query_id, vector in zip(queries["row"].tolist(), queries["query_id"].tolist(), queries["vector"]):
                for score, entry in tree.search(np.asarray(vector, float), k, place.get(row, -1)):
                    out.append((row, query_id, int(tree.ids[entry]), max(-(2**63), min(2**63 - 1, score))))
        return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"]).astype("int64")

    lots = visits.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int"))
    trees = index.trees.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return lots.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInPandas(run, "row long, query_id long, vec_id long, score long")


def search(index: Index, every: int, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the rows whose id is divisible by ``every`` against all other rows."""
    queries = index.vectors.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id")
    slices = max(1, math.ceil(queries.count() / SLICE_ROWS))
    part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    told = ["dim", "cell", part, "row", "query_id", "vector"]
    home = queries.join(bounded(index.shards, 100_000), ["dim", "cell"]).select(*told)
    first = materialise(visit(index, home, slices, k), "home")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    reached = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select("row", "score")
    cells = index.cells

    def others(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for dim, own, row, query_id, vector, score in zip(*(pdf[c].tolist() for c in ("dim", "cell", "row", "query_id", "vector", "score"))):
                top = cells[dim]
                for cell in top.within(np.asarray(vector, float), None if score is None or score != score else score).tolist():
                    if cell != own:
                        out += [(dim, cell, part, row, query_id, vector) for part in range(int(top.shards[cell]))]
            yield pd.DataFrame(out, columns=["dim", "cell", "part", "row", "query_id", "vector"])

    found = first
    if cells:
        schema = "dim int, cell int, part int, row long, query_id long, vector array<double>"
        left = queries.where(F.col("dim").isin(list(cells))).join(reached, "row", "left").select("dim", "cell", "row", "query_id", "vector", F.col("score").cast("double"))
        found = found.union(visit(index, left.mapInPandas(others, schema), slices, k))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")


def op6_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(index(table(spark, sf_dir, "embeddings")), 50, 5)
