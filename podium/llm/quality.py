"""Quality classifier: a weak-label model and a hashed linear scorer.

1. Overlapping heuristic labellers vote good, bad or abstain on every document.
2. Expectation-maximisation over the counts of distinct vote patterns of all documents
   (at most 3 ** labellers * 3 rows, whatever the corpus) estimates each labeller's accuracy
   on good and bad documents and the share of good ones.  Documents with a given label
   count with that label: it fixes their class in every round.
3. The posterior of a document's pattern is its label, if EM is sure of it (``CONFIDENT``):
   where given labels show a pattern to be mixed, only its labelled documents teach.  A linear scorer over hashed
   words, word beginnings and shape features is trained on a bounded sample of
   documents, ``sample_rows`` at most, drawn by hash; half of either side has no given
   label, so that the posteriors teach at every size of the table.  Training is
   L1-regularised logistic regression, so that rare decisive words keep their weight and
   common words lose theirs.
4. Every document's whole text is scored; a document is kept when its score is at least
   ``THRESHOLD``.

Defined results: a null or wordless text scores by its shape alone (no words: rejected);
repeated rows are scored each; a null doc_id has no given label and is scored all the
same; an empty table gives an empty result; other columns pass through ``keep`` and ``kept``, the
latter whatever their names; without labels, or with none for these documents, EM alone teaches.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from podium.llm.common import materialise, table, texts

BITS = 18
SAMPLE_ROWS = 8000
#: A feature needs so many of the sample's documents.
LEAST_DOCS = 5
#: A pattern teaches when its posterior is as close to 0 or 1.
CONFIDENT = 0.02
THRESHOLD = 0.5
EPOCHS = 12
PREFIXES = (4, 5, 6)
GOOD, BAD, ABSTAIN = 1, 0, -1
#: English words of abuse, for one labeller; the scorer learns others from labels.
ABUSE = frozenset("idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown clowns".split())
_WORD = re.compile(r"[^\W\d_]+")
LABELLERS = ("repeated_words", "few_distinct", "symbols", "capitals", "bars", "abuse", "shouting", "short")


def shape(text: str) -> tuple[list[str], list[str], dict[str, float]]:
    """White-space words, lower-case letter words, and shares that do not depend on the length."""
    words = text.split()
    letters = _WORD.findall(text.lower())
    n = max(1, len(words))
    windows = range(0, len(words), 100)
    shares = {
        "repeat": sum(a == b for a, b in zip(words, words[1:])) / n,
        "distinct": float(np.mean([len(set(words[i : i + 100])) / len(words[i : i + 100]) for i in windows])) if words else 0.0,
        "overall": len(set(words)) / n,
        "symbols": sum(text.count(c) for c in "%*#&$@^~|<>{}[]\\") / max(1, len(text)),
        "capitals": sum(w.isupper() for w in words if len(w) > 1) / n,
        "bars": text.count("|") / n,
        "bangs": text.count("!") / n,
    }
    return words, letters, shares


def votes(text: str) -> list[int]:
    """One vote per labeller, in the order of ``LABELLERS``."""
    words, letters, s = shape(text)
    return [
        BAD if s["repeat"] > 0.15 else GOOD if s["repeat"] < 0.05 else ABSTAIN,
        ABSTAIN if len(words) < 20 else BAD if s["distinct"] < 0.35 else GOOD if s["distinct"] > 0.5 else ABSTAIN,
        BAD if s["symbols"] > 0.05 else GOOD if s["symbols"] < 0.01 else ABSTAIN,
        BAD if s["capitals"] > 0.5 else GOOD if s["capitals"] < 0.1 else ABSTAIN,
        BAD if s["bars"] > 0.1 else ABSTAIN,
        BAD if not ABUSE.isdisjoint(letters) else ABSTAIN,
        BAD if s["bangs"] > 0.3 else GOOD if s["bangs"] < 0.05 else ABSTAIN,
        BAD if not words else ABSTAIN,
    ]


def features(text: str, bits: int = BITS) -> np.ndarray:
    """Distinct hashed features: words, word beginnings, binned shares."""
    _, letters, shares = shape(text)
    out = set()
    crc, mask = zlib.crc32, (1 << bits) - 1
    for word in set(letters):
        out.add(crc(word.encode()) & mask)
        for n in PREFIXES:
            if len(word) > n:
                out.add(crc(f"{word[:n]}-".encode()) & mask)
    for name, value in shares.items():
        for k in range(1, 11):  # thermometer bins: a linear scorer can put its step anywhere
            if value >= k / (40 if name in ("symbols", "repeat", "bars", "bangs") else 10):
                out.add(crc(f"\x00{name}{k}".encode()) & mask)
    if not letters:
        out.add(crc(b"\x00empty") & mask)
    return np.fromiter(out, np.int64, len(out))


def vote_table(docs: DataFrame) -> DataFrame:
    """doc_id, key (a hash that draws the sample), pattern (votes, one character each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = texts(batch, "text")
            patterns = ["".join("01-"[v] for v in votes(t)) for t in found]
            keys = [zlib.crc32(t.encode("utf-8", "replace")) for t in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(patterns)], ["doc_id", "key", "pattern"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, key long, pattern string")


def fit_labellers(patterns: dict[str, int], rounds: int = 60) -> tuple[float, np.ndarray, dict[str, float]]:
    """EM: share of good documents, P(vote | class) per labeller, posterior of good per pattern.

    A pattern's last character is the given label: 0, 1, or - for none.
    A labeller has its own probability of voting good, bad or abstaining for either class.
    It starts from a majority vote in which any bad vote outweighs the good ones, as each
    labeller looks for one defect.
    """
    if not patterns:
        return 0.5, np.zeros((0, 2, 3)), {}
    names = sorted(patterns)
    count = np.array([patterns[p] for p in names], float)
    coded = np.array([["01-".index(c) for c in p[:-1]] for p in names])
    given = np.array(["01-".index(p[-1]) for p in names])
    fixed = np.where(given == 2, np.nan, given)
    post = np.where(np.isnan(fixed), np.where((coded == BAD).any(axis=1), 0.05, 0.95), fixed)
    onehot = np.eye(3)[coded]
    share, accuracy = 0.5, np.zeros((0, 2, 3))
    for _ in range(rounds):
        weight = np.stack([count * (1 - post), count * post])
        share = (weight[1].sum() + 1) / (count.sum() + 2)
        held = np.einsum("cp,plv->lcv", weight, onehot) + np.array([[0.6, 0.2, 0.2], [0.02, 0.78, 0.2]])
        accuracy = held / held.sum(axis=2, keepdims=True)
        logs = np.einsum("plv,lcv->pc", onehot, np.log(accuracy)) + np.log([1 - share, share])
        new = np.where(np.isnan(fixed), 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50))), fixed)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return float(share), accuracy, dict(zip(names, post.tolist()))


def train_scorer(rows: list[np.ndarray], target: np.ndarray, bits: int = BITS, l1: float = 0.03) -> tuple[np.ndarray, float]:
    """Weights and bias: proximal (L1) stochastic gradient with per-weight rates, a fixed order."""
    often = np.bincount(np.concatenate(rows) if rows else np.zeros(0, np.int64), minlength=1 << bits) >= LEAST_DOCS
    rows = [x[often[x]] for x in rows]
    weight, square = np.zeros(1 << bits), np.full(1 << bits, 1e-3)
    bias, rng = 0.0, np.random.default_rng(7)
    balance = np.where(target >= 0.5, 1.0, max(1.0, (target >= 0.5).sum() / max(1, (target < 0.5).sum())))
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            x = rows[i]
            p = 1 / (1 + np.exp(-np.clip(weight[x].sum() + bias, -30, 30)))
            g = (p - target[i]) * balance[i]
            square[x] += g * g
            rate = 0.25 / np.sqrt(square[x])
            moved = weight[x] - rate * g
            weight[x] = np.sign(moved) * np.maximum(np.abs(moved) - rate * l1, 0)
            bias -= 0.02 * g / (1 + epoch)
    return weight, bias


def draw(voted: DataFrame, sides: list[Column], rows: int) -> list[tuple[int, int, str]]:
    """(doc_id, key, pattern), at most ``rows`` a side, by hash, of distinct rows.

    Half of a side has no given label; where one kind is short, the other fills up.
    """
    order = [F.xxhash64("key", "doc_id"), "doc_id", "pattern"]
    known = voted.where("doc_id is not null")
    parts = [known.where(side & (F.col("given").isNotNull() == given)).orderBy(*order).limit(rows).withColumn("part", F.lit(2 * k + given)) for k, side in enumerate(sides) for given in (False, True)]
    found = reduce(DataFrame.union, parts).select("part", "doc_id", "key", "pattern", order[0].alias("hash")).collect()
    held = [sorted((r["hash"], r["doc_id"], r["pattern"], r["key"]) for r in found if r["part"] == part) for part in range(len(parts))]
    out = []
    for free, given in zip(held[::2], held[1::2]):
        n = max(rows - rows // 2, rows - len(given))
        out += [*free[:n], *given[: rows - min(n, len(free))]]
    return [(doc_id, key, pattern) for _, doc_id, pattern, key in out]


def drawn_features(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, pattern, x (features), a row for each of ``chosen``, on however many rows of ``docs`` it stands."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.crc32("text"))
    picked = keyed.join(F.broadcast(chosen), ["doc_id", "key"]).groupBy("doc_id", "key", "pattern").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t).astype(np.int32).tobytes() for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.binary())], ["doc_id", "pattern", "x"])

    return picked.select("doc_id", "text", "pattern").mapInArrow(run, "doc_id long, pattern string, x binary")


def fit(docs: DataFrame, labels: DataFrame | None = None, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float]:
    """The scorer's weights and bias.  ``labels`` has doc_id, quality, toxic."""
    # a row that is repeated is one row with a count from here on
    known = materialise(vote_table(docs).groupBy("doc_id", "key", "pattern").count(), "votes")
    if labels is not None:
        good = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.min(((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).cast("int")).alias("given")
        )
        known = known.join(good, "doc_id", "left")
    else:
        known = known.withColumn("given", F.lit(None).cast("int"))
    mark = F.when(F.col("given").isNull(), "-").otherwise(F.col("given").cast("string"))
    voted = materialise(known.withColumn("pattern", F.concat("pattern", mark)), "marked")
    counts = {r["pattern"]: r["n"] for r in voted.groupBy("pattern").agg(F.sum("count").alias("n")).collect()}
    _, _, posterior = fit_labellers(counts)
    sure = {p: g for p, g in posterior.items() if min(g, 1 - g) <= CONFIDENT} or posterior
    # half of the sample for either side, so that rare defects are learnt
    sides = [F.col("pattern").isin([p for p, g in sure.items() if (g >= 0.5) == side]) for side in (False, True)]
    chosen = docs.sparkSession.createDataFrame(draw(voted, sides, sample_rows // 2), "doc_id long, key long, pattern string")
    sample = drawn_features(docs, chosen).collect()
    sample.sort(key=lambda r: (r["doc_id"], r["pattern"], r["x"]))
    rows = [np.frombuffer(r["x"], np.int32) for r in sample]
    target = np.array([posterior[r["pattern"]] for r in sample])
    return train_scorer(rows, target)


def scored(docs: DataFrame, weight: np.ndarray, bias: float, column: str = "_score") -> DataFrame:
    """All columns of ``docs`` and ``column``, the scorer's probability that a document is good (an older one of that name goes)."""
    docs = docs.drop(column)
    used = np.flatnonzero(weight)
    model = docs.sparkSession.sparkContext.broadcast((used.astype(np.int32), weight[used].astype(np.float32), bias))
    size = len(weight)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, b = model.value
        dense = np.zeros(size)
        dense[at] = values
        for batch in batches:
            found = [1 / (1 + np.exp(-np.clip(dense[features(t)].sum() + b, -30, 30))) if t.strip() else 0.0 for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, column])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())]))


def keep(docs: DataFrame, labels: DataFrame | None = None, column: str = "_score") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their columns and the score, ``column``."""
    return scored(docs, *fit(docs, labels), column).where(F.col(column) >= THRESHOLD)


def kept(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts with their own columns only, whatever their names."""
    column = "_score"
    while column.lower() in [c.lower() for c in docs.columns]:
        column += "_"
    return keep(docs, labels, column).drop(column)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and score of every document that is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return keep(docs, table(spark, sf_dir, "labels")).select("doc_id", F.col("_score").alias("score"))
