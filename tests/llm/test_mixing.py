"""Mixing against plain Python."""

import random
import re

from pyspark.sql import functions as F

from podium.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_level(sizes, weights, epochs=3):
    """Clamp and share anew, in plain words of the rule."""
    total, clamped = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in clamped)
        weight = sum(weights[s] for s in sizes if s not in clamped)
        target = {s: epochs * sizes[s] if s in clamped else left * weights[s] / weight for s in sizes}
        above = {s for s in sizes if target[s] > epochs * sizes[s]} - clamped
        if not above:
            return target
        clamped |= above


def corpus(seed, sources, n):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        source = sources[0] if rng.random() < 0.4 else rng.choice(sources)
        rows.append((k, rng.choice([" ", "\n ", "\t"]).join(["w"] * rng.choice([0, 1, 3, 20, 150])), source))
    return rows + [(None, "a b c", sources[0])] * 4 + [(5, None, None), (6, " \x0b\x1c é", None), (7, "", "empty source")]


def check(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op12_source_mixing(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    again = mixing.op12_source_mixing(spark, str(tmp_path)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(again, key=key)
    sizes, of = {}, {}
    for doc_id, text, source in rows:
        n = len(WORD.findall(text or ""))
        sizes[source] = sizes.get(source, 0) + n
        of.setdefault(doc_id, []).append((n, source))
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    target = water_level(sizes, {s: 1 + k % 3 for k, s in enumerate(names)})
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        n, source = next((n, s) for n, s in of[r.doc_id] if n == r["size"] and sizes[s] == r.source_size)
        assert abs(r.target - target[source]) < 1e-6 * (1 + target[source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source] += r.taken
    for source in sizes:
        copies = 4  # equal rows give equal parts
        assert abs(taken[source] - target[source]) <= 0.5 + copies, source


def test_targets_and_draws(spark, tmp_path):
    check(spark, corpus(1, ["hot", "b", "c", "é", "z", "\U0001f600", "￿"], 900), tmp_path)


def test_small_sources_are_capped_in_rounds(spark, tmp_path):
    rows = [(k, "w " * (2 ** (k // 3)), f"s{k // 3}") for k in range(30)]
    check(spark, rows, tmp_path)


def test_without_words_and_without_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r.target, r.taken) for r in mixing.mixed(docs, [1]).collect()] == [(0, 0.0, 0)] * 2
    assert mixing.mixed(docs.limit(0), [1, 2]).count() == 0


def test_equal_rows_share_the_rest(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x")] * 30 + [(2, "q " * 10, "y")], "doc_id long, text string, source string")
    got = mixing.mixed(docs, [3, 1]).collect()
    assert len({r.taken for r in got if r.source == "x"}) == 1
    assert abs(sum(r.taken for r in got if r.source == "x") - next(r.target for r in got if r.source == "x")) <= 30


def test_repetitions_hold_the_words_taken(spark):
    docs = spark.createDataFrame(corpus(3, ["a", "b", "c"], 200), "doc_id long, text string, source string")
    mix = mixing.mixed(docs, [1, 5, 2])
    read = mixing.repetitions(mix).collect()
    assert sum(len(WORD.findall(r.text)) for r in read) == mix.agg(F.sum("taken")).first()[0]
    assert max(r.repetition for r in read) <= 3
