"""Periodic runs against a search by definition."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from podium.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_definition(words, min_length, min_periods):
    """Maximal stretches of each period; the least period of a stretch counts."""
    found, n = {}, len(words)
    for q in range(1, n // min_periods + 1):
        start = 0
        while start + q < n:
            stop = start
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            length = stop - start + q
            if length >= max(min_length, min_periods * q):
                found.setdefault((start, length), q)
            start = max(stop, start) + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(by_definition(words, 24, 3), key=lambda r: (r[0], r[2]))
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_the_definition(seed):
    rng = random.Random(seed)
    for _ in range(120):
        size, words = rng.randint(0, 90), []
        while len(words) < size:
            stretch = [rng.randint(0, rng.choice([1, 2, 5])) for _ in range(rng.randint(1, 9))]
            words += stretch * rng.randint(1, 8)
        words = words[:size]
        least, periods = rng.choice([(2, 2), (6, 2), (9, 3), (24, 3)])
        got = runs.runs_of(np.array(words, np.int64), least, periods)
        assert sorted(map(tuple, got.tolist())) == by_definition(words, least, periods), words


def test_repeats_tell_apart_what_can_have_runs():
    assert runs.repeated(24, 3) == 16
    rng = random.Random(9)
    for _ in range(300):
        words = [str(rng.randint(0, 3)) for _ in range(rng.randint(0, 20))] + ["x y z"[: rng.choice([1, 3, 5])]] * rng.randint(0, 30)
        text = " ".join(words)
        (_, got, _), *_ = runs.periodic([text.encode(), b"", text.encode()])
        assert sorted(map(tuple, got.tolist())) == by_definition(text.split(), 24, 3)


def test_query_columns(spark, tmp_path):
    rng = random.Random(4)
    rows = []
    for k in range(400):
        words = [rng.choice("ab cé dİ   e f ga".split(" ")) or "q" for _ in range(rng.choice([0, 1, 5, 40, 90, 200]))]
        sep = rng.choice([" ", "\n", "\t ", "\x0b", "\x0c"])
        text = sep.join(words)
        if k % 7 == 0:
            stretch = sep.join(words[:5])
            text = sep.join([text, *[stretch] * rng.randint(4, 30), "end"])
        rows.append((k, text))
    rows += [(None, "a b " * 40), (None, None), (10, None), (10, ""), (10, " \t"), (3, rows[3][1]), (12, "x\x1cy\x85z " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")).withColumn("lang", F.lit("en"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = runs.op11_periodic_runs(spark, str(tmp_path)).collect()
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)


def test_operator_keeps_columns_and_texts(spark):
    docs = spark.createDataFrame([(1, "begin " + "la la do " * 12 + "end", "x"), (2, None, "y")], "doc_id long, text string, words string")
    got = {r.doc_id: r for r in runs.with_runs(docs).collect()}
    assert got[1].collapsed == "begin la la do end" and [tuple(r) for r in got[1].runs] == [(1, 36, 3)] and got[1].words == 38
    assert got[2].collapsed == "" and got[2].runs == [] and got[2].words == 0
    assert runs.with_runs(docs.limit(0)).count() == 0


def test_a_long_text_is_read_whole():
    words = [b"w%d" % (k % 7000) for k in range(60_000)] + [b"tail"] * 500
    (n, got, short), = runs.periodic([b" ".join(words)])
    assert n == 60_500 and got.tolist() == [[0, 60_000, 7000], [60_000, 500, 1]]
    assert len(short.split()) == 7001
