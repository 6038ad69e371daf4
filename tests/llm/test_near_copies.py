import random

import numpy as np
import pytest
from podium.llm import common, near_copies, simhash
from pyspark.sql import functions as F


def grams(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(data):
    sets = [grams(t) for _, t in data]
    group = list(range(len(data)))
    for i, x in enumerate(sets):
        for j in range(i):
            if group[i] != group[j] and 9 * len(x & sets[j]) >= 4 * (len(x) + len(sets[j])):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [min(d for (d, _), g in zip(data, group) if g == group[i]) for i in range(len(data))]


def texts():
    rng = random.Random(8)
    words = ["w%d" % i for i in range(500)]
    line = " ".join(rng.choice(words) for _ in range(12))
    out = [None, "", " \n", "a", "A", "one two three", "one two  three", "one two three four five six"]
    for n in (6, 9, 14, 40, 40, 200, 200, 600):
        base = [rng.choice(words) for _ in range(n)] + line.split() * (n > 30)
        for changes in range(1 + n // 10):
            for _ in range(2):
                copy = list(base)
                for at in rng.sample(range(n), min(n, changes)):
                    copy[at] = rng.choice(words)
                out.append(" ".join(copy))
        out.append(" ".join(base[: n * 5 // 6]))
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_groups_match_brute_force(spark, monkeypatch, block):
    data = [(i * 7 % 1009, t) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    want = sorted(zip([d for d, _ in data], brute_groups(data)))
    monkeypatch.setattr(near_copies, "BLOCK_ROWS", block)  # blocks in parts
    assert sorted(tuple(r) for r in near_copies.groups(docs).collect()) == want


def test_copies_beyond_the_query_bits_go(spark):
    rng = random.Random(2)
    base = ["w%d" % rng.randrange(3000) for _ in range(300)]
    edited = list(base)
    for at in (20, 90, 160, 230, 290):
        edited[at] = "other"
    base, edited = " ".join(base), " ".join(edited)
    assert (simhash.fingerprint(base.encode()) ^ simhash.fingerprint(edited.encode())).bit_count() > simhash.MAX_BITS
    docs = spark.createDataFrame([(5, base), (3, edited), (None, base), (9, "plain words of another kind stand here")], "doc_id long, text string")
    assert sorted(str(r.doc_id) for r in near_copies.one_per_group(docs).collect()) == ["3", "9"]


def test_rows_without_or_with_the_same_id(spark):
    long = "some words of a text that stands here " * 3
    rows = [(None, long, 1), (None, long, 2), (4, "x", 1), (4, "x", 1), (4, "another text", 3), (7, None, 1), (8, "", 2), (None, "alone here", 1), (6, "ALONE  here", 1)]
    docs = spark.createDataFrame([(d, t, n, "clash") for d, t, n in rows], "doc_id long, text string, n int, node string")
    out = near_copies.one_per_group(docs)
    assert out.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in out.collect()) == sorted(map(str, [(None, long), (4, "x"), (4, "another text"), (7, None), (6, "ALONE  here")]))
    assert near_copies.one_per_group(docs.where("false")).count() == 0


def test_hot_keys_meet_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_TOTAL", 1000)
    rows = spark.range(5000).select("id", F.when(F.col("id") < 2500, F.lit(7)).otherwise(F.col("id")).cast("long").alias("key"))
    lookup = spark.range(4000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    got = common.looked_up(rows, lookup, "key")
    assert "BroadcastHashJoin" in got._jdf.queryExecution().toString()
    assert sorted(tuple(r) for r in got.collect()) == sorted((7 if i < 2500 else i, i, 14 if i < 2500 else 2 * i) for i in range(4000))


def test_trie_pairs_of_different_groups():
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    values = np.sort(np.concatenate([seeds, seeds, *[seeds ^ (np.uint64(1) << rng.integers(0, 64, 30, dtype=np.uint64)) for _ in range(6)]]))
    groups = rng.integers(0, 4, len(values))
    for budget in (0, 2, 18):
        i, j = simhash._pairs_within(values, values, True, 64, budget, (groups, groups))
        want = {(a, b) for a in range(len(values)) for b in range(a + 1, len(values)) if groups[a] != groups[b] and (int(values[a]) ^ int(values[b])).bit_count() <= budget}
        assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)
    one = np.zeros(len(values), int)
    assert len(simhash._pairs_within(values, values, True, 64, 18, (one, one))[0]) == 0


def test_variants_of_one_text_meet_at_it(spark, monkeypatch):
    """Each is alike to the text they were made from, few are alike to each other: the text leads them, so few pairs are left for the tries."""
    rng = random.Random(31)
    base = ["w%d" % rng.randrange(5000) for _ in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 80):
        words = list(base)
        for at in rng.sample(range(300), 6):
            words[at] = "v%d" % rng.randrange(10**6)
        rows.append((i, " ".join(words)))
    counts, plain = [], near_copies._trie_pairs
    monkeypatch.setattr(near_copies, "_trie_pairs", lambda members, similarity: counts.append(members.count()) or plain(members, similarity))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(tuple(r) for r in near_copies.groups(docs).collect())
    assert found == sorted(zip([d for d, _ in rows], brute_groups(rows))) and {c for _, c in found} == {0}
    assert counts[0] < 80
