"""The tries of near_copies return links in proportion to a block's members, whatever the number of similar pairs."""

import random
from fractions import Fraction

import numpy as np
from podium.llm import near_copies, simhash


def test_a_block_of_alike_texts_makes_fewer_rows_than_members(spark):
    rng = random.Random(3)
    base = ["w%d" % rng.randrange(5000) for _ in range(400)]
    rows = []
    for k in range(60):
        words = list(base)
        words[rng.randrange(400)] = "v%d" % k
        values = near_copies.shingles(" ".join(words).encode())
        rows.append((1, 1000 + k, len(values), int(np.uint64(simhash.majority(values)).view(np.int64)), 1000 + k, 2, [int(x) for x in values.view(np.int64)]))
    members = spark.createDataFrame(rows, "key long, node long, n int, fp long, root long, parts int, whole array<long>")
    links = [tuple(r) for r in near_copies._trie_pairs(members, Fraction(4, 5)).collect()]
    linked = {1000}
    for _ in rows:
        linked |= {x for pair in links if linked & set(pair) for x in pair}
    assert linked == {1000 + k for k in range(60)}
    assert len(links) < 3 * 60  # three meetings of two parts; all pairs are 1770


def test_linking_equals_all_pairs():
    rng = np.random.default_rng(6)
    for _ in range(20):
        sets = [[np.unique(rng.integers(0, 12, rng.integers(1, 12))) for _ in range(n)] for n in (9, 7)]
        roots = rng.integers(0, 5, 9), rng.integers(0, 5, 7)
        i, j = (x.ravel() for x in np.mgrid[0:9, 0:7])
        alike = [(a, b) for a, b in zip(i, j) if 9 * len(np.intersect1d(sets[0][a], sets[1][b])) >= 4 * (len(sets[0][a]) + len(sets[1][b]))]

        def groups(pairs):
            label = list(range(5))
            for a, b in pairs:
                old, new = label[roots[0][a]], label[roots[1][b]]
                label = [new if x == old else x for x in label]
            return {frozenset(k for k in range(5) if label[k] == x) for x in label}

        got = list(zip(*near_copies._linking(i, j, sets, roots, Fraction(4, 5))))
        assert set(got) <= set(alike) and groups(got) == groups(alike) and len(got) < 5
