"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from podium.llm import conversations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def expected(rows):
    original = {}
    for c, turn, role, text in rows:
        if c is not None:
            original.setdefault(c, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    for held in original.values():  # equal turns only repeat the same row in these tests
        held.sort()
    original = {c: [x for _, x in held] for c, held in original.items()}
    rebuilt = {}
    for c, held in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(original.get(c - c % 20, [])[:h] + held[h:])
    members, kids = {}, {}
    for c, held in rebuilt.items():
        for d in range(len(held) + 1):
            members.setdefault(held[:d], []).append(c)
            if d:
                kids.setdefault(held[: d - 1], set()).add(held[:d])

    def below(node):
        todo, found = [node], []
        while todo:
            found.append(todo.pop())
            todo += kids.get(found[-1], ())
        return found

    out = []
    for node, held in members.items():
        tree = below(node)
        ends = sorted(c for c in held if rebuilt[c] == node)
        out.append((
            min(held), len(node), min(members[node[:-1]]) if node else None, len(held), len(kids.get(node, ())), sum(x not in kids for x in tree),
            sum((len(members[x]) - 1) * len(WORD.findall(x[-1][1])) for x in tree if x), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 7])):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["hi", "a b\tc", "", None, "é\x1cü ", "x y"])))
    copied = [("user", "hi"), ("assistant", "there you are"), ("user", "so long")]
    rows += [(1000 + c, t, *copied[t]) for c in range(n) for t in range(3)]
    rows += [(5000, t, "user", f"turn {t // 2}") for t in range(60)] + [(5020, t, "user", f"turn {t // 2}") for t in range(50)]
    rows += [(7001, None, "user", "early"), (7001, 0, "user", "late"), (None, 0, "user", "nobody"), (6041, 0, "user", "short")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_query_equals_the_dictionary(spark, tmp_path, seed):
    rows = sample(seed, 120)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = conversations.op13_prefix_trie(spark, str(tmp_path))
    assert tuple(got.columns) == COLUMNS
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[1], r[3])) == expected(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sql_equals_the_dictionary(seed):
    rows = sample(seed, 120)
    duck = duckdb.connect()
    duck.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    duck.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    found = duck.execute(conversations.PREFIX_TRIE_SQL)
    assert tuple(c[0] for c in found.description) == COLUMNS
    assert sorted(found.fetchall(), key=lambda r: (r[0], r[1], r[3])) == expected(rows)


def test_hot_first_turns_and_copies(spark, tmp_path):
    """So many rows that hot nodes are told from the others."""
    rows = [(c, t, "user", "same" if c % 3 or t == 0 else f"{c} {t}") for c in range(9000) for t in range(1 + c % 8 * 2)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = conversations.op13_prefix_trie(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[1], r[3])) == expected(rows)


def test_intervals_nest(spark):
    rows = spark.createDataFrame([(c, t + 1, f"{c % (2 + t)}", 1) for c in range(60) for t in range(c % 5)], "conv_id long, n long, code string, words long")
    nodes = conversations.trie(rows, spark.range(60).withColumnRenamed("id", "conv_id")).collect()
    assert sorted(n["rank"] for n in nodes) == list(range(len(nodes)))
    at = {n.node: n for n in nodes}
    for n in nodes:
        inside = [m for m in nodes if n["rank"] <= m["rank"] < n.stop]
        def climbs(m):
            while m is not None and m.node != n.node:
                m = at.get(m.parent)
            return m is not None
        assert [climbs(m) for m in nodes] == [m in inside for m in nodes]


def test_empty_and_turnless(spark):
    rows = spark.createDataFrame([], "conv_id long, n long, code string, words long")
    assert conversations.trie(rows, spark.range(0).withColumnRenamed("id", "conv_id")).count() == 0
    (root,) = conversations.trie(rows, spark.range(3).withColumnRenamed("id", "conv_id")).collect()
    assert (root.depth, root.n_convs, root.n_leaves, root.saved_tokens) == (0, 3, 1, 0)
    assert root.ends_sha256 == hashlib.sha256(b"0,1,2").hexdigest()
