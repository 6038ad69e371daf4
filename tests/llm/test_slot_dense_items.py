import random
import re

from podium.llm import decontaminate

ITEM = "Alice ran 3 km, Bob ran 4 km, Carol ran 5 km"
LONG = "on Monday Alice Miller, Bob Smith, Carol Jones, Dan Brown and 17 Friends paid 3 4 5 6 7 8 euros each to Paul"


def test_slot_dense_items(spark):
    bench = spark.createDataFrame([(1, ITEM), (2, LONG), (3, "1 2 3 4 5 6 7 8")], "item_id long, text string")
    again = ITEM.replace("Alice", "Kim").replace("Bob", "Max").replace("Carol", "Lea").replace("3", "12").replace("4", "9").replace("5", "31")
    other = LONG.replace("Alice Miller", "Eve Stone").replace("Dan", "Tim").replace("17", "90").replace("3 4 5", "33 44 55").replace("Paul", "Rita")
    rows = [
        (10, f"he said: {again}. So it was"), (11, ITEM), (12, f"2 Words Before {other} 5 6 After"), (13, LONG),
        (14, "Kim ran 12 km, Kim walked 9 km, Lea swam 31 km"), (15, "9 9 9 9 7 7 7 7 7 7"), (16, "Kim ran 12 km"),
        (17, "Ann " * 3000), (18, again.upper()), (19, again.replace("Kim", "Max").replace("ran 9", "ran 12")), (20, "1 2 3 4 5 6 7 8"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, bench).collect()}
    assert {(10, 1), (11, 1), (12, 2), (13, 2), (20, 3)} <= set(got)
    assert not {d for d, _ in got} & {14, 15, 16, 17}
    assert got[11, 1].verbatim and got[13, 2].verbatim and not got[10, 1].verbatim and not got[12, 2].verbatim
    assert all(r.matched <= r.windows for r in got.values())


def test_shuffled_windows_carry_their_own_words_only(spark, monkeypatch):
    bench = spark.createDataFrame([(1, ITEM), (2, LONG), (3, "tiny item")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{LONG} and {ITEM}"), (2, "plain " * 500), (None, "a Tiny item here")], "doc_id long, text string")
    rows = decontaminate.narrow(decontaminate.places(docs, 9, [2])).collect()
    assert set(rows[0].asDict()) == {"doc_id", "of", "template", "hash", "at", "here"} and max(len(r.here) for r in rows) <= 9
    want = sorted(map(str, decontaminate.leaks(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 0)
    assert sorted(map(str, decontaminate.leaks(docs, bench).collect())) == want and len(want) == 3


def test_short_items_and_rows_that_share_an_id(spark):
    bench = spark.createDataFrame([(1, "zebra"), (2, "Wolf eats 3 kg"), (3, "one two three"), (4, ""), (5, None), (6, "...")], "item_id long, text string")
    rows = [
        (1, "a ZEBRA here"), (1, "one two three"), (1, "nothing at all"), (None, "one two three four"), (2, "Bear eats 7 kg of it"), (3, "Bear sees 7 kg of it"),
        (4, "two three"), (5, "wolf"), (5, "wolf"), (None, None),
    ]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, of int")
    got = sorted(str((r.doc_id, r.item_id)) for r in decontaminate.leaks(docs, bench).collect())
    assert got == sorted(map(str, [(1, 1), (1, 3), (None, 3), ]))
    left = decontaminate.without_leaks(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == sorted(map(str, [(1, "nothing at all"), (2, rows[4][1]), (3, rows[5][1]), (4, "two three"), (5, "wolf"), (5, "wolf"), (None, None)]))


WORD = re.compile(r"[0-9]+(?:[.,][0-9]+)*|[^\W\d_]+")


def brute(doc, item):
    """The share of the item's windows that some alignment covers, by comparing every pair of windows."""

    def told(text):
        words = WORD.findall(text or "")
        kinds = ["#" if w[0].isdigit() else "unit" if i and words[i - 1][0].isdigit() and w.lower() in decontaminate.UNITS else "Name" if w[0] != w[0].lower() else w.lower() for i, w in enumerate(words)]
        return words, kinds

    (a, x), (b, y) = told(doc), told(item)
    plain = lambda kinds: sum(k not in ("#", "unit", "Name") for k in kinds)
    n = len(b) - 4
    if n < 1:
        return 0
    spans = []
    for at in range(n):
        spans.append((at, at, 5, False))
        if plain(y[at : at + 5]) >= 2:
            spans.append((at, at, 5, True))
        else:
            for k in range(5, len(b) - at + 1):
                if plain(y[at : at + k]) >= 2:
                    spans.append((at, at, k, True))
                    break
            for k in range(5, at + 6):
                if plain(y[at + 5 - k : at + 5]) >= 2:
                    spans.append((at, at + 5 - k, k, True))
                    break
    found = {}
    for at, first, k, template in spans:
        for i in range(len(a) - k + 1):
            if (x[i : i + k] == y[first : first + k]) if template else [w.lower() for w in a[i : i + k]] == [w.lower() for w in b[first : first + k]]:
                found.setdefault(i - first, []).append((at, template, [(y[first + j], b[first + j], a[i + j]) for j in range(k) if template and y[first + j] in ("#", "unit", "Name")]))
    covered = set()
    for hits in found.values():
        slots = {s for _, _, told_ in hits for s in told_}
        consistent = len(slots) == len({s[:2] for s in slots})
        covered |= {at for at, template, _ in hits if consistent or not template}
    return len(covered) / n


def test_query_matches_brute_force(spark, tmp_path):
    rng = random.Random(12)
    atoms = ["runs", "the", "old", "to", "Ann", "Bob", "Eve", "3", "7", "km", "kg", "and", "mill", "12.5", "Carl"]
    make = lambda n: " ".join(rng.choice(atoms) for _ in range(n))
    items = [make(rng.randrange(5, 14)) for _ in range(25)]
    docs = []
    for i in range(120):
        item = rng.choice(items)
        swap = dict(zip(["Ann", "Bob", "Eve", "Carl", "3", "7"], rng.sample(["Zoe", "Max", "Tim", "Lea", "Ann", "9"], 6)))
        words = [swap.get(w, w) if i % 3 else w for w in item.split()]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = "changed"
        docs.append(f"{make(4)} {' '.join(words)} {make(5)}")
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontaminate.op8_benchmark_decontamination(spark, str(tmp_path)).collect()}
    want = {(d, i): round(s, 9) for d, doc in enumerate(docs) for i, item in enumerate(items) if (s := brute(doc, item)) >= 0.8}
    assert len(want) > 40 and got == want
