"""Names alike against all pairs, the cascade's reasons, evidence by position."""

import collections
import itertools
import random
import re

from pyspark.sql import functions as F

from podium.functions import evidence, names as name_functions
from podium.operators import identity


def sets(spark, rows):
    return spark.createDataFrame(rows, "block string, sig string, tokens array<string>")


def test_similar_token_sets_equal_all_pairs(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(14)]

    def side():
        out = {}
        for _ in range(300):
            tokens = tuple(sorted({"common", *rng.sample(words, rng.randint(2, 9))}))
            out[rng.choice("ab"), " ".join(tokens)] = list(tokens)
        return [(b, s, t) for (b, s), t in out.items()]

    left, right = side(), side()
    got = {tuple(r[:4]) for r in identity.similar_token_sets(sets(spark, left), sets(spark, right)).collect()}
    want = set()
    for b, s, t in left:
        for c, u, v in right:
            shared = len(set(t) & set(v))
            if b == c and s != u and shared >= 3 and 2 * shared / (len(t) + len(v)) >= 0.82:
                want.add((b, s, u, shared))
    assert got == want and len(want) > 50


def test_a_word_in_every_name_is_not_met(spark):
    """Joined rows stay in proportion to the names."""
    rows = [("b", f"institute n{k} of{k} x{k}", ["institute", f"n{k}", f"of{k}", f"x{k}"]) for k in range(3000)]
    other = [("b", s.replace("x", "y"), t[:3] + [t[3].replace("x", "y")]) for _, s, t in rows]
    pairs = identity.similar_token_sets(sets(spark, rows), sets(spark, other))
    assert pairs.count() == 0  # three of four shared: 0.75
    # each shows its two rarest words, so the common one is met by nobody
    assert spark.range(1).select(identity._prefix(F.lit(4))).first()[0] == 2


def test_classes_of_names(spark):
    right = [("b", 1, "University of Old Stone Bridge", "official"), ("b", 2, "Stone Bridge College Old", "alias"), ("b", 3, "OSB", "acronym"), ("b", 4, "Éamon Née Institute", "official"), ("b", 4, "old stone bridge university", "official")]
    left = [("b", "osb"), ("b", "eamon nee institute"), ("b", "Old Bridge Stone"), ("c", "OSB"), ("b", None), ("b", "stone bridge college old")]
    got = {(r.key, r.record): r.score for r in identity.name_scores(
        spark.createDataFrame(left, "block string, name string"), spark.createDataFrame(right, "block string, record long, name string, kind string")).collect()}
    assert got[("osb", 3)] == 80 and got[("eamon nee institute", 4)] == 100 and got[("stone bridge college old", 2)] == 90
    assert got[("old bridge stone", 1)] == 80 and got[("old bridge stone", 4)] == 80
    assert len(identity.leaders(identity.name_scores(
        spark.createDataFrame([("b", "Old Bridge Stone")], "block string, name string"), spark.createDataFrame(right, "block string, record long, name string, kind string"))).collect()) == 0


def resolve(spark, seeds, records, names, affiliations=(), other_names=(), claims=()):
    out = identity.resolved(
        spark.createDataFrame(seeds, "seed long, name string, country string, direct long"),
        spark.createDataFrame(records, "record long, active boolean, countries array<string>, other string"),
        spark.createDataFrame(names, "record long, name string, kind string"),
        spark.createDataFrame(list(affiliations), "seed long, record long, place int, chosen boolean"),
        spark.createDataFrame(list(other_names), "other string, name string, kind string"),
        spark.createDataFrame(list(claims), "other string, record long"),
    )
    return {r.seed: r for r in out.collect()}


def test_cascade_and_reasons(spark):
    records = [(1, True, ["FR"], "Q1"), (2, True, ["DE"], "Q2"), (3, False, ["DE"], None), (4, True, ["DE"], "Q9"), (5, True, ["GF"], None)]
    names = [(1, "Alpha Beta Gamma", "official"), (2, "Delta Epsilon Zeta", "official"), (3, "Eta Theta Iota", "official"), (5, "Guiana North Campus", "official")]
    seeds = [
        (10, "x", "FR", 1), (11, "x", "DE", 1), (12, "x", None, 99), (20, "nobody knows", "DE", None), (21, "alpha beta gamma", None, None), (22, "gamma alpha beta", None, None),
        (30, "Delta Epsilon Zeta", "DE", None), (31, "Guiana North Campus", "FR", None), (40, "Other Known Name", "DE", None), (41, "Several Claimed Name", "DE", None),
        (42, "Inactive Linked Name", "DE", None), (43, "Disagreeing Linked Name", "DE", None), (44, "Abroad Linked Name", "DE", None), (50, None, "DE", None), (10, "x", "FR", 1),
    ]
    other_names = [("Q2", "Other Known Name", "official"), ("Q5", "Several Claimed Name", "official"), ("Q6", "Inactive Linked Name", "official"), ("Q7", "Disagreeing Linked Name", "official"), ("Q1", "Abroad Linked Name", "official")]
    claims = [("Q2", 2), ("Q5", 1), ("Q5", 2), ("Q6", 3), ("Q7", 4), ("Q1", 1), ("Q2", 2)]
    got = resolve(spark, seeds, records, names, [(20, 2, 0, True), (20, 4, 1, True), (30, 1, 0, True), (31, 2, 0, False)], other_names, claims)
    assert {s: (r.record, r.method) for s, r in got.items() if r.method} == {10: (1, "direct"), 20: (2, "affiliation"), 21: (1, "query"), 30: (2, "query"), 31: (5, "query"), 40: (2, "cross")}
    assert got[40].other == "Q2" and [tuple(x) for x in got[30].rejected] == [("affiliation", 1, "outside the country")]
    assert {s: r.failure for s, r in got.items() if r.failure} == {
        11: "outside the country", 12: "unknown id", 22: "no exact match anywhere", 41: "no unambiguous match in the country", 42: "cross: not active",
        43: "cross: ids disagree", 44: "cross: outside the country", 50: "no unambiguous match in the country",
    }
    assert [x.reason for x in got[41].rejected] == ["several claims"]


def test_nothing_from_nothing(spark):
    assert resolve(spark, [], [], []) == {}
    assert resolve(spark, [(1, "a b c", "FR", None)], [], [])[1].failure == "no unambiguous match in the country"


def plain_score(text, year, names, parts):
    """The rule in plain words."""
    best, place = 0, text.find(year)
    part = re.compile(rf"\b(?:{'|'.join(parts)})\b")
    while place >= 0:
        context = " " + text[max(0, place - 220) : place]
        at = max(context.rfind(f" {t} ") for t in evidence.TRIGGERS)
        if at >= 0:
            subject = context[max(0, at - 150) : at]
            for name in names:
                k = subject.rfind(name)
                if len(name) >= 8 and k >= 0 and not part.search(subject[:k] + " " + subject[k + len(name) :]):
                    best = max(best, 80)
            if not part.search(subject) and re.search(r"\b(?:our|the|this) (?:institution|university)\b", subject):
                best = max(best, 55)
        place = text.find(year, place + len(year))
    return best


def test_founding_score_equals_the_rule(spark):
    rng = random.Random(6)
    names = ["northern stone university", "stone north", "nsu"]
    bits = [*evidence.TRIGGERS, *names, "1871", "18711871", "school", "schools", "our university", "the institution", "of", "a" * 40, "b" * 90]
    texts = [" ".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(800)]
    df = spark.createDataFrame([(t, names) for t in texts], "text string, names array<string>")
    got = [r[0] for r in df.select(evidence.founding_score(F.col("text"), F.lit("1871"), F.col("names"), F.lit("text"))).collect()]
    want = [plain_score(t, "1871", names, evidence.PARTS) for t in texts]
    assert got == want and {0, 55, 80} == set(want)
    odd = spark.createDataFrame([(None, None, "text"), ("", [], "text"), ("x", None, "normalised"), (None, [], "structured")], "text string, names array<string>, method string")
    assert [r[0] for r in odd.select(evidence.founding_score(F.col("text"), F.lit("1871"), F.col("names"), F.col("method"))).collect()] == [0, 0, 140, 110]


def test_mentions_are_whole_words(spark):
    texts = spark.createDataFrame([(1, "The Old Stone, and more"), (2, "bold stones"), (3, None), (4, "old  STONE")], "text_id long, text string")
    names = spark.createDataFrame([(7, "Old Stone"), (8, "stone"), (9, ""), (9, None), (7, "old stone")], "entity long, name string")
    assert sorted(tuple(r) for r in identity.mentions(texts, names).collect()) == [(1, 7, "old stone"), (1, 8, "stone"), (4, 7, "old stone"), (4, 8, "stone")]


def test_longest_words_equal_the_rule(spark):
    rng = random.Random(8)
    bits = ["a", "Bb", "bB", "ccc", "Stone", "stonE", "É", "naïve", "\u212a", "\u0130x", "12", "_", " ", " ", "\n", "abcdefghijklmno", "Zbcdefghijkl", "bcdefghij"]
    texts = [None, "", "É 12", *("".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(400))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [list(r[0]) for r in df.select(name_functions.longest_words(F.col("text"), 6)).collect()]
    assert got == [sorted({w.lower() for w in re.findall("[A-Za-z]+", t or "")}, key=lambda w: (-len(w), w))[:6] for t in texts]


def all_pairs(left, right):
    """The rule in plain words."""
    out = set()
    for b, s, t in left:
        for c, u, v in right:
            shared = len(set(t) & set(v))
            if b == c and s != u and shared >= 3 and 2 * shared / (len(t) + len(v)) >= 0.82:
                out.add((b, s, u, shared))
    return out


def test_sets_of_often_tokens_equal_all_pairs(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(16)]

    def side():
        found = {tuple(sorted(rng.sample(words, min(16, int(rng.paretovariate(1)) + 2)) + [f"r{rng.randint(0, 40)}"] * rng.randint(0, 1))) for _ in range(260)}
        return [(rng.choice("ab"), " ".join(t), list(t)) for t in sorted(found)]

    left, right = side(), side()
    want = all_pairs(left, right)
    assert len(want) > 50 and max(len(t) for _, _, t in left) > 10
    for often, long in ((10, 16), (10, 7), (0, 16), (0, 4), (10**9, 16)):  # also sets on either side of LONG
        monkeypatch.setattr(identity, "OFTEN", often)
        monkeypatch.setattr(identity, "LONG", long)
        got = [tuple(r[:4]) for r in identity.similar_token_sets(sets(spark, left), sets(spark, right)).collect()]
        assert sorted(got) == sorted(want)  # each once


def test_sets_of_often_tokens_do_not_all_meet(spark):
    """Each token stands in a fifth of the sets; by single tokens some five million rows would meet."""
    rows = [("b", " ".join(t), list(t)) for t in itertools.combinations([f"w{k:02}" for k in range(20)], 4)]
    assert identity._met(sets(spark, rows), sets(spark, rows)).count() == sum(n * n for n in collections.Counter(tuple(t[:3]) for _, _, t in rows).values()) < 50_000
