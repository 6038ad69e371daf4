import random

import pytest
from pyspark.sql import functions as F

from podium.operators import fact_store, matching, merging
from podium.operators import relational as R


def collected(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_rank_ties(spark):
    df = spark.createDataFrame([("a", 100), ("a", 100), ("a", 50), ("b", 999), ("b", None)], "g string, p int")
    assert collected(df.select("g", "p", R.rank_min(F.col("p"), ["g"]).alias("r")), "g", "p", "r") == sorted([("a", 100, 1), ("a", 100, 1), ("a", 50, 3), ("b", 999, 1), ("b", None, None)], key=str)
    assert collected(df.select("g", R.rank_average(F.col("p"), ["g"], True).alias("r")), "g", "r") == sorted([("a", 1.5), ("a", 1.5), ("a", 3.0), ("b", 1.0), ("b", None)], key=str)


def test_first_last_mode(spark):
    df = spark.createDataFrame([("k", "x", 1), ("k", "y", 2), ("k", "y", 3), ("k", "x", 4), ("l", "z", 5)], "k string, v string, o int")
    assert collected(R.pick(df, ["k"], F.col("o"), ["v"]), "k", "v") == [("k", "x"), ("l", "z")]
    assert collected(R.pick(df, ["k"], F.col("o"), ["v"], last=True), "k", "v") == [("k", "x"), ("l", "z")]
    assert collected(R.first_wins(df, ["k"], ["o"]), "k", "o") == [("k", 1), ("l", 5)]
    assert collected(R.mode_first_seen(df, ["k"], "v", "o"), "k", "mode", "n") == [("k", "x", 2), ("l", "z", 1)]


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_numbered_is_a_global_row_number(spark, buckets):
    rng = random.Random(buckets)
    rows = [(i, rng.choice([None, 1.0, 2.0, rng.random() * 10])) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, v double").repartition(5)
    got = {r.i: r.position for r in R.numbered(df, "v", ["i"], buckets=buckets).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [got[i] for i, _ in want] == list(range(1, 501))


def test_quantiles_concentration_grid(spark):
    values = [5, 1, 9, 3, 7, 7, 2]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    s = sorted(values)
    assert sorted(r.cut for r in R.quantile_cuts(df, "v", 4).collect()) == sorted({float(s[int(6 * i / 4 + 0.5)]) for i in (1, 2, 3)})
    counts = spark.createDataFrame([(1, "a", 3), (1, "b", 1)], "y int, c string, n int")
    assert collected(R.concentration(counts, ["y"], "n"), "y", "total", "hhi") == [(1, 4, 0.625)]
    grid = R.zero_filled(counts.select("y", "c", "n"), spark.createDataFrame([(1,), (2,)], "y int"), spark.createDataFrame([("a",)], "c string"), ["n"])
    assert collected(grid, "y", "c", "n") == [(1, "a", 3), (2, "a", 0)]


def test_spearman_and_sequences(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, 20.0), (3.0, 30.0), (4.0, None)], "x double, y double")
    assert R.spearman(df, "x", "y").first()["spearman"] == pytest.approx(1.0)
    seq = spark.createDataFrame([("p", 1, 1), ("p", 2, 3), ("p", 3, 2)], "g string, o int, r int")
    assert collected(seq.withColumn("bad", R.falls_back("r", ["g"], ["o"])).where("bad"), "o") == [(3,)]
    ranks = spark.createDataFrame([("g", 1), ("g", 1), ("g", 3), ("g", 5)], "g string, r int")
    assert collected(R.rank_gaps(ranks, ["g"], "r"), "r", "expected") == [(5, 4)]
    nth = spark.createDataFrame([("g", i) for i in range(6)], "g string, o int")
    assert collected(R.every_nth(nth, ["g"], ["o"], 4), "o") == [(0,), (4,), (5,)]
    seg = spark.createDataFrame([("g", 0, False), ("g", 1, True), ("g", 2, False), ("g", 3, True)], "g string, o int, f boolean")
    assert collected(seg.withColumn("s", R.segments(F.col("f"), ["g"], ["o"])), "o", "s") == [(0, 0), (1, 1), (2, 1), (3, 2)]


def test_pages_clamp(spark):
    df = spark.range(45)
    assert [r.id for r in R.page(df, ["id"], 20, 9).collect()] == list(range(40, 45))
    assert R.page(df.where("false"), ["id"], 20, 1).count() == 0


def test_matching(spark):
    left = spark.createDataFrame([(1, "The University of North Harbor Technology", "X"), (2, "Ambiguous State College", "X"), (3, "Nowhere", "Y")], "id int, name string, c string")
    right = spark.createDataFrame([(10, "North Harbor Technology University", "X"), (11, "Ambiguous State College", "X"), (12, "Ambiguous State College", "X"), (13, "Nowhere", "X")], "id int, name string, c string")
    best = matching.best_matches(matching.scored_pairs(left, right, ["c"]))
    assert collected(best, "left_id", "right_id", "score") == [(1, 10, 80.0)]
    named = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 3)], "n string, k int")
    assert collected(matching.unique_names(named, "n", "k"), "n", "k") == [("b", 3)]
    domains = spark.createDataFrame([("e", "x.org", "registry"), ("e", "y.org", "p"), ("e", "z.org", "p"), ("e", "z.org", "q")], "entity string, domain string, provider string")
    assert collected(matching.agreed_domains(domains), "domain") == [("x.org",), ("z.org",)]


CASES = {
    "single": ([(0, 1900, 10)], (1900, "high", "official")),
    "agreed": ([(0, 1900, 10), (1, 1900, 0)], (1900, "high", "official")),
    "differs": ([(0, 1900, 10), (1, 1950, 0)], (1900, "medium", "official-registry-differs")),
    "corroborated": ([(0, 1900, 90), (0, 1950, 10), (1, 1950, 0)], (1950, "high", "corroborated")),
    "strongest": ([(0, 1900, 90), (0, 1950, 60)], (1900, "medium", "strongest")),
    "registry": ([(0, 1900, 60), (0, 1950, 50), (1, 1960, 0)], (1960, "low", "registry")),
    "best": ([(0, 1900, 60), (0, 1950, 50)], (1900, "low", "best-of-several")),
    "only": ([(1, 1950, 0)], (1950, "medium", "registry-only")),
    "none": ([(1, 1950, 0), (1, 1951, 0)], None),
}


def test_canonical_decisions(spark):
    rows = [(name, "founded", "f", v, p, s) for name, (obs, _) in CASES.items() for p, v, s in obs]
    df = spark.createDataFrame(rows, "entity string, metric string, frame string, value int, priority int, score int")
    got = {r.entity: (r.value, r.confidence, r.reason) for r in fact_store.select_canonical(df).collect()}
    assert got == {name: want for name, (_, want) in CASES.items() if want}
    marked = fact_store.mark_conflicts(df)
    assert {r.entity for r in marked.where("conflicting").collect()} == {n for n, (o, _) in CASES.items() if len({v for _, v, _ in o}) > 1}
    cover = fact_store.coverage(spark.createDataFrame([("founded",), ("other",)], "metric string"), df, fact_store.select_canonical(df))
    assert collected(cover, "metric", "entities", "canonical") == [("founded", 9, 8), ("other", 0, 0)]


def test_violations(spark):
    a = spark.createDataFrame([(1, 5), (1, 6), (2, None)], "id int, parent int")
    p = spark.createDataFrame([(5,)], "id int")
    out = fact_store.violations({"repeated": fact_store.repeated_keys(a, ["id"]), "orphan": fact_store.orphans(a, p, "parent", "id")})
    assert collected(out, "check", "bad_rows") == [("orphan", 1), ("repeated", 1)]


@pytest.mark.parametrize("ranges", [2, 7, None])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks_by_ranges_equal_plain_ones(spark, ranges, descending):
    rows = [(None if i % 11 == 0 else "ab"[i % 2], None if i % 7 == 0 else i * i % 23, i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    for average, plain in ((False, R.rank_min), (True, R.rank_average)):
        got = R.range_ranked(df, ["k"], "v", "r", descending, average, ranges)
        want = df.withColumn("r", plain(F.col("v"), ["k"], descending))
        assert collected(got, "i", "r") == collected(want, "i", "r")
        assert collected(R.range_ranked(df, [], "v", "r", descending, average, ranges), "i", "r") == collected(df.withColumn("r", plain(F.col("v"), [], descending)), "i", "r")
    assert R.range_ranked(df.where("false"), ["k"], "v").count() == 0


def test_merges(spark):
    left = spark.createDataFrame([(1, "a", None), (2, None, 5), (3, "c", 7)], "id int, x string, y int")
    right = spark.createDataFrame([(1, "z", 9), (2, "b", 8)], "id int, x string, y int")
    assert collected(merging.merged(left, right, ["id"]), "id", "x", "y") == sorted([(1, "a", 9), (2, "b", 5), (3, "c", 7)], key=str)
    assert collected(merging.unique_left_join(left.select("id"), right, ["id"]), "id", "x") == sorted([(1, "z"), (2, "b"), (3, None)], key=str)
    with pytest.raises(Exception, match="repeated key"):
        merging.unique_left_join(left.select("id"), right.union(right), ["id"]).collect()
    with pytest.raises(Exception, match="ids differ"):
        merging.consistent_left_join(left, right.select("id", F.col("x").alias("other")), ["id"], "x", "other").collect()
    rows = spark.createDataFrame([(1, 3, "c", ["p"]), (1, 1, None, ["q", "r"]), (1, 2, "b", None), (1, 4, "d", ["r", "s"])], "id int, at int, v string, l array<string>")
    got = rows.groupBy("id").agg(merging.first_present(F.col("v"), F.col("at")).alias("v"), merging.united(F.col("l"), F.col("at"), 3).alias("l"), merging.longest(F.col("v")).alias("n")).first()
    assert (got.v, got.l, got.n) == ("b", ["q", "r", "p"], "d")


def test_identities(spark):
    seeds = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "D")], "seed int, expected string")
    candidates = spark.createDataFrame([(1, 10, 2, "A"), (1, 11, 1, "X"), (1, 12, 4, "A"), (2, 20, 4, "B"), (2, 21, 4, "B"), (3, 30, 4, "C")], "seed int, record int, priority int, found string")
    got = {r.seed: (r.record, r.failure is None) for r in matching.identities(seeds, candidates, F.col("expected") == F.col("found"), 4).collect()}
    assert got == {1: (10, True), 2: (None, False), 3: (30, True), 4: (None, False)}
