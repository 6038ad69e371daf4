"""Running values over many ranges, CSV by byte ranges, frontiers and constraints."""

import csv
import io
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from podium.operators import constraints, frontier, ordered
from podium.plans import scans
from podium.sources import csv_ranges


@pytest.fixture(scope="module", autouse=True)
def many_ranges(spark):
    """Small ranges stay apart, so that values are carried from range to range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def rows(spark):
    """A key with nearly all rows, a few small keys and none."""
    rng = random.Random(5)
    data = [(k, "hot" if k % 20 else rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3, 5])) for k in range(1500)]
    rng.shuffle(data)
    return data


def by_key(rows):
    held = {}
    for at, key, value in sorted(rows, key=lambda r: r[0]):
        held.setdefault(key, []).append((at, value))
    return held


def test_previous_segments_last_known_and_falls(spark, rows):
    df = spark.createDataFrame(rows, "at long, key string, value int").repartition(7)
    told = ordered.with_previous(df, ["key"], ["at"], "value", "before")
    told = ordered.with_segments(told, ["key"], ["at"], F.col("value") == 5, "segment")
    told = ordered.with_last_known(told, ["key"], ["at"], "value", "known")
    told = ordered.falls_back(told, ["key"], ["at"], "value")
    got = {r.at: (r.before, r.segment, r.known, r.falls) for r in ordered.with_numbers(told, ["key"], ["at"], "n").collect()}
    want = {}
    for held in by_key(rows).values():
        before = known = None
        segment = 0
        for at, value in held:
            segment += value == 5
            known = known if value is None else value
            want[at] = (before, segment, known, value is not None and before is not None and value < before)
            before = value
    assert got == want


def test_one_key_is_sorted_in_parts(spark, rows):
    df = spark.createDataFrame([Row(at=k, key="one") for k in range(5000)])
    placed = ordered.placed(df, ["key"], ["at"])
    sizes = [r["count"] for r in placed.groupBy("__part").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 4000
    assert [r.n for r in ordered.with_numbers(df, [], [F.desc("at")], "n").orderBy(F.desc("at")).collect()] == list(range(1, 5001))
    assert ordered.with_numbers(df.limit(0), ["key"], ["at"], "n").count() == 0


def test_intervals(spark):
    places = spark.createDataFrame([(k, k // 10, k % 10) for k in range(100)] + [(200, None, 3)], "id int, a int, b int")
    blocks = spark.createDataFrame([(0, 5, 1, 2, "x"), (1, 3, 1, 3, "y"), (5, 0, 8, 9, "z")], "la int, lb int, ha int, hb int, name string")
    got = {r.id: r.name for r in ordered.in_intervals(places, blocks, ["la", "lb"], ["ha", "hb"], ["a", "b"], "name").collect()}
    inside = lambda k: next((n for lo, hi, n in ((5, 12, "x"), (13, 13, "y"), (50, 89, "z")) if lo <= k <= hi), None)
    assert got == {k: inside(k) for k in range(100)} | {200: None}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_csv_by_byte_ranges_equals_the_reader(spark, tmp_path, seed):
    rng = random.Random(seed)
    bits = ["plain", "line\nbreak", 'quo"ted', "a,b", "\n\n", "é", "", "\r\nwin", "x" * 60, '"']
    files, want = 3, []
    for k in range(files):
        table = [["".join(rng.choices(bits, k=rng.randint(0, 4))) for _ in range(3)] for _ in range([150, rng.choice([0, 1]), 60][k])]
        table = [[c or "v" for c in r] for r in table]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"])).writerows([["a", "b", "c"], *table])
        (tmp_path / f"{k}.csv").write_bytes(out.getvalue().encode() if k < 2 else out.getvalue().rstrip("\r\n").encode())
        want += table
    (tmp_path / "empty.csv").write_bytes(b"")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        found = csv_ranges.read(spark, str(tmp_path), ["a", "b", "c"])
        assert csv_ranges.records(spark, str(tmp_path)).select("block").distinct().count() > 5
        got = [tuple(r) for r in found.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(got) == sorted(map(tuple, want))


def test_csv_record_over_many_ranges(spark, tmp_path):
    (tmp_path / "long.csv").write_text('a,b\n1,"' + "line of a long cell\n" * 200 + '"\n2,end\n3,"open\nfor ever', newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "250")
    try:
        got = sorted((r.a, r.b) for r in csv_ranges.read(spark, str(tmp_path), ["a", "b"]).where("b is not null").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got[0] == ("1", "line of a long cell\n" * 200) and got[1] == ("2", "end")


def plain_crawl(seeds, pages, links, budget, tries):
    """One entity after the other, the queue sorted again after every page."""
    out = []
    for entity in {e for e, _, _ in seeds}:
        scores, tried, read = {}, set(), []
        add = lambda url, score: scores.__setitem__(url, max(score, scores.get(url, score)))
        for e, url, score in seeds:
            if e == entity:
                add(url, score)
        attempt = 0
        while len(read) < budget and attempt < budget * tries:
            queue = sorted((u for u in scores if u not in tried), key=lambda u: (-scores[u], u))
            if not queue:
                break
            url, attempt = queue[0], attempt + 1
            tried.add(url)
            page = pages.get(url)
            fresh = page is not None and page not in read
            out.append((entity, url, page, attempt, len(read) + 1 if fresh else None))
            if fresh:
                read.append(page)
                for source, target, score in links:
                    if source == page:
                        add(target, score)
    return sorted(out, key=lambda r: (r[0], r[3]))


@pytest.mark.parametrize("seed", [1, 2])
def test_frontier_equals_a_queue(spark, seed):
    rng = random.Random(seed)
    urls = [f"u{k:02}" for k in range(25)]
    pages = {u: rng.choice([None, k, k, k - 1]) for k, u in enumerate(urls) if k % 6}
    links = [(rng.randrange(25), rng.choice([*urls, "lost"]), rng.randrange(6)) for _ in range(90)]
    seeds = [(e, rng.choice(urls), rng.randrange(6)) for e in range(12) for _ in range(rng.choice([1, 2]))]
    got = frontier.crawled(
        spark.createDataFrame(seeds, "entity int, url string, score int"), spark.createDataFrame(list(pages.items()), "url string, page int"),
        spark.createDataFrame(links, "page int, url string, score int"), 3, 2,
    )
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0], r[3])) == plain_crawl(seeds, pages, links, 3, 2)
    none = spark.createDataFrame([], "entity int, url string, score int")
    assert frontier.crawled(none, spark.createDataFrame(list(pages.items()), "url string, page int"), spark.createDataFrame(links, "page int, url string, score int")).count() == 0


def test_crawl_query_equals_a_queue(spark):
    seeds, pages, links = ([tuple(r) for r in df.collect()] for df in scans._graph(spark, "/root/testdata/sf0.001"))
    known = {}
    for url, page in pages:
        known[url] = min((p for p in (known.get(url), page) if p is not None), default=None)
    got = scans.crawl_frontier(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[3])) == plain_crawl(seeds, known, links, 3, 4)


def sound(spark):
    observations = [(k, k % 3, "founded" if k % 2 else "students", "s0", "number", "people", float(k), 2000, 0.9, True, None) for k in range(6)]
    canonical = [(o[1], o[2], o[3], o[0], o[6], o[7], "high", "only one") for o in observations]
    coverage = [("founded", 3, 3, 3), ("students", 3, 3, 3)]
    data = {
        "metrics": ([("founded", "number", "people"), ("students", "number", "people")], "metric string, kind string, unit string"),
        "institutions": ([(k, "s0", None) for k in range(3)], "entity int, identity_source string, website_source string"), "sources": ([("s0",), ("s1",)], "source_id string"),
        "observations": (observations, "observation_id int, entity int, metric string, source_id string, kind string, unit string, value double, frame int, confidence double, comparable boolean, conflict string"),
        "canonical": (canonical, "entity int, metric string, source_id string, observation_id int, value double, frame int, level string, reason string"),
        "meta": ([(3, 2, 6, 6, 0, 5, 2, coverage)], "institutions long, sources long, observations long, canonical long, conflicting long, selected long, unresolved long, coverage array<struct<metric: string, observations: bigint, entities: bigint, canonical: bigint>>"),
    }
    return data


def hurt(table, row, column, value):
    def change(data):
        rows, schema = data[table]
        at = [c.strip().split()[0] for c in schema.split(", ") if c.count(" ") and not c.startswith(("observations: ", "entities: ", "canonical: "))].index(column)
        rows[row] = (*rows[row][:at], value, *rows[row][at + 1 :])
    return change


def repeat(table):
    return lambda data: data[table][0].append(data[table][0][0])


FAULTS = {
    "repeated metric": repeat("metrics"), "repeated institution": repeat("institutions"), "repeated source": repeat("sources"), "repeated observation": repeat("observations"),
    "several canonical values": repeat("canonical"), "institution of an unknown source": hurt("institutions", 1, "identity_source", "gone"),
    "website of an unknown source": hurt("institutions", 1, "website_source", "gone"), "observation of an unknown institution": hurt("observations", 2, "entity", 77),
    "observation of an unknown source": hurt("observations", 2, "source_id", "gone"), "observation of an unknown metric": hurt("observations", 2, "metric", "gone"),
    "observation with another shape than its metric's": hurt("observations", 2, "unit", "year"), "confidence outside 0 to 1": hurt("observations", 2, "confidence", 1.01),
    "canonical value of an unknown observation": hurt("canonical", 2, "observation_id", 99), "canonical value that its observation does not hold": hurt("canonical", 2, "value", 7.5),
    "canonical value of an observation for display only": hurt("observations", 2, "comparable", False), "selection without a level or reason": hurt("canonical", 2, "level", "sure"),
    "comparable founding year without a canonical one": hurt("canonical", 1, "metric", "students"), "metadata: institutions": hurt("meta", 0, "institutions", 4), "metadata: sources": hurt("meta", 0, "sources", 9),
    "metadata: observations": hurt("meta", 0, "observations", 9), "metadata: canonical": hurt("meta", 0, "canonical", 9), "metadata: conflicting": hurt("observations", 3, "conflict", "g"),
    "metadata: selected": hurt("meta", 0, "selected", 4), "metadata: coverage": hurt("meta", 0, "coverage", []),
}


def faults(spark, data):
    return {r.check: (r.bad_rows, r.offenders) for r in constraints.dataset_faults({t: spark.createDataFrame(rows, schema) for t, (rows, schema) in data.items()}).collect()}


def test_a_sound_dataset_has_no_faults(spark):
    found = faults(spark, sound(spark))
    assert set(found) == set(FAULTS) and all(n == 0 and not named for n, named in found.values()), found


#: Faults that do not hide one another.
TOGETHER = (
    [c for c in FAULTS if c.startswith(("repeated", "several"))], [c for c in FAULTS if c.startswith("metadata")],
    [c for c in FAULTS if c.startswith(("institution", "website", "canonical", "selection", "comparable")) and "display" not in c],
    *([c] for c in FAULTS if c.startswith(("observation", "confidence")) or "display" in c),
)


@pytest.mark.parametrize("checks", TOGETHER, ids=lambda checks: checks[0])
def test_each_fault_is_found_and_named(spark, checks):
    data = sound(spark)
    for check in checks:
        FAULTS[check](data)
    found = faults(spark, data)
    assert {c: found[c][0] >= 1 and len(found[c][1]) >= 1 for c in checks} == dict.fromkeys(checks, True)


def test_offenders_are_few(spark):
    df = spark.range(1000).withColumn("ok", F.col("id") % 2 == 0)
    row, = constraints.checked(df, {"odd": F.col("ok")}, "id").collect()
    assert row.bad_rows == 500 and len(row.offenders) == constraints.NAMED
