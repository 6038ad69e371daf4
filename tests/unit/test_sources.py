import json

import pytest
from pyspark.sql import functions as F

from podium.sources import documents, paged, sinks, snapshots
from podium.streaming import landing_upsert, running_best, windowed_counts


@pytest.fixture
def archive(tmp_path):
    def put(stem, rows, **manifest):
        (tmp_path / f"{stem}.csv").write_text("﻿ranking_scope,ranking,name,note\n\n" + "".join(rows), encoding="utf-8")
        (tmp_path / f"{stem}.manifest.json").write_text(json.dumps({"source": stem.split("_")[0], "records": len(rows)} | manifest, indent=1))

    put("alpha_worldwide_all_rankings_2020", ['overall,1,"A ""quoted"" name",\n', 'overall,2,"Two\nlines",x\n'], ranking_year=2020)
    put("alpha_worldwide_all_rankings_2021", ["overall,1,B,\n"])
    put("beta_germany_all_rankings_2019", ["overall,1,C,\n"], ranking_year=2019)
    (tmp_path / "gone_worldwide_2000.manifest.json").write_text('{"source": "gone", "ranking_year": 2000}')
    return tmp_path


def test_catalogue_and_csv(spark, archive):
    shots = snapshots.catalogue(spark, str(archive))
    got = {r.file_name: (r.source, r.edition, r.is_global) for r in shots.collect()}
    assert got == {
        "alpha_worldwide_all_rankings_2020.csv": ("alpha", 2020, True), "alpha_worldwide_all_rankings_2021.csv": ("alpha", 2021, True), "beta_germany_all_rankings_2019.csv": ("beta", 2019, False),
    }
    assert {r.source: r.edition for r in snapshots.latest(shots).collect()} == {"alpha": 2021, "beta": 2019}
    assert snapshots.first_path(shots).count() == 3
    rows = snapshots.read_table(spark, str(archive / "alpha_worldwide_all_rankings_2020.csv")).orderBy("__ord").collect()
    assert [r["name"] for r in rows] == ['A "quoted" name', "Two\nlines"] and rows[0]["note"] is None
    assert "ranking_scope" in rows[0].asDict()


def test_edition_fallback(spark):
    boards = spark.createDataFrame([("q", 2026, "a", 1), ("q", 2025, "b", 2), ("r", 2024, "c", 3)], "source string, edition int, file_name string, v int")
    assert {(r.source, r.v) for r in snapshots.latest_with_rows(boards, ["source"]).collect()} == {("q", 1), ("r", 3)}


def test_projections(spark):
    df = spark.createDataFrame([("", "7", " X ")], "rank string, position string, name string")
    out = snapshots.canonical(df, ["rank", "position"], ["title", "name"], ["country"]).first()
    assert (out.rank_display, out.name, out.country_raw) == ("7", "X", None)
    assert snapshots.backfilled(df, "rank", "position").first()["rank"] == "7"
    assert snapshots.stamped(df, "s", "overall", 2020, "t", drop=["name"]).columns[:4] == list(snapshots.LEADING)
    nested = spark.sql("select array(named_struct('value','v','label','a')) as r, array(named_struct('year',2020,'n',5)) as c, '{\"x\":\"1\"}' as j")
    got = nested.select(snapshots.labelled(F.col("r"), "a"), snapshots.labelled(F.col("r"), "b"), snapshots.of_year(F.col("c"), 2020)["n"]).first()
    assert tuple(got) == ("v", None, 5)
    assert snapshots.indicators(nested, "j", {"x": "alumni", "y": "award"}).select("alumni", "award").first() == ("1", None)
    scopes = spark.createDataFrame([("law",), ("art",)], "ranking_scope string")
    launched = spark.createDataFrame([("law", 2024)], "ranking_scope string, first_year int")
    assert [r[0] for r in snapshots.open_scopes(scopes, launched, 2023).collect()] == ["art"]


def test_seeds(spark):
    df = spark.createDataFrame([("overall", "i1", 2, "B", "DE"), ("overall", "i2", 1, "A", "FR"), ("law", "i1", 1, "B", "DE")], "ranking_scope string, id string, rank int, name string, country_code string")
    assert [r.name for r in snapshots.seeds(df, "id").collect()] == ["A", "B"]
    with pytest.raises(ValueError):
        snapshots.seeds(df.withColumn("ranking_scope", F.lit("overall")), "id")
    directory = spark.sql("select 'C' as name, 'DE' as country_code, cast(null as int) as consensus_rank, map('p', 9, 'q', 4) as ranks union all select 'D', 'DE', 3, map('own', 1)")
    assert sorted(map(tuple, snapshots.seed_union(df.where("rank=1 and ranking_scope='overall'"), directory, "own").collect())) == [("A", "FR", 1), ("C", "DE", 4)]


def test_registry(spark):
    schema = "id string, status string, names array<struct<value:string,types:array<string>>>, links array<struct<type:string,value:string>>, domains array<string>, locations array<struct<geonames_details:struct<country_code:string>>>"
    rows = [("r1", "active", [("Old", ["alias"]), ("Shown", ["ror_display"])], [("website", "http://a.org"), ("website", "https://b.org")], [], [(("DE",),)]), ("r2", "active", [("N", ["label"])], [], ["c.org"], [])]
    got = {r.id: r for r in snapshots.registry_records(spark.createDataFrame(rows, schema)).collect()}
    assert (got["r1"].label, got["r1"].website, got["r1"].country_codes) == ("Shown", "https://b.org", ["DE"])
    assert (got["r2"].label, got["r2"].website) == ("N", "https://c.org")


def test_upsert_orders_scopes(spark, tmp_path):
    first = spark.createDataFrame([("overall", "a", 1), ("engineering", "b", 2)], "ranking_scope string, title string, __ord int")
    second = spark.createDataFrame([("engineering", "c", 1), ("arts", "d", 2)], "ranking_scope string, title string, __ord int")
    order = spark.createDataFrame([("overall", 0), ("arts", 1), ("engineering", 2)], "ranking_scope string, position int")
    merged = sinks.upserted(first, second, order).orderBy("__scope", "__place").collect()
    assert [(r.ranking_scope, r.title) for r in merged] == [("overall", "a"), ("arts", "d"), ("engineering", "c")]
    path = str(tmp_path / "store")
    sinks.write_scopes(first, path)
    sinks.write_scopes(second, path)
    assert {(r.ranking_scope, r.title) for r in spark.read.parquet(path).collect()} == {("overall", "a"), ("arts", "d"), ("engineering", "c")}
    log = spark.createDataFrame([("arts", "e1"), ("law", "e2")], "ranking_scope string, error string")
    kept = sinks.merged_failures(log, second, log.where("false"))
    assert [r.error for r in kept.collect()] == ["e2"]
    counts = sinks.manifest(first.withColumn("source", F.lit("s")), ["source"]).first()
    assert counts.records == 2 and counts.records_by_scope == {"overall": 1, "engineering": 1}


def test_sinks_round_trip(spark, tmp_path):
    df = spark.sql("select 'a \"q\", b' as t, true as f, array(1, 2) as l, cast(null as string) as n")
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.options(header=True, escape='"').csv(str(tmp_path / "csv")).first()
    assert tuple(back) == ('a "q", b', "True", "[1, 2]", None)
    sinks.write_json(spark.range(3), str(tmp_path / "x.json"))
    assert json.loads((tmp_path / "x.json").read_text()) == [{"id": 0}, {"id": 1}, {"id": 2}]
    with pytest.raises(ValueError):
        sinks.write_json(spark.range(3), str(tmp_path / "x.json"), most_rows=2)
    detail = spark.createDataFrame([("p", "s", 1), ("p", "t", 2)], "provider string, subject string, v int")
    assert sinks.write_details(detail, str(tmp_path / "d")).count() == 2
    rows = spark.createDataFrame([(1, "x"), (2, None), (3, "y"), (4, "x")], "o int, v string")
    codes = sinks.dictionary(rows, "v", "o")
    assert sorted(map(tuple, codes.collect())) == [("x", 0), ("y", 1)]
    assert sorted((r.o, r.v) for r in sinks.decoded(sinks.encoded(rows, "v", codes), "v", codes).collect()) == [(1, "x"), (2, None), (3, "y"), (4, "x")]
    with pytest.raises(Exception, match="unknown v code"):
        sinks.decoded(sinks.encoded(rows, "v", codes), "v", codes.where("code = 0")).collect()


def test_html_tables_and_markdown(spark):
    page = "<table><tr><th>Other</th></tr></table><table><tr><th>World Rank</th><th>Institution</th></tr><tr><td>1</td><td>A <b>B</b></td></tr></table>"
    df = spark.createDataFrame([(1, page), (2, "none")], "id int, html string")
    rows = documents.html_tables(df, "id", "html", ("World Rank", "Institution")).collect()
    assert [(r.id, r.cells) for r in rows] == [(1, {"world_rank": "1", "institution": "A B"})]
    md = "1. [First](http://a)\n2. [Second](http://b)\n\n| Rank | Name |\n|---|---|\n| =3 | Third |\n"
    got = documents.markdown_ranking(spark.createDataFrame([("d", md)], "id string, text string"), "text").collect()
    assert sorted((r["rank"], r.name, r.url) for r in got) == [(1, "First", "http://a"), (2, "Second", "http://b"), (3, "Third", None)]


def test_sitemap_robots_fragments_json_ld(spark):
    xml = "<urlset><url><loc> http://a/1 </loc></url><url><loc><![CDATA[http://a/2]]></loc></url><url><loc>http://a/1</loc></url></urlset>"
    assert [r.url for r in documents.sitemap_urls(spark.createDataFrame([(xml,)], "t string"), "t").collect()] == ["http://a/1", "http://a/2"]
    robots = "User-agent: *\nDisallow: /private\nAllow: /private/open\n\nUser-agent: Bot\nUser-agent: Crawler\nDisallow:\nDisallow: /*.pdf$\n# x\n"
    rules = documents.robots_rules(spark.createDataFrame([("h", robots)], "host string, text string"), "host", "text")
    asks = [("h", "Other", "/private/x", False), ("h", "Other", "/private/open/x", True), ("h", "Other", "/public", True), ("h", "bot", "/private", True), ("h", "crawler", "/a.pdf", False), ("h", "crawler", "/a.pdf?x", True), ("g", "bot", "/", True)]
    wanted = spark.createDataFrame([a[:3] for a in asks], "host string, agent string, path string")
    got = {(r.host, r.agent, r.path): r.allowed for r in documents.robots_allow(wanted, rules, "host").collect()}
    assert got == {a[:3]: a[3] for a in asks}
    frags = [(1, 0, 5.0, "1"), (1, 1, 50.0, "Uni"), (1, 2, 60.0, "One"), (1, 3, 200.0, "12"), (1, 4, 5.0, "2"), (1, 5, 50.0, "No close"), (1, 6, 5.0, "3"), (1, 7, 50.0, "Three"), (1, 8, 210.0, "7")]
    rows = documents.fragment_rows(spark.createDataFrame(frags, "page int, ord int, x double, text string"), 10, 150)
    assert sorted((r["rank"], r.name, r.closing) for r in rows.collect()) == [(1, "Uni One", 12), (3, "Three", 7)]
    ld = '<script type="application/ld+json">{"@type":"Org","name":"N","address":{"@type":["Place"],"name":{"@value":"P"}}}</script><script type="application/ld+json">{bad</script>'
    nodes = documents.json_ld(spark.createDataFrame([(1, ld), (2, "")], "id int, html string"), "id", "html").collect()
    assert [(r.node, r.kind, r.name) for r in nodes] == [(0, "Org", "N"), (1, "Place", "P"), (2, None, None)]


def test_paged_sources(spark):
    paged.register(spark, "numbers", "page int, v int", 3, lambda page: [(page, page * 10), (page, page * 10 + 1)])
    assert spark.read.format("numbers").load().count() == 6
    steps = {"*": ([(1,)], "b"), "b": ([(2,)], None)}
    paged.register_cursor(spark, "cursor", "v int", steps.__getitem__)
    assert sorted(r.v for r in spark.read.format("cursor").load().collect()) == [1, 2]


def test_streaming_upsert_and_state(spark, tmp_path):
    landing, store = tmp_path / "in", tmp_path / "store"
    landing.mkdir()
    (landing / "1.csv").write_text("title,ranking_scope\na,overall\nb,law\n")
    run = lambda: landing_upsert(spark, "title string, ranking_scope string", str(landing), str(store), str(tmp_path / "ck")).awaitTermination()
    run()
    (landing / "2.csv").write_text("title,ranking_scope\nc,law\n")
    run()
    assert {(r.title, r.ranking_scope) for r in spark.read.parquet(str(store)).collect()} == {("a", "overall"), ("c", "law")}
    source = tmp_path / "rows"
    spark.createDataFrame([("x", 1.0), ("x", 5.0), ("y", 2.0)], "entity string, score double").write.parquet(str(source))
    best = running_best(spark.readStream.schema("entity string, score double").parquet(str(source)))
    query = best.writeStream.outputMode("update").format("memory").queryName("best").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.sql("select * from best").collect())) == [("x", 5.0, 2), ("y", 2.0, 1)]


def test_stream_windows_equal_batch(spark):
    path = "/root/testdata/sf0.001/events.parquet"
    batch = spark.read.parquet(path)
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "events.parquet").parquet("/root/testdata/sf0.001/")
    query = windowed_counts(stream, "ts", ["event_type"], "1 day").writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(map(tuple, spark.sql("select * from w").collect())) == sorted(map(tuple, windowed_counts(batch, "ts", ["event_type"], "1 day").collect()))
