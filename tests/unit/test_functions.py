import ipaddress
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from podium.functions import addresses, facts, names, numbers, places, web


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def values(df, expression):
    return [r[1] for r in df.select("i", expression.alias("x")).orderBy("i").collect()]


def test_rank_numbers_and_displays(spark):
    shown = ["1", "=42", "601–800", "1,201+", "Reporter", "", None, "1.5"]
    df = column(spark, shown)
    assert values(df, numbers.rank_number(F.col("v"))) == [1, 42, 601, 1201, None, None, None, 1]
    assert values(df, numbers.rank_display(F.col("v"))) == ["1", "=42", "601–800", "1,201+", "Reporter", "—", "—", "1.5"]
    assert values(column(spark, ["1234567", " 12 "]), numbers.rank_display(F.col("v"))) == ["1,234,567", "12"]


def test_to_number(spark):
    df = column(spark, ["1,234.5", " 7 ", "12d", "Infinity", "NaN", "", None, "-3e2", ".5"])
    assert values(df, numbers.to_number(F.col("v"))) == [1234.5, 7.0, None, None, None, None, None, -300.0, 0.5]
    assert values(column(spark, ["12.5%", "−3", "N/A"]), numbers.share_number(F.col("v"))) == [12.5, -3.0, None]


def test_half_even(spark):
    df = column(spark, [0.5, 1.5, 2.5, 2.500001, -0.5, -1.5, 1.005, 0.125], "double")
    assert values(df, numbers.half_even(F.col("v"), 0)) == [0.0, 2.0, 2.0, 3.0, 0.0, -2.0, 1.0, 0.0]
    assert values(df, numbers.half_even(F.col("v"), 2))[6:] == [1.0, 0.12]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=20))
def test_half_even_like_python(spark, whole):
    df = column(spark, [x / 4 for x in whole], "double")
    assert values(df, numbers.half_even(F.col("v"), 0)) == [float(round(x / 4)) for x in whole]


def test_growth(spark):
    df = spark.createDataFrame([(100.0, 200.0), (0.0, 5.0)], "a double, b double")
    got = df.select(numbers.percent_change(F.col("b"), F.col("a")), numbers.growth_rate(F.col("b"), F.col("a"), 1)).collect()
    assert [tuple(r) for r in got] == [(100.0, 100.0), (None, None)]
    assert values(column(spark, ["2024-25", "2024/2025", "2024-26", "1999-00", "x"]), numbers.academic_year(F.col("v"))) == [2024, 2024, None, 1999, None]
    assert values(column(spark, [0, 3, 9], "int"), numbers.retry_delay(F.col("v"), 1.0)) == [1.0, 8.0, 30.0]


def test_names(spark):
    raw = ["The Université de Montréal *", "Texas A&amp;M University", "L’Aquila", "São Paulo–Campus", "北京大学", None, "O&#39;Brien"]
    assert values(column(spark, raw), names.normalize_name(F.col("v"))) == ["universite de montreal", "texas a and m university", "laquila", "sao paulo campus", "", None, "obrien"]
    assert values(column(spark, ["a&lt;b &copy; &#233;&#x41;"]), names.decode_entities("v")) == ["a<b &copy; éA"]
    assert values(column(spark, ["<b>Hi</b>&nbsp; there <br>"]), names.plain_text(F.col("v"))) == ["Hi there"]
    assert values(column(spark, ["field-life-sciences"]), names.title_case(F.col("v"))) == ["Field Life Sciences"]
    assert values(column(spark, ["abcdef", "ab"]), names.truncate(F.col("v"), 4)) == ["abc…", "ab"]
    assert values(column(spark, ["Zürich ETH", "Lyon"]), names.has_all_tokens(names.fold("v"), "eth ZURICH")) == [True, False]
    pair = spark.createDataFrame([("University of South Wales", "South Wales University"), ("Of the", "")], "a string, b string")
    got = pair.select(names.dice(names.tokens(F.col("a")), names.tokens(F.col("b"))), names.signature(F.col("a"))).collect()
    assert got[0][0] == 1.0 and got[0][1] == "south wales" 


def test_aliases(spark):
    df = spark.createDataFrame([("mit",), ("other",)], "k string")
    aliases = spark.createDataFrame([("mit", "massachusetts institute of technology")], "alias string, canonical string")
    assert {r.k for r in names.with_aliases(df, "k", aliases).collect()} == {"massachusetts institute of technology", "other"}


def test_countries(spark):
    raw = ["DE", "deu", "Germany", "Munich (DEU), Germany", "u.s.a.", "Multinational", "Atlantis", "XYZ", "", None]
    df = column(spark, raw)
    got = {r.i: r.country_code for r in places.with_country(df, "v", places.country_keys(spark)).collect()}
    assert [got[i] for i in range(10)] == ["DE", "DE", "DE", "DE", "US", None, None, None, None, None]
    more = ["Iran, Islamic Republic of", "Islamic Republic of Iran", "Korea (Republic of)", "Republic of Korea", "U.K.", "Côte d'Ivoire", "Viet Nam", "Burkina Faso", "Türkiye", "Seoul, South Korea", "Zambia", "Holland", "Russian Federation"]
    aliases = spark.createDataFrame([("Holland", "NL")], "alias string, code string")
    told = {r.i: r.country_code for r in places.with_country(column(spark, more), "v", places.country_keys(spark, aliases=aliases)).collect()}
    assert [told[i] for i in range(len(more))] == ["IR", "IR", "KR", "KR", "GB", "CI", "VN", "BF", "TR", "KR", "ZM", "NL", "RU"]
    assert places.country_dim(spark).count() > 240
    assert values(df, places.fallback_label(F.col("v")))[5:] == ["Multinational", "Atlantis", "Unknown", "Unknown", "Unknown"]
    near = spark.createDataFrame([("CN", ["HK"]), ("CN", ["JP"]), ("FR", ["FR", "DE"])], "a string, b array<string>")
    assert [r[0] for r in near.select(places.same_country(F.col("a"), F.col("b"))).collect()] == [True, False, True]


def test_web(spark):
    urls = ["/a//b?utm_source=x&k=1#f", "mailto:a@b.c", "HTTP://Example.org:80/x", None, "//other.net", "http://[bad"]
    df = column(spark, urls).withColumn("base", F.lit("https://example.org/dir/"))
    assert values(df, web.normalize_url("v", "base")) == ["https://example.org/a/b?k=1", None, "https://example.org/x", None, "https://other.net/", None]
    ips = ["10.1.2.3", "8.8.8.8", "172.31.0.1", "172.32.0.1", "256.1.1.1", "x", "192.168.1.1"]
    assert values(column(spark, ips), addresses.is_reserved(F.col("v"))) == [True, False, True, False, True, True, True]
    hosts = spark.createDataFrame([("www.a.edu", "a.edu"), ("x.a.edu", "a.edu"), ("ba.edu", "a.edu")], "a string, b string")
    assert [r[0] for r in hosts.select(web.same_site(F.col("a"), F.col("b"))).collect()] == [True, True, False]
    assert values(column(spark, ["/About-us", "/news/2024", "/zzz", None]), web.link_kind(F.col("v"))) == ["about", "news", "other", None]
    assert values(column(spark, ["https://www.youtube.com/x", "https://notyoutube.com"]), web.social_network(F.col("v"))) == ["youtube", None]
    failed = spark.createDataFrame([(404, None), (503, None), (403, None), (None, None), (None, "ConnectTimeoutError"), (None, "TimeoutError"), (None, "RedirectException"), (429, "x"), (302, None)], "s int, e string")
    kinds = [r[0] for r in failed.select(web.failure_class(F.col("s"), F.col("e"))).collect()]
    assert kinds == ["absent", "transient", "refused", None, "refused", "transient", "absent", "transient", "absent"]
    assert [r[0] for r in failed.select(web.retries(F.col("s"), F.col("e"), ("transient",))).collect()] == [False, True, False, True, False, True, False, True, False]
    assert [r[0] for r in failed.select(web.retries(F.col("s"), F.col("e"), ())).collect()] == [k is None for k in kinds]
    pages = spark.createDataFrame([("https://a.edu/about",), ("https://www.a.edu/x/y/z",), ("https://b.org/news/1",), ("https://a.edu/",)], "u string")
    assert [r[0] for r in pages.select(web.page_priority(F.col("u"), F.lit(10), F.lit("a.edu"))).collect()] == [46, 12, -55, 22]
    assert [r[0] for r in pages.select(web.page_priority(F.col("u"), F.lit(0), F.lit("a.edu"), {"news": 9}, 0, 1)).collect()] == [0, -2, 8, 0]


@pytest.mark.parametrize("seed", [1, 2])
def test_addresses_against_the_standard_library(spark, seed):
    rng = random.Random(seed)
    texts = ["::", "::1", "1::", "::ffff:10.0.0.1", "::ffff:8.8.8.8", "::FFFF:7f00:1", "2001:db8::1", "2002::1", "2606:4700::1111", "fe80::1%eth0", "[2001:4860::8888]", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::",
             "1::2::3", ":::", "12345::", "1:2:3", "1:2:3:4:5:6:7:8:9", ":1:2:3:4:5:6:7", "::1.2.3", "::1.2.3.400", "g::", "", None, " 8.8.8.8 ", "2001:0:1::", "2001:2::9", "3fff::1", "4000::", "64:ff9b::1"]
    for _ in range(300):
        whole = ipaddress.IPv6Address(rng.getrandbits(128) & rng.getrandbits(128) & rng.choice([(1 << 128) - 1, (1 << 64) - 1, ~((1 << 80) - 1) & ((1 << 128) - 1)]))
        texts += [str(whole), whole.exploded, str(ipaddress.IPv4Address(rng.getrandbits(32)))]

    def plain(text):
        try:
            found = ipaddress.ip_address((text or "").strip().split("%")[0].strip("[]"))
        except ValueError:
            return None
        return int(found) | (0xFFFF << 32 if found.version == 4 else 0)

    got = [r[0] for r in column(spark, texts).select("i", addresses.number(F.col("v")).alias("n")).orderBy("i").select("n").collect()]
    numbers = [None if r is None else (r.hi + (1 << 63)) << 64 | (r.lo + (1 << 63)) for r in got]
    assert numbers == [plain(t) for t in texts]
    known = [r for r in zip(numbers, got) if r[0] is not None]
    assert [r[0] for r in sorted(known, key=lambda r: (r[1].hi, r[1].lo))] == sorted(r[0] for r in known)
    reserved = dict(zip(texts, values(column(spark, texts), addresses.is_reserved(F.col("v")))))
    assert not any(reserved[t] for t in ("::ffff:8.8.8.8", "2606:4700::1111", "[2001:4860::8888]", "3fff::1", " 8.8.8.8 "))
    assert all(reserved[t] for t in ("::ffff:10.0.0.1", "::FFFF:7f00:1", "2001:db8::1", "2002::1", "fe80::1%eth0", "::", "4000::", "2001:0:1::", "2001:2::9", "", None, "g::", "64:ff9b::1"))


def test_address_blocks_against_the_standard_library(spark):
    blocks = ["10.0.0.0/8", "192.0.2.77/24", "0.0.0.0/0", "1.2.3.4/32", "2001:db8::/32", "::/0", "fe80::1/64", "2001:db8:1:2:3::/80", "::1/128", "2001:db8::ff/127"]
    rows = column(spark, [*blocks, "x/8", "10.0.0.0/33", "10.0.0.0"]).select("i", addresses.bounds(F.col("v")).alias("b")).orderBy("i").collect()
    join = lambda n: (n.hi + (1 << 63)) << 64 | (n.lo + (1 << 63))
    for block, row in zip(blocks, rows):
        net = ipaddress.ip_network(block, strict=False)
        base = 0xFFFF << 32 if net.version == 4 else 0
        assert (join(row.b.low), join(row.b.high)) == (base | int(net.network_address), base | int(net.broadcast_address)), block
    assert [r.b for r in rows[len(blocks) :]] == [None, None, None]


def test_facts(spark):
    df = column(spark, ["Acme University, founded in 1902, has 12,500 students.", "The School of Law was founded in 1950.", "Nothing here"])
    got = {(r.i, r.metric): r.value for r in facts.extract_facts(df, "v").collect()}
    assert got == {(0, "founded"): 1902.0, (0, "students"): 12500.0}
    rows = spark.createDataFrame([("founded", 1902.0), ("founded", 3000.0), ("acceptance_rate", 101.0), ("students", -1.0), ("students", None)], "m string, v double")
    assert [r[0] for r in rows.select(facts.plausible(F.col("m"), F.col("v"), F.lit(2024))).collect()] == [True, False, False, False, False]
    one = spark.range(1).select(facts.stable_id("s_", F.lit(1), F.lit("a")), facts.stable_id("s_", F.lit(1), F.lit(None).cast("string"))).first()
    assert len(one[0]) == 26 and one[0] != one[1]
    said = spark.createDataFrame([("Acme University was founded in 1902",), ("our university opened in 1902",), ("The School of Law of Acme University opened in 1902",)], "t string")
    assert [r[0] for r in said.select(facts.evidence_score(F.col("t"), F.lit("Acme University"), F.lit(1902))).collect()] == [80, 55, -20]


@pytest.mark.parametrize("text,day", [("2024-03-01T10:00", "2024-03-01"), ("03/01/2024", None), (None, None)])
def test_iso_day(spark, text, day):
    got = column(spark, [text]).select(facts.iso_day(F.col("v"))).first()[0]
    assert (str(got) if got else None) == day
