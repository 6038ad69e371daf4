"""Tables and facts out of documents: HTML, Markdown, sitemaps, robots.txt, PDF fragments, JSON-LD.

Formats with a grammar of their own are parsed in Arrow batches; the rest is built in.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podium.functions.names import decode_entities, plain_text, slug
from podium.functions.numbers import rank_number, share_number
from podium.operators.relational import segments


class _Tables(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables:
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


def html_tables(pages: DataFrame, key: str, markup: str, needed: tuple[str, ...]) -> DataFrame:
    """(key, row, cells map): rows of each page's first table whose header has all ``needed`` columns."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for k, text in zip(pdf[key], pdf[markup]):
                parser = _Tables()
                parser.feed(text or "")
                for table in parser.tables:
                    rows = [r for r in table if r]
                    if rows and all(n.lower() in [h.lower() for h in rows[0]] for n in needed):
                        header = ["_".join(h.lower().split()) for h in rows[0]]
                        out += [(k, i, dict(zip(header, r))) for i, r in enumerate(rows[1:])]
                        break
            yield pd.DataFrame(out, columns=["key", "row", "cells"])

    kind = dict(pages.dtypes)[key]
    return pages.select(key, markup).mapInPandas(run, f"key {kind}, row long, cells map<string,string>").withColumnRenamed("key", key)


def html_parts(pages: DataFrame, markup: str = "html") -> DataFrame:
    """Adds title, description, links (array of href, text) and content_hash by built-in functions."""
    title = plain_text(F.regexp_extract(markup, r"(?is)<title[^>]*>(.*?)</title>", 1))
    described = F.regexp_extract(markup, r"(?is)<meta[^>]+name=[\"']description[\"'][^>]+content=[\"']([^\"']*)", 1)
    hrefs = F.regexp_extract_all(markup, F.lit(r"(?is)<a\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"), F.lit(1))
    labels = F.regexp_extract_all(markup, F.lit(r"(?is)<a\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"), F.lit(2))
    links = F.arrays_zip(hrefs.alias("href"), F.transform(labels, lambda t: F.trim(F.regexp_replace(F.regexp_replace(t, "<[^>]*>", " "), r"\s+", " "))).alias("text"))
    return pages.withColumns({"title": title, "description": F.when(described != "", decode_entities(described)), "links": links, "content_hash": F.sha2(markup, 256)})


def visible_blocks(pages: DataFrame, markup: str = "html", shortest: int = 20, longest: int = 700) -> DataFrame:
    """``place`` and ``block``, a row a visible text block of a page: scripts, styles and comments out, cut at block
    elements, tags dropped, references decoded, blanks collapsed.  Shorter and longer blocks are menus and whole articles."""
    bare = F.regexp_replace(markup, r"(?is)<(script|style|template|noscript|head)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    pieces = F.split(bare, r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|td|th|tr|table|article|section|header|footer|nav|aside|main|blockquote|br|hr|body|html|form|figure)\b[^>]*>")
    rows = pages.select("*", F.posexplode(pieces).alias("place", "__piece"))
    text = F.trim(F.regexp_replace(decode_entities(F.regexp_replace("__piece", "<[^>]*>", "")), r"\s+", " "))
    return rows.withColumn("block", text).drop("__piece").where(F.length("block").between(shortest, longest))


def sitemap_urls(documents: DataFrame, text: str, most: int | None = None) -> DataFrame:
    """Distinct <loc> entries, CDATA unwrapped, in order of appearance; ``most``: so many of each sitemap."""
    found = F.regexp_extract_all(text, F.lit(r"(?is)<loc>\s*(.*?)\s*</loc>"), F.lit(1))
    bare = F.transform(found, lambda u: F.trim(F.regexp_replace(u, r"(?s)^<!\[CDATA\[(.*)\]\]>$", "$1")))
    urls = F.array_distinct(F.filter(bare, lambda u: u != ""))
    return documents.withColumn("url", F.explode(urls if most is None else F.slice(urls, 1, most)))


def markdown_rows(documents: DataFrame, text: str) -> DataFrame:
    """Rows of pipe tables as arrays of cells, with their line; rulers and blank rows go."""
    lines = documents.select("*", F.posexplode(F.split(text, r"\r?\n")).alias("line", "__line"))
    rows = lines.where(F.trim("__line").rlike(r"^\|.*\|$") & ~F.col("__line").rlike(r"^[\s|:-]*$"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("__line"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    return rows.withColumn("cells", cells).drop("__line")


def markdown_ranking(documents: DataFrame, text: str) -> DataFrame:
    """rank, name, url and metrics (array of doubles) of numbered lists ("3. [Name](url)") and of pipe tables that begin
    with a rank; a table's further cells are its metrics."""
    keys = [c for c in documents.columns if c != text]
    listed = F.regexp_extract_all(text, F.lit(r"(?m)^\s*\d+[.)]\s+\[[^\]]+\]\([^)]*\)"), F.lit(0))
    rows = documents.select(*keys, F.explode(listed).alias("item"))
    pattern = r"^\s*(\d+)[.)]\s+\[([^\]]+)\]\(([^)]*)\)"
    none = F.lit(None).cast("array<double>")
    first = rows.select("*", *[F.regexp_extract("item", pattern, k).alias(n) for k, n in ((1, "rank"), (2, "name"), (3, "url"))], none.alias("metrics")).drop("item")
    table = markdown_rows(documents, text).where(F.get("cells", F.lit(0)).rlike(r"^=?\d"))
    name = F.get("cells", F.lit(1))
    link = r"^\[([^\]]+)\]\(([^)]*)\)$"
    metrics = F.transform(F.slice("cells", 3, F.greatest(F.size("cells") - 2, F.lit(0))), share_number)
    second = table.select(
        *keys, F.get("cells", F.lit(0)).alias("rank"), F.when(name.rlike(link), F.regexp_extract(name, link, 1)).otherwise(name).alias("name"),
        F.when(name.rlike(link), F.regexp_extract(name, link, 2)).alias("url"), metrics.alias("metrics"),
    )
    return first.unionByName(second).withColumn("rank", rank_number(F.col("rank")))


def ranking_faults(rows: DataFrame, keys: list[str], order: str, identity: str) -> DataFrame:
    """keys, fault, n: places where a ranking's rank falls, and identities that repeat in it."""
    before = F.lag("rank").over(Window.partitionBy(*keys).orderBy(order))
    falls = rows.withColumn("__before", before).where(F.col("rank") < F.col("__before")).groupBy(*keys).agg(F.count("*").alias("n"))
    again = rows.groupBy(*keys, identity).count().where("count > 1").groupBy(*keys).agg(F.count("*").alias("n"))
    return falls.withColumn("fault", F.lit("rank falls")).unionByName(again.withColumn("fault", F.lit("repeated name")))


def fragment_rows(fragments: DataFrame, left: float, right: float) -> DataFrame:
    """Table rows out of positioned text (page, ord, x, text): a row opens with a number left of
    ``left`` and closes with one right of ``right``; what lies between, in order, is its name."""
    number = F.col("text").rlike(r"^\d[\d,]*$")
    keyed = fragments.withColumn("__row", segments(number & (F.col("x") < left), ["page"], ["ord"])).where("__row > 0")
    order = F.array_sort(F.collect_list(F.when(~(number & ((F.col("x") < left) | (F.col("x") > right))), F.struct("ord", "text"))))
    rows = keyed.groupBy("page", "__row").agg(
        F.min_by(F.when(number & (F.col("x") < left), F.col("text")), "ord").alias("rank"),
        F.array_join(F.transform(order, lambda s: s["text"]), " ").alias("name"),
        F.max_by(F.when(number & (F.col("x") > right), F.col("text")), F.when(number & (F.col("x") > right), F.col("ord"))).alias("closing"),
    )
    return rows.where("closing is not null").select("page", rank_number(F.col("rank")).alias("rank"), "name", rank_number(F.col("closing")).alias("closing"))


def json_ld(pages: DataFrame, key: str, markup: str, depth: int = 8, most: int = 500) -> DataFrame:
    """(key, node, kind, name, body): JSON-LD nodes in pre-order, nested ones included."""

    def walk(value, level: int, out: list) -> None:
        if level > depth or len(out) >= most:
            return
        if isinstance(value, list):
            for item in value:
                walk(item, level + 1, out)
        elif isinstance(value, dict):
            out.append(value)
            for item in value.values():
                if isinstance(item, (dict, list)):
                    walk(item, level + 1, out)

    def text(value) -> str | None:
        if isinstance(value, list):
            value = value[0] if value else None
        if isinstance(value, dict):
            value = value.get("@value") or value.get("name")
        return value if isinstance(value, str) else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for k, blocks in zip(pdf[key], pdf["blocks"]):
                nodes: list = []
                for block in blocks if blocks is not None else []:
                    try:
                        value = json.loads(block)
                    except ValueError:
                        continue  # a broken block says nothing
                    walk(value, 0, nodes)
                out += [(k, i, text(n.get("@type")), text(n.get("name")), json.dumps(n)) for i, n in enumerate(nodes)]
            yield pd.DataFrame(out, columns=["key", "node", "kind", "name", "body"])

    blocks = F.regexp_extract_all(markup, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    kind = dict(pages.dtypes)[key]
    rows = pages.select(key, blocks.alias("blocks")).where(F.size("blocks") > 0)
    return rows.mapInPandas(run, f"key {kind}, node long, kind string, name string, body string").withColumnRenamed("key", key)


def robots_rules(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, agent, allow, path): robots.txt groups, one row a rule and agent; empty disallows say nothing.

    A group's agents are the user-agent lines that stand together before its rules.
    """
    lines = documents.select(key, F.posexplode(F.split(text, r"\r?\n")).alias("line", "raw"))
    field = F.lower(F.trim(F.regexp_extract("raw", r"^\s*([A-Za-z-]+)\s*:", 1)))
    value = F.trim(F.regexp_replace(F.regexp_replace("raw", r"#.*$", ""), r"^\s*[A-Za-z-]+\s*:", ""))
    told = lines.select(key, "line", field.alias("field"), value.alias("value")).where(F.col("field").isin("user-agent", "allow", "disallow"))
    before = F.lag("field").over(Window.partitionBy(key).orderBy("line"))
    opens = (F.col("field") == "user-agent") & (F.coalesce(before, F.lit("")) != "user-agent")
    grouped = told.withColumn("opens", opens).withColumn("group", segments(F.col("opens"), [key], ["line"]))
    agents = grouped.where("field = 'user-agent'").select(key, "group", F.lower("value").alias("agent"))
    rules = grouped.where("field <> 'user-agent' and value <> ''").select(key, "group", (F.col("field") == "allow").alias("allow"), F.col("value").alias("path"))
    return agents.join(rules, [key, "group"]).select(key, "agent", "allow", "path")


def _plain_path(path: Column) -> Column:
    """A path as octets in one form: percent escapes of unreserved characters decoded, others in upper case, other
    characters than ASCII escaped."""

    def one(text: str) -> str:
        def step(match: re.Match) -> str:
            char = chr(int(match[1], 16))
            return char if char.isascii() and (char.isalnum() or char in "-._~") else match[0].upper()

        return re.sub("%([0-9A-Fa-f]{2})", step, re.sub("[^\x00-\x7f]+", lambda m: quote(m[0]), text))

    def run(paths: pd.Series) -> pd.Series:
        return paths.map(one, na_action="ignore")

    needed = F.contains(path, F.lit("%")) | (F.length(path) < F.octet_length(path))
    return F.when(needed, F.pandas_udf(run, "string")(F.when(needed, path))).otherwise(path)


def _product(agent: Column) -> Column:
    """A crawler's name without its version: what stands before white space or a slash."""
    return F.lower(F.regexp_extract(agent, r"^\s*([^\s/]+)", 1))


def robots_allow(requests: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """``requests`` (key, agent, path) with ``allowed``: the longest matching rule of the agent's groups;
    allow wins a tie; no rule allows.

    A group counts where its agent is the requesting product, whatever the version and case; without such a
    group, those for all agents count.
    """
    wanted = requests.withColumn("__id", F.struct(key, "agent", "path"))
    own = rules.select(key, _product(F.col("agent")).alias("__agent"), "allow", _plain_path(F.col("path")).alias("__rule"))
    fits = (F.col("__agent") == "*") | ((F.col("__agent") != "") & (F.col("__product") == F.col("__agent")))
    met = wanted.select("__id", _product(F.col("agent")).alias("__product"), _plain_path(F.col("path")).alias("__path"), key).join(own, key).where(fits)
    length = F.when(F.col("__agent") == "*", 0).otherwise(F.length("__agent"))
    specific = met.groupBy("__id").agg(F.max(length).alias("__most"))
    met = met.join(specific, "__id").where(length == F.col("__most"))
    quoted = F.regexp_replace(F.regexp_replace("__rule", r"([.+?^()\[\]{}|\\])", r"\\$1"), r"\*", ".*")
    pattern = F.concat(F.lit("^"), F.when(F.endswith("__rule", F.lit("$")), quoted).otherwise(F.concat(F.regexp_replace(quoted, r"\$", r"\\$"), F.lit(".*"))))
    hits = met.where(F.regexp_like("__path", pattern))
    best = hits.groupBy("__id").agg(F.max_by("allow", F.struct(F.length("__rule"), "allow")).alias("allowed"))
    return wanted.join(best, "__id", "left").select(*requests.columns, F.coalesce("allowed", F.lit(True)).alias("allowed"))


def page_category(url: Column, title: Column) -> Column:
    """A page's kind by its address, then by its title."""
    from podium.functions.web import link_kind

    by_url = link_kind(slug(url, "-"))
    return F.when(by_url != "other", by_url).otherwise(link_kind(title))
