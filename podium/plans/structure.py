"""Queries on the structure of pages and files."""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.plans.base import table
from podium.plans.registry import registry
from podium.sources import documents, page_tree, pdf
from podium.sources.landing import written

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
query = registry(QUERIES, ORACLES)

#: The paragraphs of a page, which end at their end tag, the next paragraph or their article's end.
PARAGRAPHS = r"""bare AS (SELECT page_id, regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<nav\b[^>]*>.*?</nav\s*>|<footer\b[^>]*>.*?</footer\s*>|<!--.*?-->', '', 'g') AS html FROM pages),
pieces AS (SELECT page_id, unnest(string_split(html, '<p>')[2:]) AS piece, generate_subscripts(string_split(html, '<p>')[2:], 1) AS place FROM bare),
paragraphs AS (SELECT page_id, place, trim(regexp_replace(regexp_replace(regexp_extract(piece, '(?s)^(.*?)(?:</p>|</article>|$)', 1), '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS block FROM pieces)"""


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their character references marked: SQL cannot decode them, so texts that had one are left out of comparisons."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", "&", "\u0001&").alias("html"))


@query(f"""WITH {PARAGRAPHS} SELECT page_id, count(DISTINCT block) AS blocks, min(md5(block)) AS least, sum(DISTINCT length(block)) AS sizes FROM paragraphs WHERE length(block) BETWEEN 20 AND 700 AND NOT contains(block, '&') GROUP BY 1""")
def page_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct blocks of running text of pages, navigation and footers out."""
    found = page_tree.prose_blocks(page_tree.trees(_marked(spark, sf_dir))).where(~F.contains("block", F.lit("\u0001")))
    return found.groupBy("page_id").agg(F.count("*").alias("blocks"), F.min(F.md5("block")).alias("least"), F.sum_distinct(F.length("block")).alias("sizes"))


@query(r"""SELECT page_id, len(regexp_extract_all(html, '<li>')) AS listed, len(regexp_extract_all(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'), '<p>')) AS paragraphs,
trim(regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '\s+', ' ', 'g')) AS heading FROM pages WHERE NOT contains(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&')""")
def page_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's list items in navigation, its paragraphs in articles, and its first heading."""
    tree = page_tree.trees(_marked(spark, sf_dir), dropped=("script", "style"))
    counts = [F.size(page_tree.selected(F.col("elements"), s)).cast("long").alias(n) for s, n in (("nav li", "listed"), ("article p", "paragraphs"))]
    first = page_tree.outline(tree).where("place = 0").select("page_id", "heading")
    return tree.select("page_id", *counts).join(first, "page_id").where(~F.contains("heading", F.lit("\u0001")))


ROWS_A_FILE, ROWS_A_PAGE, LEFT, RIGHT = 150, 40, 65.0, 440.0


def _file(pages: list[bytes]) -> bytes:
    """A PDF of the content streams ``pages``, compressed, with a cross-reference table."""
    bodies = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Count %d /Kids [%s] >>" % (len(pages), b" ".join(b"%d 0 R" % (4 + 2 * k) for k in range(len(pages))))]
    bodies.append(b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica /Encoding /WinAnsiEncoding >>")
    for k, page in enumerate(pages):
        packed = zlib.compress(page)
        bodies.append(b"<< /Type /Page /Parent 2 0 R /Resources << /Font << /F1 3 0 R >> >> /Contents %d 0 R >>" % (5 + 2 * k))
        bodies.append(b"<< /Length %d /Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(packed), packed))
    out, places = bytearray(b"%PDF-1.4\n"), []
    for k, body in enumerate(bodies):
        places.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (k + 1, body)
    table = b"".join(b"%010d 00000 n \n" % at for at in places)
    return bytes(out) + b"xref\n0 %d\n0000000000 65535 f \n%strailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(places) + 1, table, len(places) + 1, len(out))


def _printed(group: pd.DataFrame) -> pd.DataFrame:
    """A file that ranks its rows, in print as such lists are: rank, name in two strings, rank again."""
    ordered = group.sort_values("c_custkey")
    quoted = lambda text: text.encode("cp1252").replace(b"\\", b"\\\\").replace(b"(", b"\\(").replace(b")", b"\\)")
    pages = []
    for at in range(0, len(ordered), ROWS_A_PAGE):
        lines = [b"BT /F1 9 Tf 14 TL 1 0 0 1 70 790 Tm (NAME) Tj ET"]
        for k, (name, segment) in enumerate(zip(ordered["c_name"][at : at + ROWS_A_PAGE], ordered["c_mktsegment"][at : at + ROWS_A_PAGE])):
            y = 760 - 14 * k
            lines.append(b"BT /F1 9 Tf 40 %d Td (%d) Tj 30 0 Td (%s) Tj 180 0 Td [(%s) -10 (\\351)] TJ 210 0 Td (%d) Tj ET" % (y, at + k + 1, quoted(name), quoted(f"({segment}) caf"), at + k + 1))
        pages.append(b"\n".join(lines))
    return pd.DataFrame({"file": [int(group["file"].iloc[0])], "content": [_file(pages)]})


@query(f"""WITH c AS (SELECT *, c_custkey // {ROWS_A_FILE} AS file, row_number() OVER (PARTITION BY c_custkey // {ROWS_A_FILE} ORDER BY c_custkey) AS rank FROM customer)
SELECT file || '-' || ((rank - 1) // {ROWS_A_PAGE} + 1) AS page, rank, c_name || ' (' || c_mktsegment || ') café' AS name, rank AS closing FROM c""")
def pdf_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranked lists read from PDF files, which are printed here from ranges of customers."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", F.floor(F.col("c_custkey") / ROWS_A_FILE).alias("file"))
    printed = written(rows.groupBy("file").applyInPandas(_printed, "file long, content binary"), "printed")
    found = pdf.fragments(printed).withColumn("page", F.concat_ws("-", "file", "page"))
    return documents.fragment_rows(found, LEFT, RIGHT)
