"""The elements of web pages as tables of nested intervals.

A page becomes its text and an array of elements, each with its number in document order, the
number of its last descendant, and the stretch of the text that it holds.  So "within a footer" and
"a list item in an article" compare numbers, and an element's text is a substring: all of it in
Spark SQL, row by row, without joins.

An element's text is that of its text nodes, end to end: neither a line break nor an inner block parts words.

Defined results: a null or empty page has no elements and an empty text; elements left open end
with their parent, stray end tags are ignored; what ``dropped`` elements hold is in neither; a
``dropped`` element that never closes drops the rest of its parent; repeated rows are read each;
an empty table gives an empty result; other columns pass through, but ``page_text`` and ``elements`` are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Fixed values of HTML: elements without content, those that a paragraph ends at, and what an element of a kind ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table tbody td tfoot th thead tr ul".split())
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "tbody": ("tbody thead tfoot tr td th", "table"), "tfoot": ("tbody thead tr td th", "table"), "option": ("option", "select")}
ENDED = {tag: (frozenset(ends.split()), frozenset(stops.split())) for tag, (ends, stops) in ENDS.items()}
DROPPED = ("script", "style", "noscript", "svg", "nav", "footer")
#: Where running text stands.
PROSE = ("main p", "main li", "main dd", "main td", "article p", "article li", "body p", "body li", "body dd", "body td")
SHORTEST, LONGEST = 20, 700

ELEMENT = "struct<number: int, stop: int, depth: int, tag: string, begin: int, finish: int>"


class _Tree(HTMLParser):
    """Elements as [number, stop, depth, tag, begin, finish] in document order."""

    def __init__(self, dropped: frozenset[str]) -> None:
        super().__init__(convert_charrefs=True)
        self.dropped = dropped
        self.elements: list[list] = []
        self.open: list[int] = []
        self.parts: list[str] = []
        self.size = 0
        self.hidden: str | None = None  # the dropped element that is open
        self.nested: Counter[str] = Counter()  # elements open inside it

    def _close(self, keep: int) -> None:
        while len(self.open) > keep:
            element = self.elements[self.open.pop()]
            element[1], element[5] = len(self.elements) - 1, self.size

    def _end_open(self, tags: frozenset[str], stops: frozenset[str]) -> None:
        """Closes down to the outermost open element of ``tags`` that no element of ``stops`` parts from here."""
        keep = None
        for place in range(len(self.open) - 1, -1, -1):
            tag = self.elements[self.open[place]][3]
            if tag in stops:
                break
            if tag in tags:
                keep = place
        if keep is not None:
            self._close(keep)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.hidden:
            if tag not in VOID:
                self.nested[tag] += 1
            return
        if tag in BLOCKS:
            self._end_open(frozenset(("p",)), frozenset(("table", "td", "th", "button", "object")))
        if tag in ENDED:
            self._end_open(*ENDED[tag])
        if tag in self.dropped:
            self.hidden, self.nested = tag, Counter()
            return
        number = len(self.elements)
        self.elements.append([number, number, len(self.open), tag, self.size, self.size])
        if tag not in VOID:
            self.open.append(number)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if not self.hidden and (tag in VOID or tag not in self.dropped):
            self.handle_starttag(tag, attrs)
        if not self.hidden and tag not in VOID and self.open and self.elements[self.open[-1]][3] == tag and tag not in BLOCKS:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if self.nested[tag]:
                self.nested[tag] -= 1
                return
            if tag != self.hidden and not any(self.elements[k][3] == tag for k in self.open):
                return
            stops, self.hidden = tag == self.hidden, None  # its own end, or that of an element around it
            if stops:
                return
        for place in range(len(self.open) - 1, -1, -1):
            if self.elements[self.open[place]][3] == tag:
                self._close(place)
                break

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            self.size += len(data)


def read(html: str, dropped: frozenset[str] = frozenset(DROPPED)) -> tuple[str, list[list]]:
    parser = _Tree(dropped)
    parser.feed(html)
    parser.close()
    parser._close(0)
    return "".join(parser.parts), parser.elements


def trees(pages: DataFrame, markup: str = "html", dropped: tuple[str, ...] = DROPPED) -> DataFrame:
    """``pages`` with ``page_text`` and ``elements`` in place of the markup; places in the text count code points."""
    rest = pages.drop("page_text", "elements")
    others = [c for c in rest.columns if c != markup]
    fields = ("number", "stop", "depth", "tag", "begin", "finish")
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32())
    unseen = frozenset(dropped)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = [read(html or "", unseen) for html in rows.column(rows.schema.get_field_index(markup)).to_pylist()]
                flat = [element for _, elements in found for element in elements]
                ends = [0]
                for _, elements in found:
                    ends.append(ends[-1] + len(elements))
                columns = pa.StructArray.from_arrays([pa.array([e[k] for e in flat], kind) for k, kind in enumerate(kinds)], fields)
                made = [pa.array([text for text, _ in found], pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), columns)]
                yield pa.RecordBatch.from_arrays([*(rows.column(rows.schema.get_field_index(c)) for c in others), *made], [*others, "page_text", "elements"])

    made = StructType.fromDDL(f"page_text string, elements array<{ELEMENT}>")
    return rest.mapInArrow(run, StructType([*rest.select(*others).schema.fields, *made.fields]))


def within(inner: Column, outer: Column) -> Column:
    """Whether one element stands in another."""
    return (outer["number"] < inner["number"]) & (inner["stop"] <= outer["stop"])


def selected(elements: Column, selector: str) -> Column:
    """The elements (array) that a selector of element names names: "p", "article li", "main section p"."""
    def named(tag: str) -> Column:
        return F.filter(elements, lambda e: e["tag"] == tag)

    def inside(inner: Column, outer: Column) -> Column:
        return F.filter(inner, lambda e: F.exists(outer, lambda o: within(e, o)))

    first, *rest = selector.split()
    return reduce(lambda found, tag: inside(named(tag), found), rest, named(first))


def content(text: Column, element: Column) -> Column:
    """An element's text, white space collapsed."""
    return F.trim(F.regexp_replace(F.substring(text, element["begin"] + 1, element["finish"] - element["begin"]), r"\s+", " "))


def prose_blocks(tree: DataFrame, selectors: tuple[str, ...] = PROSE, shortest: int = SHORTEST, longest: int = LONGEST) -> DataFrame:
    """``place`` and ``block`` for each row of ``trees``: the distinct texts, of a length that is neither a
    menu's nor an article's, of the elements that the selectors name, in document order."""
    found = F.array_distinct(F.concat(*(selected(F.col("elements"), s) for s in selectors)))
    ordered = F.array_sort(found)
    kept = tree.withColumn("__found", ordered).withColumn("__texts", F.transform("__found", lambda e: content(F.col("page_text"), e)))
    blocks = F.array_distinct(F.filter("__texts", lambda t: F.length(t).between(shortest, longest)))
    return kept.select(*[c for c in tree.columns if c not in ("page_text", "elements")], F.posexplode(blocks).alias("place", "block"))


def nodes(tree: DataFrame) -> DataFrame:
    """A row an element: number, stop, depth, tag and its text."""
    rows = tree.select("*", F.explode("elements").alias("__e"))
    kept = [c for c in tree.columns if c not in ("page_text", "elements")]
    return rows.select(*kept, "__e.number", "__e.stop", "__e.depth", "__e.tag", content(F.col("page_text"), F.col("__e")).alias("text"))


def outline(tree: DataFrame, headings: tuple[str, ...] = ("h1", "h2", "h3", "h4", "h5", "h6")) -> DataFrame:
    """``place``, ``level`` and ``heading`` of each page's headings."""
    found = F.filter("elements", lambda e: reduce(lambda x, y: x | y, (e["tag"] == h for h in headings)))
    rows = tree.select("*", F.posexplode(found).alias("place", "__e"))
    kept = [c for c in tree.columns if c not in ("page_text", "elements")]
    return rows.select(*kept, "place", F.substring("__e.tag", 2, 1).cast("int").alias("level"), content(F.col("page_text"), F.col("__e")).alias("heading"))
