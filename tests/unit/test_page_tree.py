"""Elements as intervals, on pages written by hand."""

from podium.sources import page_tree


def blocks(spark, *pages, **named):
    df = spark.createDataFrame([(k, html, "clash") for k, html in enumerate(pages)], "page int, html string, elements string")
    out = {}
    for r in page_tree.prose_blocks(page_tree.trees(df), shortest=1, **named).orderBy("page", "place").collect():
        out.setdefault(r.page, []).append(r.block)
    return out


def test_navigation_and_footers_are_out_and_blocks_are_distinct(spark):
    page = """<body><nav><div><ul><li>menu one</ul></div><p>menu text</p></nav><div><main><p>First &amp; <b>bold</b>
    text<p>Second<br>line<svg><text>drawn</text></svg><ul><li>item <i>one</i><li>item two<ul><li>inner</ul></ul></main></div>
    <p>First &amp; bold text</p><dl><dt>term<dd>meaning</dl><table><tr><td>cell<td><p>in cell</p></table><footer><p>foot</p></footer><p>last"""
    assert blocks(spark, page, "", None)[0] == ["First & bold text", "Secondline", "item one", "item twoinner", "inner", "meaning", "cell", "in cell", "last"]
    assert set(blocks(spark, page, "", None)) == {0}


def test_lengths_bound_blocks(spark):
    df = spark.createDataFrame([(1, "<body><p>short</p><p>" + "long enough text " * 3 + "</p><p>" + "x" * 701 + "</p><p>" + "y" * 700 + "</p>")], "page int, html string")
    assert [len(r.block) for r in page_tree.prose_blocks(page_tree.trees(df)).collect()] == [50, 700]


def test_intervals_nest(spark):
    html = "<div><ul><li>a<li>b<p>c</ul><p>d<div>e</div></div></b><table><tr><td>f<table><tr><td>g</table><tr><td>h</table>"
    text, elements = page_tree.read(html)
    for number, stop, depth, _, begin, finish in elements:
        for other in elements:
            inside = number < other[0] <= stop
            assert not inside or (other[1] <= stop and begin <= other[4] and other[5] <= finish and other[2] > depth)
    told = {(e[3], text[e[4] : e[5]]) for e in elements}
    assert {("li", "a"), ("li", "bc"), ("p", "d"), ("div", "e"), ("td", "fg"), ("td", "g"), ("td", "h"), ("div", "abcde")} <= told


def test_dropped_elements(spark):
    page = "<body><div><nav><div>x</div><nav>y</nav>z</nav><p>kept one</p></div><div><footer>open<p>gone</div><p>kept two</p><script>if (a<b) '</p>'</script><svg/><p>kept three</p>"
    assert blocks(spark, page)[0] == ["kept one", "kept two", "kept three"]
    assert blocks(spark, page, selectors=("div p",))[0] == ["kept one"]


def test_selectors_and_outline(spark):
    df = spark.createDataFrame([(1, "<main><section><p>a</p></section><p>b</p></main><section><p>c</p></section><h2>Two</h2><h1>One  <i>big</i></h1>")], "page int, html string")
    tree = page_tree.trees(df)
    texts = lambda s: [r.block for r in page_tree.prose_blocks(tree, (s,), 1).collect()]
    assert texts("main section p") == ["a"] and texts("section p") == ["a", "c"] and texts("p") == ["a", "b", "c"] and texts("td p") == []
    assert [(r.level, r.heading) for r in page_tree.outline(tree).collect()] == [(2, "Two"), (1, "One big")]
    rows = page_tree.nodes(tree).collect()
    assert [r.number for r in rows] == list(range(len(rows))) and rows[0].text == "ab"


def test_deep_and_long_pages(spark):
    html = "<div>" * 3000 + "<p>deep</p>" + "</div>" * 3000 + "<body>" + "<p>x y</p>" * 20000
    text, elements = page_tree.read(html)
    assert len(elements) == 23002 and elements[0][1] == 3000 and text.startswith("deep")
    assert page_tree.trees(spark.createDataFrame([], "page int, html string")).count() == 0
