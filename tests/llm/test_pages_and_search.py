import random
import time
import zlib

import numpy as np
import pytest

from podium.llm import html_text, mtree

PAGE = """<html><head><title>T</title><script>var x="<p>no</p>";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></nav><div class="ad">Buy   now</div>
<article><h1>A &amp; B</h1><p>First&nbsp;one,<b> bold<br><p>second
line &lt;kept&gt; &amp;amp;</p><ul><li>item one</li><li>item two</li></ul></article>
<section class="comments"><p>I agree with all of this</p></section><footer>&copy; 2024 Someone</footer>"""


@pytest.fixture(scope="module")
def model():
    return html_text.trained()


def test_labeller_on_unseen_layouts(model):
    right = total = whole = pages = 0
    for html, labels in html_text.sample_pages(150, seed=77):
        page = html_text.blocks(html)
        if page:
            got = model.scores(*html_text.padded([html_text.vectors(page)]))[0] >= 0
            right, total = right + (got == np.array(labels)).sum(), total + len(labels)
            whole, pages = whole + (got == np.array(labels)).all(), pages + 1
    assert right / total > 0.99 and whole / pages > 0.95


def test_extract(model):
    assert html_text.extract([PAGE, "", "<p>", "no markup at all", "<div" * 500, "</p></div>" * 50], model)[0] == (
        "A & B\nFirst one, bold\nsecond line <kept> &amp;\nitem one\nitem two"
    )


def test_unclosed_markup_hides_nothing(model):
    page = "<article><p>one</p>%s<p>two words here</p><p>three</p></article>"
    for tag in ("iframe src=x", "noscript", "object", "svg", "canvas", "template", "title"):
        got = [text for _, text, _ in html_text.blocks(page % f"<{tag}>")]
        assert got == ["one", "two words here", "three"], tag
        assert [text for _, text, _ in html_text.blocks(page % f"<{tag}><p>hidden</p></{tag.split()[0]}>")] == ["one", "two words here", "three"]
    assert [t for _, t, _ in html_text.blocks(page % "<noscript><iframe></noscript><svg><p>kept</p>")] == ["one", "kept", "two words here", "three"]
    assert [t for _, t, _ in html_text.blocks(page % "<script>if (a < b) {")] == ["one"]


def test_all_words_of_a_block_count():
    head = "word " * 40
    a, b = (html_text.vectors([(html_text.Path(), (head + tail).strip(), 0)]) for tail in ("alpha beta " * 30, "gamma delta " * 30))
    assert (a != b).any()


def test_time_grows_with_the_length():
    def took(html):
        at = time.process_time()
        found = html_text.blocks(html)
        html_text.vectors(found)
        return time.process_time() - at

    for unit in ("<div>x", "<div>x</span></p>", "<svg>x"):
        took(unit * 2000)
        small, large = (min(took(unit * n) for _ in range(3)) for n in (4000, 16000))
        assert large < 10 * small, unit


def test_a_long_page_is_labelled_whole(model, monkeypatch):
    page = PAGE.replace("<ul><li>item one", "".join(f"<p>paragraph {i} of many more words.</p>" for i in range(500)) + "<ul><li>item one")
    whole = html_text.extract([page], model)
    monkeypatch.setattr(html_text, "LONG", 64)
    assert html_text.extract([page, PAGE], model)[0] == whole[0] and whole[0].count("paragraph") == 500


def test_query_keeps_articles_and_drops_the_rest(spark):
    """Against the pages' own markup: every paragraph of an article is kept, nothing of footers, adverts and navigation."""
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = html_text.op5_html_extraction(spark, folder).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages) and all(r.n_chars == len(r.text) for r in rows)
    right = total = 0
    for r in rows:
        kept = r.text.split("\n")
        for path, text, _ in html_text.blocks(pages[r.page_id]):
            inside = lambda name: path.slots >> zlib.crc32(name.encode()) % html_text.PATH_SLOTS & 1
            if path.last and path.last[0] in ("footer", "nav"):
                total, right = total + 1, right + (text not in kept)
            elif inside("article") and path.last[-1] == "p" and not inside("aside") and not inside("footer"):
                total, right = total + 1, right + (text in kept)
    assert total > 200 and right / total > 0.97


def test_gradients():
    rng = np.random.default_rng(0)
    net = html_text.Labeller()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = html_text.padded([rng.random((n, html_text.INPUT)) for n in (1, 3, 5)])
    y = (rng.random(mask.shape) < 0.5).astype(float)

    def loss():
        p = 1 / (1 + np.exp(-net.scores(x, mask)))
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    grads = net.gradients(x, mask, y)
    for name in net.p:
        flat, g = net.p[name].reshape(-1), grads[name].reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - g[i]) < 2e-3 * max(1, abs(g[i]))


def test_pages_table(spark, model):
    rows = [(1, "u", PAGE, "clash"), (2, None, None, "c"), (2, None, None, "c"), (None, "u", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extracted(pages).collect()
    assert len(got) == 4 and {r.text for r in got if r.page_id == 2} == {""}
    assert html_text.extracted(pages.where("false")).count() == 0


def brute(rows, every, k):
    ok = [(i, np.floor(np.array(v, float) * 256)) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i is not None and i % every == 0:
            scores = [(-int(sum(int(x) * int(y) for x, y in zip(q, v))), j is None, j or 0) for b, (j, v) in enumerate(ok) if b != a and len(v) == len(q)]
            out += [(i, n + 1, None if none else j, -s) for n, (s, none, j) in enumerate(sorted(scores)[:k])]
    return sorted(map(str, out))


@pytest.mark.parametrize("kind", ["gauss", "clusters", "ties", "wide"])
def test_search_matches_brute_force(spark, kind):
    rng = np.random.default_rng(3)
    n, d = (300, 8)
    made = rng.standard_normal((n, d))
    if kind == "clusters":
        made = made * 0.05 + rng.standard_normal((6, d))[rng.integers(0, 6, n)] * rng.random((n, 1)) * 4
    if kind == "ties":
        made = rng.integers(-1, 2, (n, d)) / 2.0
    if kind == "wide":
        made[:40] *= 1e6
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(made)]
    rows += [(None, rows[5][1]), (50, rows[50][1]), (100, None), (150, [1.0, None]), (7, []), (8, [float("nan")] * d), (9, [float("inf")] * d), (200, [1.0, 2.0]), (3, [0.5, -2.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = mtree.search(mtree.index(df, 120), 50, 5).collect()
    assert sorted(str((r.query_id, r["rank"], r.vec_id, r.score)) for r in got) == brute(rows, 50, 5)


def test_search_prunes():
    rng = np.random.default_rng(1)
    made = np.floor(rng.standard_normal((40, 6))[rng.integers(0, 40, 4000)] * 300 + rng.standard_normal((4000, 6)) * 5)
    tree = mtree.MTree(made, np.arange(4000))
    seen, plain = [0], tree.vectors

    class Counting(np.ndarray):
        def __matmul__(self, other):
            seen[0] += len(self)
            return np.asarray(self) @ other

    tree.vectors = plain.view(Counting)
    for q in range(20):
        tree.search(plain[q], 5, q)
    assert seen[0] < 20 * 4000 * 0.5


def test_cells_rule_each_other_out(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16)) * 3
    made = centres[rng.integers(0, 12, 3000)] + rng.standard_normal((3000, 16)) * 0.02
    df = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in enumerate(made)], "vec_id long, embedding array<double>")
    index = mtree.index(df, 100)
    cells = index.cells[16]
    whole = np.floor(made * 256)
    visited = 0
    for q in range(0, 3000, 50):
        scores = np.sort(whole @ whole[q])[-6]
        visited += len(cells.within(whole[q], float(scores)))
    assert len(cells.pivots) == 30 and visited < 60 * 30 * 0.35
    got = mtree.search(index, 50, 5).collect()
    assert sorted(str((r.query_id, r["rank"], r.vec_id, r.score)) for r in got) == brute([(int(i), list(v)) for i, v in enumerate(made)], 50, 5)


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    got = mtree.op6_mtree_top_k(spark, "/root/testdata/sf0.001").collect()
    assert sorted(str((r.query_id, r["rank"], r.vec_id, r.score)) for r in got) == brute(rows, 50, 5)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert mtree.search(mtree.index(df), 50, 5).count() == 0
