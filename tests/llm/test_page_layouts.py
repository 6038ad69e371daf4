"""Pages written by hand after layouts that are common on the web, apart from the labeller's own samples.

In a layout, ``[n]`` is the n-th text below and belongs to the article; ``{...}`` belongs to it as well.
"""

import re

import pytest

from podium.llm import html_text

PROSE = """
The old harbour lies an hour north of the town, behind a long wall of grey stone that was built after the flood of 1871. Fishermen still mend their nets there on quiet mornings, although most of the boats have long been sold, and the cold store is a museum now.
When the committee met again in March, nobody expected that the bridge would be on the agenda. The engineers had warned twice that the eastern pier was moving, but the money had gone to the new school, and the mayor was not inclined to reopen the question before the election.
Short winters are hard on the apple growers of the valley. Trees that do not rest long enough flower unevenly, and a single night of frost in April can take half of the crop. Some growers have begun to plant almonds instead.
She left the university without a degree and worked for eleven years as a printer's assistant, setting type for theatre bills and seed catalogues. It was there, she said later, that she learned how much white space a page can bear.
A compiler turns a program into another that does the same. What counts as the same is a surprisingly difficult question: results must agree, of course, but so must the order in which they appear, and sometimes the time that they take.
The second movement opens with a single oboe, answered from far off by the horns. Listeners at the first performance took it for a mistake in the parts, and the conductor had to lay down his baton and start again.
Bread made with rye rises less than bread made with wheat, because its proteins do not form the same elastic network. Bakers therefore rely on acidity: a sour dough slows the enzymes that would otherwise turn the crumb into a sticky paste.
Three expeditions tried to reach the plateau before the war. The first turned back for lack of water, the second lost its mules in a ravine, and of the third only a notebook was found, wrapped in oilcloth under a cairn.
Glass is often called a liquid that flows very slowly, but that is a legend. Old window panes are thicker at the bottom because of how they were made and mounted, not because they have sagged over the centuries.
In the summer of 1954 the station measured the highest tide on record. The keeper wrote in his log that the water stood a hand's breadth below the lamp, and that he had carried the spare mantles to the upper landing as a precaution.
Most of the letters are undated, which makes it hard to follow their quarrel. From the paper and the ink one can tell that at least four of them were written in the same week, probably at the inn where both were waiting for the ferry.
The committee recommends that the archive be kept together and that copies be made of the fragile volumes. It does not recommend that the collection be moved, since the damp of the present building has proved less harmful than the journey would be.
Owls hunt by sound as much as by sight. The feathers around the face gather noise like a dish, and one ear sits higher than the other, so that the bird can tell not only from which side a rustle comes but from how far below.
By the third day the queue reached around the square and into the market street. People brought folding chairs, and somebody had set up a stove for tea. Nobody could say any more what exactly was being given out at the counter.
The theorem says that every map can be coloured with four colours so that neighbours differ. Its proof was the first of note that nobody could check by hand, for it rests on a computer's patient walk through hundreds of cases.
Paint the first coat thin and let it dry for a full day before you sand it. If you can still smell the solvent, wait. The second coat may be thicker, but keep a wet edge, and do not go back over a place once it has begun to set.
""".strip().split("\n")
SHORT = ["It did not last.", "Nobody answered.", "That was all, for the moment.", "The rest is well known.", "Prices rose again in May.", "He never came back."]

LAYOUTS = {
    "classic theme": '<body class="home blog"><div id="page" class="hfeed site"><header id="masthead" class="site-header"><h1 class="site-title"><a href="/">Stone and Tide</a></h1><p class="site-description">Notes from the coast</p><nav id="site-navigation"><ul><li><a href="/">Home</a></li><li><a href="/about">About</a></li></ul></nav></header><div id="primary" class="content-area"><h1 class="entry-title">{The harbour wall}</h1><div class="entry-content"><p>[0]</p><p>[1]</p><p>[s0]</p><p>[2]</p></div></div><aside id="secondary" class="widget-area"><h3>Recent posts</h3><ul><li><a href="/1">A walk in the fog</a></li><li><a href="/2">Salt</a></li></ul></aside><footer id="colophon"><p>Proudly powered by software</p></footer></div></body>',
    "columns by name": '<div class="wrap"><div class="col4"><ul><li><a href="/a">Overview</a></li><li><a href="/b">Members</a></li><li><a href="/c">Minutes</a></li></ul></div><div class="col8"><h2>{Minutes of March}</h2><p>[1]</p><p>[11]</p><p>[13]</p></div></div>',
    "bare wrapper": '<div id="wrapper"><p>[3]</p><p>[4]</p><p>[s1]</p><p>[5]</p></div>',
    "divs in a div": '<div class="x"><div>[6]</div><div>[7]</div><div>[8]</div></div>',
    "news theme": '<div class="td-header-wrap"><div class="td-menu"><ul><li><a href="/">News</a></li><li><a href="/s">Sport</a></li></ul></div></div><div class="td-container"><div class="td-pb-row"><div class="td-pb-span8 td-main-content"><div class="td-ss-main-content"><h1 class="entry-title">{A tide on record}</h1><div class="td-post-content"><p>[9]</p><p>[10]</p><p>[13]</p></div></div></div><div class="td-pb-span4 td-main-sidebar"><div class="td-ss-main-sidebar"><div class="block-title"><span>Most read</span></div><div class="td-module"><h3><a href="/1">Ferry cancelled for a week</a></h3></div><div class="td-module"><h3><a href="/2">New roof for the chapel</a></h3></div></div></div></div></div><div class="td-footer-wrapper">© The Herald</div>',
    "encyclopaedia": '<div id="mw-navigation"><div class="portlet"><h3>Navigation</h3><ul><li><a href="/m">Main page</a></li><li><a href="/r">Random article</a></li></ul></div></div><div id="content" class="mw-body"><h1 id="firstHeading">{Rye bread}</h1><div id="bodyContent"><div id="mw-content-text"><div class="mw-parser-output"><p>[6]</p><h2>{History}</h2><p>[3]</p><p>[10]</p></div></div></div></div><div id="footer"><ul><li>This page was last edited on 3 May.</li><li><a href="/p">Privacy policy</a></li></ul></div>',
    "table layout": '<table width="100%"><tr><td colspan="2"><a href="/">Home</a> | <a href="/n">News</a> | <a href="/l">Links</a></td></tr><tr><td width="150"><a href="/1">Trees</a><br><a href="/2">Birds</a><br><a href="/3">Fish</a></td><td><h1>{Owls}</h1><p>[12]</p><p>[2]</p><p>[8]</p></td></tr><tr><td colspan="2">Last changed by the webmaster. Copyright 2003.</td></tr></table>',
    "font tags": '<center><font size="6">{The Third Expedition}</font></center><hr><font face="Times">[7]<br><br>[9]<br><br>[10]</font><hr><center><a href="index.htm">Back</a> <a href="mailto:x">Mail me</a></center>',
    "article tag": '<nav><a href="/">Home</a><a href="/b">Blog</a></nav><article><h1>{Rest}</h1><p>[2]</p><p>[s2]</p><p>[6]</p></article><footer><p>All rights reserved.</p></footer>',
    "main tag": '<header><a href="/">Logo</a></header><main><h1>{Four colours}</h1><p>[14]</p><p>[4]</p></main><aside><h2>Related</h2><ul><li><a href="/1">Graphs for all</a></li></ul></aside>',
    "story body": '<div class="header-nav"><a href="/">Front</a> <a href="/w">World</a></div><section class="story-body"><h1>{The queue}</h1><p>[13]</p><p>[1]</p><p>[s3]</p></section><div class="more-on"><h3>More on this story</h3><ul><li><a href="/1">Tea for everybody</a></li></ul></div>',
    "app root": '<div id="root"><div class="css-1dbjc4n"><div class="css-901oao r-1awozwy"><a href="/">Start</a><a href="/me">Profile</a></div><div class="css-18t94o4"><div class="css-76zvg2"><div><h1>{White space}</h1><p>[3]</p><p>[15]</p><p>[5]</p></div></div></div></div></div>',
    "six wrappers": '<div><div id="a1"><div class="k9"><div><div class="zz top"><div><p>[0]</p><p>[11]</p><p>[14]</p></div></div></div></div></div></div><div class="ft">© 2019 Example. <a href="/i">Imprint</a></div>',
    "documentation": '<div class="wy-grid-for-nav"><nav class="wy-nav-side"><ul><li class="toctree-l1"><a href="/i">Installation</a></li><li class="toctree-l1"><a href="/q">Quick start</a></li><li class="toctree-l1"><a href="/a">API</a></li></ul></nav><section class="wy-nav-content-wrap"><div class="rst-content"><div role="navigation"><ul><li><a href="/">Docs</a></li></ul></div><div role="main" class="document"><h1>{Passes}</h1><p>[4]</p><p>[14]</p><pre>{make all check}</pre><p>[15]</p></div></div><footer><p>© Copyright 2020.</p></footer></section></div>',
    "magazine": '<div class="site-nav"><span><a href="/">Issues</a></span><span><a href="/s">Subscribe</a></span></div><div class="longform"><div class="headline">{Waiting for the Ferry}</div><div class="text-block"><p>[10]</p></div><div class="text-block"><p>[3]</p></div><div class="newsletter-box"><p>Subscribe to our newsletter.</p></div><div class="text-block"><p>[13]</p><p>[9]</p></div></div>',
    "blog service": '<div class="navbar section"></div><div class="content-outer"><div class="main-outer"><div class="columns"><div class="column-center-outer"><div class="date-outer"><div class="post-outer"><div class="post hentry"><h3 class="post-title">{Thin coats}</h3><div class="post-body"><div>[15]</div><div><br></div><div>[8]</div><div><br></div><div>[5]</div></div></div></div></div></div><div class="column-right-outer"><div class="sidebar"><div class="widget"><h2>Blog archive</h2><ul><li><a href="/2011">2011</a></li><li><a href="/2010">2010</a></li></ul></div></div></div></div></div></div>',
    "grid framework": '<nav class="navbar navbar-default"><div class="container"><a class="navbar-brand" href="/">Brand</a><ul><li><a href="/p">Pricing</a></li></ul></div></nav><div class="container"><div class="row"><div class="col-md-9"><h1>{Legends about glass}</h1><p>[8]</p><p>[4]</p><blockquote>[s4]</blockquote><p>[6]</p></div><div class="col-md-3"><div class="panel"><div>Categories</div><a href="/a">Physics</a><a href="/b">Myths</a></div></div></div></div>',
    "cookie wall first": '<div class="cookie-consent"><p>We use cookies to improve your experience.</p><button>Accept all</button></div><div class="hdr"><a href="/">Daily</a></div><div class="body-copy"><p>[1]</p><p>[13]</p><p>[11]</p></div>',
    "comments below": '<div id="c"><h1>{Frost}</h1><p>[2]</p><p>[6]</p><p>[0]</p></div><div id="comments"><h3>Comments</h3><div class="comment"><b>ann</b><p>I remember that night, we lost the whole orchard and my father sold the press a year later.</p></div><div class="comment"><b>joe</b><p>Thanks for writing this.</p></div></div>',
    "section paragraphs": '<div class="top"><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></div><div class="qx"><section>[5]</section><section>[7]</section><section>[10]</section></div>',
    "lists in prose": '<div class="mnu"><a href="/">Start</a> · <a href="/t">Tips</a></div><div class="tt"><h1>{Painting a door}</h1><p>[15]</p><ul><li>{a brush of good bristle}</li><li>{two grades of paper}</li></ul><p>[8]</p><p>[4]</p></div>',
    "old column table": '<table><tr><td class="menu"><table><tr><td><a href="/1">Start</a></td></tr><tr><td><a href="/2">Guestbook</a></td></tr></table></td><td class="text"><p>[9]</p><p>[7]</p><p>[0]</p></td></tr></table>',
    "portal": '<div class="portal-header"><div class="lang"><a href="/de">Deutsch</a> <a href="/fr">Français</a></div><div class="search"><form><label>Search</label><input><button>Go</button></form></div></div><div class="portal-body"><div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/c">Committees</a></div><div class="txt"><h2>{Recommendation}</h2><p>[11]</p><p>[1]</p></div></div><div class="portal-footer"><a href="/imp">Imprint</a> <a href="/acc">Accessibility</a></div>',
    "recipe": '<div id="hd"><a href="/">Kitchen</a></div><div id="bd"><div class="recipe"><h1>{Sour rye}</h1><div class="summary">[6]</div><div class="steps"><p>[15]</p><p>[s5]</p><p>[2]</p></div></div></div><div id="ft"><p>Copyright 2012 Kitchen. All rights reserved.</p></div>',
    "share bar inside": '<div class="outer"><div class="inner"><h1>{Letters}</h1><div class="share-buttons"><a href="/f">Share</a><a href="/t">Tweet</a></div><p>[10]</p><p>[3]</p><div class="advert">Advertisement</div><p>[9]</p><p>[5]</p></div></div>',
    "related cards": '<div class="page"><div class="post-full"><p>[12]</p><p>[8]</p><p>[14]</p></div><div class="read-next"><h4>Read next</h4><div class="card"><a href="/1"><h3>The lamp room</h3></a><p>Why keepers slept by day.</p></div><div class="card"><a href="/2"><h3>Salt on glass</h3></a><p>Cleaning a lens in winter.</p></div></div></div>',
    "question": '<div class="topbar"><a href="/q">Questions</a><a href="/t">Tags</a></div><div class="question"><h1>{Is glass a liquid?}</h1><div class="prose">[8]</div><div class="prose">[4]</div></div><div class="foot"><a href="/l">Legal</a></div>',
    "press release": '<div id="nav"><a href="/">Company</a> <a href="/p">Press</a></div><div id="release"><p>[1]</p><p>[11]</p><p>[13]</p></div><div id="bottom"><form><p>Sign up for updates</p><input><button>Subscribe</button></form><p>© Company 2015</p></div>',
    "plain text": "<h1>{Notes}</h1>[0]<p>[5]<p>[7]<p>[s1]<p>[12]",
    "amp": '<amp-sidebar><ul><li><a href="/">Home</a></li></ul></amp-sidebar><div class="amp-wp-article"><div class="amp-wp-article-content"><p>[14]</p><p>[2]</p><p>[11]</p></div></div><div class="amp-wp-footer"><p>Back to top</p></div>',
    "wiki of a club": '<div class="sb"><h4>Pages</h4><ul><li><a href="/1">Rules</a></li><li><a href="/2">Trips</a></li><li><a href="/3">Gear</a></li></ul></div><div class="pg"><h1>{The plateau}</h1><p>[7]</p><h2>{Water}</h2><p>[0]</p><p>[9]</p></div>',
    "content last": '<div class="r"><div class="l1"><p><a href="/a">Archive</a></p><p><a href="/b">Links</a></p><p><a href="/c">Feed</a></p></div><div class="l2"><div class="q7"><h2>{Oboe}</h2><div class="u"><p>[5]</p><p>[3]</p><p>[10]</p></div></div></div></div>',
    "legal bottom": '<div class="frame"><div class="lead"><p>[13]</p></div><div class="copy"><p>[1]</p><p>[2]</p></div><div class="legal"><p>© 2020 The Frame Company. Terms of use. Privacy policy. All rights reserved.</p></div></div>',
    "linked prose": '<ul class="m"><li><a href="/1">Maps</a></li><li><a href="/2">Routes</a></li></ul><div class="v"><p>The <a href="/h">old harbour</a> lies an hour north of <a href="/t">the town</a>, and who wants to see it should start early, take <a href="/b">bread</a> along and keep to the upper path, since the lower one floods at noon.</p><p>[9]</p><p>[0]</p></div>',
}


def page(layout):
    """The layout's html, and the texts of its article blocks."""
    text = re.sub(r"\[(s?)(\d+)\]", lambda m: "{" + (SHORT if m[1] else PROSE)[int(m[2])] + "}", layout)
    article = [re.sub(r"\s+", " ", x) for x in re.findall(r"\{(.*?)\}", text, flags=re.S)]
    if "old harbour</a>" in layout:
        article.append(re.sub(r"<.*?>", "", layout[layout.index("The <a") : layout.index("noon.") + 5]))
    return "<!DOCTYPE html><html><head><title>t</title></head><body>" + re.sub(r"[{}]", "", text) + "</body></html>", article


@pytest.fixture(scope="module")
def results():
    pages = {name: page(layout) for name, layout in LAYOUTS.items()}
    found = html_text.extract([html for html, _ in pages.values()], html_text.trained())
    return {name: (text.split("\n") if text else [], article) for (name, (_, article)), text in zip(pages.items(), found)}


def test_blocks_of_all_layouts(results):
    right = sum(len(set(got) & set(want)) for got, want in results.values())
    returned, wanted = sum(len(got) for got, _ in results.values()), sum(len(want) for _, want in results.values())
    f1 = 2 * right / (returned + wanted)
    worst = {name: (set(want) - set(got), set(got) - set(want)) for name, (got, want) in results.items() if set(got) != set(want)}
    assert f1 >= 0.95, (f1, worst)


def test_long_prose_is_never_lost(results):
    for name, (got, want) in results.items():
        missing = [text for text in want if len(text.split()) > 30 and text not in got]
        assert got and len(missing) <= len(want) // 4, (name, missing)
