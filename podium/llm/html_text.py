"""Main text of web pages: a recurrent labeller over the page's blocks.

A page is parsed into leaf blocks, each with its tag path (tags, classes and ids from the
root).  A bidirectional LSTM in numpy reads hashed tag-path and word vectors of the whole
sequence and labels every block as article or not; so a block's label depends on the whole
page.  It is trained here, on pages made by rule from many layouts (``training_pages``).

Defined results: a null or empty page, or one without article blocks, has an empty text;
character references are decoded once, white space in a block is one space, blocks join by
one newline; of broken markup (unclosed or stray tags) only the tags are ignored, but for a
script or style that never closes, which lasts to the page's end; scripts, styles, comments
and the head are markup and never blocks; pages of any depth and length are read in time in
proportion to their length, and labelled whole; repeated rows are extracted
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.common import table

#: HTML elements by kind.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MARKUP = frozenset("head script style template noscript svg canvas object iframe title".split())
CLOSED_BY_BLOCK = frozenset("p b i em strong u font span a small big".split())

#: Elements that tell what they hold.
TELLING = "nav header footer aside form article main section table td ul ol li dl p h1 h2 h3 h4 blockquote pre figure figcaption button label details".split()
PATH_SLOTS, WORD_SLOTS, SHAPE = 512, 64, 10
HIDDEN = 20
TRAIN_PAGES, EPOCHS, BATCH = 2400, 9, 30
#: Blocks that are labelled together, of several pages or of a part of a long one.
LONG = 20_000


#: Names that page authors give to containers.
NAMES = {
    "nav": "nav navbar menu navigation breadcrumb breadcrumbs topnav mainmenu links pagination pager tabs toc skip".split(),
    "header": "header masthead banner branding logo topbar site head hero".split(),
    "footer": "footer foot bottom copyright legal colophon imprint".split(),
    "aside": "sidebar aside widget rail related recommended popular trending side tags archive more".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense adbox".split(),
    "notice": "cookie consent notice alert gdpr popup modal newsletter subscribe banner paywall warning message".split(),
    "comments": "comments comment discussion replies respond disqus feedback thread reader reply".split(),
    "form": "form search login signup contact survey".split(),
    "social": "share social sharing follow buttons".split(),
    "article": "article content post entry story body main text page prose blog news".split(),
}
KINDS = {name: len(TELLING) + k for k, kind in enumerate(NAMES.values()) for name in kind}
TOLD = len(TELLING) + len(NAMES)
INPUT = PATH_SLOTS + WORD_SLOTS + TOLD + SHAPE


class Path(NamedTuple):
    """The elements around a block, by what the labeller reads of them: sizes do not grow with the depth."""

    slots: int = 0  # a bit for each hashed name
    told: int = 0  # a bit for each telling element and each kind of name
    last: tuple[str, ...] = ()  # the innermost four names
    depth: int = 0

    def inside(self, names: list[str]) -> Path:
        slots, told = self.slots, self.told
        names = [name for name in names if name[0] != "." or name[1:] in KINDS]  # a name of somebody's own tells nothing
        for name in names:
            slots |= 1 << zlib.crc32(name.encode()) % PATH_SLOTS
            kind = KINDS.get(name[1:]) if name[0] == "." else TELLING.index(name) if name in TELLING else None
            told |= 0 if kind is None else 1 << kind
        return Path(slots, told, (*self.last, *names)[-4:], self.depth + 1)


_HUMP = re.compile(r"([a-z])([A-Z])")


class _Blocks(HTMLParser):
    CDATA_CONTENT_ELEMENTS = ("script", "style")
    RCDATA_CONTENT_ELEMENTS = ()

    def __init__(self, unclosed: frozenset[int] = frozenset()) -> None:
        """``unclosed``: the markup elements, by their number, that never close and hide nothing."""
        super().__init__(convert_charrefs=True)
        self.unclosed, self.markup = unclosed, 0
        self.stack: list[tuple[str, Path]] = []
        self.open: Counter[str] = Counter()
        self.hidden: list[tuple[str, int]] = []  # open markup elements and their numbers
        self.open_markup: Counter[str] = Counter()
        self.blocks: list[tuple[Path, str, int]] = []
        self.parts: list[str] = []
        self.links = 0  # words of the block inside links
        self.anchor = -1  # elements open around an open link
        self.path = Path()

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((self.path, text, self.links))
        self.parts, self.links = [], 0
        self.path = self.stack[-1][1] if self.stack else Path()

    def pop(self) -> str:
        tag, _ = self.stack.pop()
        self.open[tag] -= 1
        if len(self.stack) < self.anchor:
            self.anchor = -1
        return tag

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in MARKUP:
            self.markup += 1
            if tag != "head" and self.markup not in self.unclosed:
                self.hidden.append((tag, self.markup))
                self.open_markup[tag] += 1
            return
        if self.hidden:
            return
        if tag in INLINE:
            if tag == "a":
                self.anchor = len(self.stack)
            return
        if tag not in ("br", "hr") and self.stack and self.stack[-1][0] == "p":
            self.pop()
        if tag in ("li", "option", "dt", "dd", "tr", "td", "th") and self.stack and self.stack[-1][0] == tag:
            self.pop()
        if tag not in VOID:
            names = [tag]
            for key, value in attrs:
                if key in ("class", "id", "role") and value:
                    names += [f".{x}" for x in _HUMP.sub(r"\1 \2", value).lower().replace("_", "-").replace("-", " ").split()]
            self.stack.append((tag, (self.stack[-1][1] if self.stack else Path()).inside(names)))
            self.open[tag] += 1
        self.flush()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in MARKUP:
            return
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in MARKUP:
            if self.open_markup[tag]:  # what was opened inside goes with it
                while (last := self.hidden.pop()[0]) != tag:
                    self.open_markup[last] -= 1
                self.open_markup[tag] -= 1
            return
        if tag == "a":
            self.anchor = -1
        if self.hidden or tag in INLINE or tag in VOID:
            return
        if self.open[tag]:
            while self.pop() != tag:
                pass
        self.flush()

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)
            if self.anchor >= 0:
                self.links += len(data.split())


def blocks(html: str) -> list[tuple[Path, str, int]]:
    """(tag path, text, linked words) of the page's leaf blocks in page order."""
    unclosed: frozenset[int] = frozenset()
    for _ in range(2):
        parser = _Blocks(unclosed)
        parser.feed(html)
        parser.close()
        parser.flush()
        unclosed = frozenset(number for tag, number in parser.hidden if tag not in parser.CDATA_CONTENT_ELEMENTS)
        if not unclosed:
            break
    return parser.blocks


def vectors(page: list[tuple[Path, str, int]]) -> np.ndarray:
    """Hashed tag-path and word vectors and a few shape values, a row a block."""
    out = np.zeros((len(page), INPUT), np.float32)
    crc = zlib.crc32
    for row, (path, text, links) in zip(out, page):
        row[:PATH_SLOTS] = np.unpackbits(np.frombuffer(path.slots.to_bytes(PATH_SLOTS // 8, "little"), np.uint8), bitorder="little")
        for name in path.last:  # the innermost elements once more, as such
            row[crc(f"{name}<".encode()) % PATH_SLOTS] = 1
        words = text.lower().encode().split()
        n = len(words)
        slots = np.fromiter(map(crc, words), np.uint32, n) % WORD_SLOTS
        row[PATH_SLOTS : PATH_SLOTS + WORD_SLOTS] = np.bincount(slots, minlength=WORD_SLOTS) / (2 * max(1, n))
        at = PATH_SLOTS + WORD_SLOTS
        row[at : at + TOLD] = [path.told >> k & 1 for k in range(TOLD)]
        stops = text.count(". ") + text.count("? ") + text.count("! ") + text.count(", ")
        shape = [n < 4, n < 10, n > 25, min(links, n) / max(n, 1), links >= n, text[-1] in ".!?", min(stops, 8) / 8, path.depth / 10, np.log1p(n) / 6, 1]
        row[-SHAPE:] = shape
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM with a logistic output on both directions' states."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.p = {}
        for d in "fb":
            self.p[f"w{d}"] = (rng.standard_normal((INPUT, 4 * HIDDEN)) * 0.08).astype(np.float32)
            self.p[f"u{d}"] = (rng.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.15).astype(np.float32)
            self.p[f"c{d}"] = np.zeros(4 * HIDDEN, np.float32)
            self.p[f"c{d}"][HIDDEN : 2 * HIDDEN] = 1
        self.p["o"] = (rng.standard_normal(2 * HIDDEN) * 0.1).astype(np.float32)
        self.p["z"] = np.zeros(1, np.float32)

    def _before(self, x: np.ndarray, d: str) -> np.ndarray:
        """What the blocks themselves bring to the gates."""
        return (x.reshape(-1, INPUT) @ self.p[f"w{d}"] + self.p[f"c{d}"]).reshape(*x.shape[:2], -1)

    def _run(self, pre: np.ndarray, mask: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States (pages, blocks, HIDDEN) of one direction; padding leaves the state as it is."""
        pages, steps, _ = pre.shape
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros_like(h)
        out = np.zeros((pages, steps, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = pre[:, t] + h @ self.p[f"u{d}"]
            i, f, o = (_sigmoid(g[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            n = np.tanh(g[:, 3 * HIDDEN :])
            m = mask[:, t, None]
            c_new = f * c + i * n
            tanh_c = np.tanh(c_new)
            h_new = o * tanh_c
            if keep is not None:
                keep.append((t, h, c, i, f, o, n, tanh_c))
            c = np.where(m, c_new, c)
            h = np.where(m, h_new, h)
            out[:, t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._run(self._before(x, d), mask, d, None) for d in "fb"], axis=2)
        return both @ self.p["o"] + self.p["z"]

    def long_scores(self, page: list[tuple[Path, str, int]]) -> np.ndarray:
        """The same for one page of very many blocks, whose vectors are made a part at a time."""
        score = np.full(len(page), self.p["z"][0], np.float32)
        for k, d in enumerate("fb"):
            parts = [self._before(vectors(page[at : at + LONG])[None], d) for at in range(0, len(page), LONG)]
            states = self._run(np.concatenate(parts, axis=1), np.ones((1, len(page)), np.float32), d, None)
            score += states[0] @ self.p["o"][k * HIDDEN : (k + 1) * HIDDEN]
        return score

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        kept: dict[str, list] = {"f": [], "b": []}
        states = {d: self._run(self._before(x, d), mask, d, kept[d]) for d in "fb"}
        both = np.concatenate([states["f"], states["b"]], axis=2)
        error = (_sigmoid(both @ self.p["o"] + self.p["z"]) - y) * mask / mask.sum()
        grads = {"o": np.einsum("pt,pth->h", error, both), "z": np.array([error.sum()])}
        for k, d in enumerate("fb"):
            dh_out = error[:, :, None] * self.p["o"][k * HIDDEN : (k + 1) * HIDDEN]
            dpre = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            du = np.zeros_like(self.p[f"u{d}"])
            dh = np.zeros((x.shape[0], HIDDEN), np.float32)
            dc = np.zeros_like(dh)
            for t, h, c, i, f, o, n, tanh_c in reversed(kept[d]):
                m = mask[:, t, None]
                dh = dh + dh_out[:, t]
                live = dh * m
                dct = dc * m + live * o * (1 - tanh_c**2)
                g = np.concatenate([dct * n * i * (1 - i), dct * c * f * (1 - f), live * tanh_c * o * (1 - o), dct * i * (1 - n**2)], axis=1)
                dpre[:, t] = g
                du += h.T @ g
                dh = dh * (1 - m) + g @ self.p[f"u{d}"].T
                dc = dc * (1 - m) + dct * f
            flat = dpre.reshape(-1, 4 * HIDDEN)
            grads |= {f"w{d}": x.reshape(-1, INPUT).T @ flat, f"u{d}": du, f"c{d}": flat.sum(axis=0)}
        return grads

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 5) -> None:
        """Adam over batches of pages."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(pages))
            lots = [sorted(order[at : at + 10 * BATCH], key=lambda i: len(pages[i][1])) for at in range(0, len(order), 10 * BATCH)]
            batches = [lot[at : at + BATCH] for lot in lots for at in range(0, len(lot), BATCH)]  # of like lengths: little padding
            for k in rng.permutation(len(batches)):
                x, mask = padded([pages[i][0] for i in batches[k]])
                y = np.zeros(mask.shape, np.float32)
                for row, i in zip(y, batches[k]):
                    row[: len(pages[i][1])] = pages[i][1]
                step += 1
                for k, g in self.gradients(x, mask, y).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    rate = 0.02 * (1 - epoch / epochs)
                    self.p[k] -= (rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(1, max(len(p) for p in pages))
    x = np.zeros((len(pages), steps, INPUT), np.float32)
    mask = np.zeros((len(pages), steps), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
        mask[k, : len(p)] = 1
    return x, mask


SYLLABLES = "an ar be ci da de en er es fi ga he in is ka la le lo ma me mi mo na ne no on or pa pe qu ra re ri ro sa se si so ta te ti to tra un ur va ve vi wo zu ß ö é ñ th sch".split()


def training_pages(count: int = TRAIN_PAGES, seed: int = 11) -> Iterator[tuple[str, list[bool]]]:
    """Pages made by rule, and for each of their blocks whether it is article text: in turn plain and wild ones."""
    for plain, wild in zip(sample_pages(count // 2, seed), wild_pages(count // 2, seed + 1)):
        yield plain
        yield wild


#: What boilerplate says, and names that tell nothing.
PHRASES = {
    "nav": ["Home", "About us", "Contact", "News", "Products", "Log in", "Sign up", "Help", "FAQ", "Next page", "Previous", "Careers", "Forum", "Search", "Archives", "Shop", "Blog", "Menu"],
    "footer": ["Copyright 2024 All rights reserved.", "© 2021 Example Ltd.", "Privacy policy", "Terms of use", "Powered by software", "Imprint", "Contact us", "Site map", "All content is licensed.", "Back to top"],
    "notice": ["We use cookies to improve your experience.", "Accept all cookies", "Subscribe to our newsletter.", "Please enable scripts to view this site.", "You have no new messages.", "Sign in to continue", "This site uses cookies. By continuing you agree to their use."],
    "social": ["Share", "Tweet", "Follow us", "Like this", "Print", "Email this", "Save"],
    "aside": ["Related posts", "Most read", "Popular", "Recent comments", "Tags", "Archive", "See also", "You may also like", "Categories", "Latest news"],
    "ad": ["Advertisement", "Sponsored", "Buy now and save", "Order today", "Special offer ends soon", "Click here for a free trial"],
    "comments": ["Comments", "Leave a reply", "Reply", "Report", "says", "Responses", "Join the discussion"],
}
COMMON = "the of and to in a is that for it was on are as with his they at be this from have or by one had not but what all were when we there can an your which their said if do will each about how up out them then she many some so these would other into has more her two like him see time could no make than first been its who now people my made over did down only way find use may water long little very after words called just where most know".split()
NEUTRAL = "page site wrapper wrap container row col col8 inner outer layout content main app root grid box block left right center clearfix panel region primary body view section module group l r x".split()


def wild_pages(count: int, seed: int) -> Iterator[tuple[str, list[bool]]]:
    """Pages in wrappers of any depth and name, paragraphs of any element, boilerplate that the words and links tell."""
    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"

    plain = [*COMMON, *(w for said in PHRASES.values() for phrase in said for w in phrase.lower().strip(".").split())]
    share = 0.0

    def word() -> str:
        """Made up or, in a share of the words that differs from page to page, one that boilerplate says too."""
        return rng.choice(plain) if rng.random() < share else "".join(rng.choice(SYLLABLES) for _ in range(rng.choice([1, 1, 2, 2, 3])))

    def sentence(n: int, stop: bool = True) -> str:
        made = [word() for _ in range(n)]
        for k in range(len(made) - 1):
            made[k] += "," if rng.random() < 0.08 else ""
        return " ".join([made[0].capitalize(), *made[1:]]) + (rng.choice("....?!") if stop else "")

    def prose(n: int) -> str:
        out = []
        while n > 0:
            out.append(sentence(min(n, rng.randint(4, 20))))
            n -= 20
        if rng.random() < 0.25:
            out.insert(rng.randint(0, len(out)), f'{sentence(3, False)} <a href="/{word()}">{sentence(rng.randint(1, 4), False)}</a> {sentence(4)}')
        return " ".join(out)

    def named(kind: str | None) -> str:
        style = rng.random()
        if style < 0.25:
            return ""
        if kind and style < 0.7:
            names = [rng.choice(NAMES[kind]), *([rng.choice(NEUTRAL)] if rng.random() < 0.4 else [])]
        elif style < 0.85:
            names = rng.sample(NEUTRAL, rng.randint(1, 2))
        else:
            names = ["".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 2))]
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice(["-", " ", "_"]).join(names)}"'

    def links(kind: str, n: int) -> str:
        items = [f'<a href="/{word()}">{rng.choice(PHRASES[kind]) if rng.random() < 0.5 else sentence(rng.randint(1, 9), False)}</a>' for _ in range(n)]
        style = rng.random()
        if style < 0.5:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        if style < 0.65:
            return rng.choice([" | ", " ", " · ", " / "]).join(items)
        if style < 0.8:
            return "".join(f"<div>{x}</div>" for x in items)
        if style < 0.9:
            return "<table><tr>" + "".join(f"<td>{x}</td>" for x in items) + "</tr></table>"
        return "<p>" + "<br>".join(items) + "</p>"

    def boiler(kind: str) -> str:
        tags = {"nav": ["nav", "nav", "div", "ul"], "header": ["header", "header", "div"], "footer": ["footer", "footer", "div", "table"], "aside": ["aside", "aside", "div", "td"], "comments": ["section", "div", "ol"], "form": ["form"]}
        tag, said = rng.choice(tags.get(kind, ["div", "div", "section", "p"])), PHRASES.get(kind, PHRASES["nav"])
        if kind == "nav":
            inner = links("nav", rng.randint(2, 12))
        elif kind == "header":
            inner = f"<{(t := rng.choice(['div', 'p', 'span', 'h1', 'h2']))}><a href='/'>{sentence(2, False)}</a></{t}>" + (f"<p>{sentence(rng.randint(2, 7), False)}</p>" if rng.random() < 0.5 else "") + (links("nav", 4) if rng.random() < 0.5 else "")
        elif kind == "footer":
            inner = (links("footer", rng.randint(2, 8)) if rng.random() < 0.6 else "") + f"<p>{' '.join(rng.sample(said, rng.randint(1, 3)))} {sentence(rng.randint(1, 12))}</p>"
        elif kind == "aside":
            inner = f"<h3>{rng.choice(said)}</h3>" + (links("aside", rng.randint(2, 8)) if rng.random() < 0.7 else f'<div><a href="/">{sentence(5, False)}</a><p>{sentence(rng.randint(5, 22))}</p></div>' * rng.randint(1, 4))
        elif kind == "comments":
            inner = f"<h3>{rng.choice(said)}</h3>" + "".join(f'<{(t := rng.choice(["div", "li", "article"]))} class="{rng.choice(["comment", "reply", "comment-body", "thread"])}"><b>{word()}</b> {rng.choice(said)}<p>{prose(rng.randint(2, 50))}</p></{t}>' for _ in range(rng.randint(1, 6)))
        elif kind == "form":
            inner = f"<label>{sentence(2, False)}</label><input><p>{sentence(4)}</p><button>{rng.choice(PHRASES['notice'])}</button>"
        else:
            inner = " ".join(rng.sample(said, rng.randint(1, 3))) + (" " + sentence(rng.randint(2, 12)) if rng.random() < 0.5 else "")
            inner = rng.choice([f"<p>{inner}</p>", inner, links(kind if kind in PHRASES else "nav", 3)])
        if tag == "p":
            inner = re.sub(r"</?(p|ul|li|div|table|tr|td)[^>]*>", " ", inner)
        name = named(kind) or (f' class="{rng.choice(NAMES[kind])}"' if tag == "div" and kind == "aside" else "")
        if kind == "comments":  # nothing else would tell them from the article
            name = f' {rng.choice(["class", "id"])}="{rng.choice(NAMES[kind])}"'
        if tag == "table":
            return f"<table{name}><tr><td>{inner}</td></tr></table>"
        if tag == "td":
            return f"<table><tr><td{name}>{inner}</td></tr></table>"
        return f"<{tag}{name}>{inner}</{tag}>"

    def paragraphs(style: str) -> list[str]:
        n = rng.choice([1, 2, 3, 4, 6, 9, 14, 25])
        long = [prose(rng.choice([4, 9, 18, 30, 45, 70, 110])) for _ in range(n)]
        if not any(len(x.split()) > 25 for x in long):
            long[rng.randrange(n)] = prose(rng.randint(30, 80))
        if style == "br":
            return [rng.choice(["<br>", "<br><br>", "<br/>\n<br/>"]).join(long)]
        out = []
        for text in long:
            kind = rng.random()
            if kind < 0.1:
                out.append(f"<{(t := rng.choice(['h2', 'h3', 'h4']))}>{sentence(rng.randint(1, 7), False)}</{t}>")
            if kind > 0.94:
                out.append(f"<{(t := rng.choice(['ul', 'ol']))}>" + "".join(f"<li>{sentence(rng.randint(2, 16), rng.random() < 0.5)}</li>" for _ in range(rng.randint(2, 6))) + f"</{t}>")
            elif kind > 0.91:
                out.append(f"<blockquote>{rng.choice(['<p>%s</p>', '%s']) % text}</blockquote>")
            elif kind > 0.89:
                out.append(f"<pre>{sentence(9, False)}</pre>")
            elif kind > 0.87:
                out.append("<table>" + "".join(f"<tr><th>{sentence(1, False)}</th><td>{sentence(rng.randint(1, 4), False)}</td></tr>" for _ in range(rng.randint(2, 5))) + "</table>")
            elif kind > 0.85:
                out.append(f"<figure><img src='x'><figcaption>{sentence(rng.randint(3, 14))}</figcaption></figure>")
            element = {"p": "p", "div": "div", "mixed": rng.choice(["p", "p", "div", "section"])}[style]
            out.append(f"<{element}{named(None) if rng.random() < 0.2 else ''}>{text}</{element}>")
        return out

    for _ in range(count):
        share = rng.choice([0.0, 0.4, 0.8])
        out, labels = ["<!DOCTYPE html><html><head><title>x</title></head><body>"], []

        def add(html: str, article: bool) -> None:
            out.append(html)
            labels.extend([article] * len(blocks(html)))

        def wrap(n: int, tags: list[str], kind: str | None) -> list[str]:
            made = []
            for _ in range(n):
                tag = rng.choice(tags)
                out.append(f"<table><tr><td{named(kind)}>" if tag == "td" else f"<{tag}{named(kind)}>")
                made.append("</td></tr></table>" if tag == "td" else f"</{tag}>")
            return made[::-1]

        around = wrap(rng.choice([0, 0, 1, 1, 2, 3, 5]), ["div", "div", "div", "section", "td"], None)
        for kind in ("notice", "header", "nav", "form", "ad", "nav", "social"):
            if rng.random() < (0.7 if kind in ("nav", "header") else 0.25):
                add(boiler(kind), False)
        middle = wrap(rng.choice([0, 0, 1, 2]), ["div", "div", "main", "section", "td"], "article" if rng.random() < 0.4 else None)
        early = rng.random() < 0.25
        if early:
            add(boiler("aside"), False)
        inner = wrap(rng.choice([0, 1, 1, 2, 3, 5]), ["div", "div", "div", "section", "article", "td"], "article" if rng.random() < 0.5 else None)
        if rng.random() < 0.75:
            tag = rng.choice(["h1", "h1", "h2"])
            add(f"<{tag}{named(None) if rng.random() < 0.3 else ''}>{sentence(rng.randint(1, 10), False)}</{tag}>", True)
        parted, part = rng.random() < 0.2, []  # the article's parts in containers of their own
        for html in paragraphs(rng.choice(["p", "p", "p", "mixed", "div", "br"])):
            if parted and (not part or rng.random() < 0.4):
                out += part
                part = wrap(1, ["div", "div", "section"], None)
            add(html, True)
            if rng.random() < 0.05:
                add(boiler(rng.choice(["ad", "social", "notice", "aside"])), False)
        out += part
        if rng.random() < 0.3:
            add(boiler(rng.choice(["social", "aside", "comments"])), False)
        out += inner
        for kind in ("social", "comments", "aside", "ad"):
            if rng.random() < 0.3 and not (early and kind == "aside"):
                add(boiler(kind), False)
        out += middle
        for kind in ("aside", "form", "nav", "footer"):
            if rng.random() < (0.65 if kind == "footer" else 0.2):
                add(boiler(kind), False)
        out += around
        if rng.random() < 0.7:
            out.append("</body></html>")
        yield "".join(out), labels


def sample_pages(count: int, seed: int) -> Iterator[tuple[str, list[bool]]]:
    """Pages whose article is one container with a telling name."""
    rng = random.Random(seed)

    def words(n: int) -> str:
        made = ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
        return " ".join([made[0].capitalize(), *made[1:]]) + rng.choice([".", ".", "", "!", " &amp; more", "?"])

    def named(kind: str, tags: list[str]) -> tuple[str, str]:
        tag = rng.choice(tags)
        names = rng.sample(NAMES[kind], rng.randint(1, min(2, len(NAMES[kind]))))
        attribute = rng.choice(['class="%s"', 'class="%s"', 'id="%s"']) % rng.choice(["-", " ", "_"]).join(names)
        return tag, f" {attribute}" if tag in ("div", "section", "ul", "span", "p", "table") or rng.random() < 0.4 else ""

    def boiler(kind: str, tags: list[str]) -> tuple[str, list[bool]]:
        tag, attribute = named(kind, tags)
        style, n = rng.random(), rng.randint(1, 7)
        if kind == "nav" or kind in ("aside", "footer", "social") and style < 0.4:
            items = [f'<li><a href="/{k}">{words(rng.randint(1, 3))}</a></li>' for k in range(n)]
            return f"<{tag}{attribute}><ul>{''.join(items)}</ul></{tag}>", [False] * n
        if kind == "form":
            return f'<form{attribute if tag == "form" else ""}><label>{words(2)}</label><input name="q"><p>{words(4)}</p><button>{words(1)}</button></form>', None
        if kind == "comments":
            items = [f"<{rng.choice(['div', 'li', 'article'])} class=\"comment\"><p>{words(rng.randint(3, 60))}</p></div>" for _ in range(n)]
            return f"<{tag}{attribute}><h3>{words(2)}</h3>{''.join(items)}</{tag}>", None
        if style < 0.5:
            return f"<{tag}{attribute}>{words(rng.randint(2, 45))}</{tag}>", [False]
        inner = "".join(f"<p>{words(rng.randint(2, 40))}</p>" for _ in range(min(n, 3)))
        return f"<{tag}{attribute}>{inner}</{tag}>", None

    for _ in range(count):
        out, labels = ["<!DOCTYPE html><html><head><title>x</title></head><body>"], []

        def add(html: str) -> None:
            out.append(html)
            labels.extend([False] * len(blocks(html)))

        for kind, tags in (("notice", ["div", "section"]), ("header", ["header", "div"]), ("nav", ["nav", "div", "ul"]), ("form", ["form"]), ("ad", ["div", "aside", "section"]), ("nav", ["nav", "div"]), ("notice", ["div"])):
            if rng.random() < (0.75 if kind == "nav" else 0.4):
                add(boiler(kind, tags)[0])
        tag, attribute = named("article", rng.choice([["article"], ["article"], ["main", "div", "section", "td", "div"]]))
        if tag == "td":
            out.append("<table><tr><td>")
        body = []
        outer = rng.random() < 0.3
        out.append((f"<{rng.choice(['main', 'div'])}>" if outer else "") + f"<{tag}{attribute}>")

        def part(html: str) -> None:
            body.append(html)
            labels.extend([True] * len(blocks(html)))

        if rng.random() < 0.8:
            part(f"<h1>{words(rng.randint(1, 9))}</h1>")
        for k in range(rng.choice([1, 2, 3, 5, 8, 15, 40])):
            style, text = rng.random(), words(rng.choice([1, 2, 3, 6, 12, 30, 60]))
            if style < 0.62:
                part(f"<p>{text}</p>" if rng.random() < 0.75 else f"<p><b>{text}<br>")
            elif style < 0.7:
                part(f"<h2>{words(rng.randint(1, 5))}</h2>")
            elif style < 0.76:
                part("<ul>" + "".join(f"<li>{words(rng.randint(1, 12))}</li>" for _ in range(rng.randint(1, 5))) + "</ul>")
            elif style < 0.8:
                part(f"<blockquote><p>{text}</p></blockquote>")
            elif style < 0.84:
                part(f'<p>{text} <a href="/x">{words(2)}</a> {words(4)}</p>')
            elif style < 0.87:
                part(f"<pre>{text}</pre>")
            elif style < 0.9:
                part(f"<table><tr><td>{words(2)}</td><td>{words(3)}</td></tr></table>")
            elif style < 0.96:
                kind = rng.choice(["ad", "ad", "aside", "social", "notice"])
                html, _ = boiler(kind, ["div", "aside"] if kind in ("ad", "aside") else ["div"])
                body.append(html)
                labels.extend([False] * len(blocks(html)))
            else:
                part(f"<figure><figcaption>{words(5)}</figcaption></figure>")
        out += body
        if rng.random() < 0.15:
            add(boiler("comments", ["section", "div"])[0])
        out.append(f"</{tag}>")
        for kind, tags in (("social", ["div"]), ("comments", ["section", "div"]), ("aside", ["aside", "div"]), ("ad", ["div", "aside"]), ("form", ["form"]), ("footer", ["footer", "footer", "div"])):
            if rng.random() < (0.8 if kind == "footer" else 0.4):
                add(boiler(kind, tags)[0])
        if rng.random() < 0.7:
            out.append("</body></html>")
        yield "".join(out), labels


@lru_cache(maxsize=1)
def trained() -> Labeller:
    """The labeller, trained once per process."""
    model = Labeller()
    pages = [(blocks(html), labels) for html, labels in training_pages()]
    model.train([(vectors(page), np.array(labels, np.float32)) for page, labels in pages if page and len(page) == len(labels)])
    return model


def extract(pages: list[str], model: Labeller) -> list[str]:
    """Main texts; pages of like length are labelled together."""
    parsed = [blocks(html) for html in pages]
    out = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if parsed[k]), key=lambda k: len(parsed[k]))
    at = 0
    while at < len(order):
        size = max(1, min(64, LONG // len(parsed[order[min(at + 63, len(order) - 1)]])))
        group = order[at : at + size]
        at += size
        if len(parsed[group[0]]) > LONG:
            scores = [model.long_scores(parsed[group[0]])]
        else:
            scores = model.scores(*padded([vectors(parsed[k]) for k in group]))
        for k, row in zip(group, scores):
            out[k] = "\n".join(text for (_, text, _), score in zip(parsed[k], row) if score >= 0)
    return out


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""
    model = pages.sparkSession.sparkContext.broadcast(trained().p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller()
        labeller.p = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                found = extract([html or "" for html in rows.column(2).to_pylist()], labeller)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(found, pa.string())], ["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
