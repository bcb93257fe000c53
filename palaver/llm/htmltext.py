"""Main text of web pages by a tree-structured graphical model.

The page is read into a tree of block elements (inline elements belong to the block around them; what
HTML leaves open is closed as browsers do). Each node is content or not. A node's features (its tag,
words of its class and id, links, amount and kind of text, where it stands) give its own potential; each
parent-child edge a potential for the four combinations. Sum-product messages, up from the leaves and
down from the root, give every node's exact marginal; nodes of a marginal above one half are content, and
the text that stands directly in them is the result. The weights are trained by gradient ascent on the
likelihood of labelled pages, with the same messages giving the expectations. The labelled pages are
written by `labelled_pages` in layouts of many kinds; each block is labelled there.

Text: character references are decoded, white space inside a block becomes one space, blocks are joined
in page order by one space. Scripts, styles, comments and the head are no text, nor is what browsers do
not show as text (noscript, iframe, template, svg) up to its end tag; without one only the tag is skipped.
A quote that is never closed is an ordinary character of its tag. The page is read in one forward pass, in
time linear in its length.

Defined cases: null and empty pages give an empty text; text without any tag stands in the root and is
content; a marginal of exactly one half is not content; broken markup never fails; long pages are read whole; repeated rows give equal results; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palaver.llm.common import table
from palaver.shipping import ship

#: Element names by their part in a page.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = ("script", "style", "title", "textarea", "noscript", "iframe", "template", "svg", "xmp", "noembed", "noframes")
BLOCKS = {"html", "body", "head", "article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "nav", "header", "footer", "aside", "form", "fieldset", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote", "pre", "figure", "figcaption", "address", "details", "summary", "dialog", "menu", "center", "hgroup", "search", "select", "option", "button", "label"}
CLOSES_P = BLOCKS - {"button", "label", "option", "select"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}}
#: Tag -> the tags whose reach it changes, and whether it ends it.
REACHES = {t: [(k, t in SCOPE[k]) for k in CLOSED_BY if t in SCOPE[k] | CLOSED_BY[k]] for t in BLOCKS}
#: Words of class, id and role, and what they tell.
HINTS = {
    "ad": "ad ads advert advertisement advertising adbox adslot banner sponsor sponsored promo promotion promoted outbrain taboola teaser",
    "nav": "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager tabs toc skip sitemap topbar toolbar",
    "head": "header masthead head logo brand top hero",
    "foot": "footer foot bottom copyright colophon legal contentinfo",
    "side": "sidebar aside side rail widget widgets related recommended popular trending more tags tag social share sharing newsletter subscribe author bio meta byline complementary",
    "notice": "cookie cookies notices cookiebar dialog consent gdpr notice popup modal overlay alert privacy paywall signup banner",
    "comments": "comment comments commentlist commenter reply replies disqus respond discussion thread",
    "form": "form search login contact",
    "hidden": "hidden invisible none print sr only",
    "main": "article content post entry main story body text page prose markdown",
}
GROUPS = list(HINTS)
WORD_GROUP: dict[str, list[int]] = {}
for _g, _words in enumerate(HINTS.values()):
    for _w in _words.split():
        WORD_GROUP.setdefault(_w, []).append(_g)
TAGS = ["article", "main", "section", "div", "p", "h1", "h2", "h3", "ul", "ol", "li", "nav", "header", "footer", "aside", "form", "table", "td", "blockquote", "pre", "figure", "figcaption", "button", "label", "select", "body", "html", "dialog", "dl", "address"]
TAG_AT = {t: i for i, t in enumerate(TAGS)} | {"h4": TAGS.index("h3"), "h5": TAGS.index("h3"), "h6": TAGS.index("h3"), "th": TAGS.index("td"), "menu": TAGS.index("nav"), "search": TAGS.index("form"), "fieldset": TAGS.index("form"), "option": TAGS.index("select"), "dt": TAGS.index("dl"), "dd": TAGS.index("dl")}
N_TAGS = len(TAGS)
EXTRA = ["bias", "own_text", "long_text", "all_link", "some_link", "short", "sentence", "in_article", "h1_in", "hidden_attr", "own_comma", "first_level", "input_in", "junk_above", "junk_here"]
#: Tags and hints that mark what is not the article, for the two features about them.
JUNK_TAGS = {"nav", "footer", "aside", "form", "button", "dialog", "menu", "select", "label"}
JUNK_HINTS = {GROUPS.index(g) for g in ("ad", "nav", "foot", "side", "notice", "comments", "form", "hidden")}
SIZE = N_TAGS + len(GROUPS) + len(EXTRA)
TAG_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
TAG_STOP = re.compile(r"[>\"']")
ATTR = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden|aria-label|itemprop)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
HINT = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW}


class Node:
    __slots__ = ("tag", "parent", "pieces", "linked", "hints", "hidden", "depth", "inputs", "kids", "label")

    def __init__(self, tag: str, parent: int, depth: int):
        self.tag, self.parent, self.depth = tag, parent, depth
        self.pieces: list[tuple[int, str]] = []
        self.linked = self.inputs = self.kids = 0
        self.hints: set[int] = set()
        self.hidden = False
        self.label = 0


class Scanner:
    """Goes over a page once, forward: the text before the next tag and the tag.

    What was looked for in vain is not looked for again, so the time is linear in the page's length.
    """

    def __init__(self, page: str):
        self.page, self.at = page, 0
        self.absent: set[str] = set()

    def find(self, what: str, at: int) -> int:
        """The next place of `what`, -1 if there is none from here to the end."""
        if what in self.absent:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.absent.add(what)
        return found

    def skip_raw(self, tag: str) -> int:
        """Moves behind the element's end tag and returns where that begins; -1 without one."""
        if tag in self.absent:
            return -1
        m = RAW_END[tag].search(self.page, self.at)
        if m is None:
            self.absent.add(tag)
            return -1
        self.at = m.end()
        return m.start()

    def tag_end(self, at: int) -> int:
        """Where the tag's `>` stands. Quotes count behind `=` only, and only if they are closed."""
        page, stop = self.page, self.find(">", at)
        if stop < 0 or (page.count("'", at, stop) == 0 and page.count('"', at, stop) % 2 == 0):
            return stop
        while True:
            m = TAG_STOP.search(page, at) if ">" not in self.absent else None
            if m is None:
                self.absent.add(">")
                return -1
            at = m.end()
            if m[0] == ">":
                return m.start()
            k = m.start() - 1
            while k > 0 and page[k] in " \t\n\r\f":
                k -= 1
            if page[k] == "=":
                end = self.find(m[0], at)
                at = at if end < 0 else end + 1

    def __iter__(self):
        """(text, name, closing, attributes); the name is None behind the last text and for comments."""
        page, begin = self.page, 0
        while True:
            at = self.find("<", self.at)
            if at < 0:
                break
            mark = page[at + 1 : at + 2]
            if mark in ("!", "?") and mark:
                if page.startswith("<!--", at):
                    stop, size = self.find("-->", at + 2), 3
                elif page.startswith("<![CDATA[", at):
                    stop, size = self.find("]]>", at), 3
                else:
                    stop, size = self.find(">", at), 1
                self.at = stop + size if stop >= 0 else len(page)
                yield page[begin:at], None, False, ""
            else:
                m = TAG_NAME.match(page, at + 1)
                if m is None:
                    self.at = at + 1
                    continue
                stop = self.tag_end(m.end())
                # A tag that the page's end cuts off is no text, as in browsers.
                end = stop if stop >= 0 else len(page)
                self.at = min(end + 1, len(page))
                yield page[begin:at], m[1].lower(), mark == "/", page[m.end() : end]
            begin = self.at
        yield page[begin:], None, False, ""


def parse(page: str) -> tuple[list[Node], int]:
    """Block nodes in page order (a parent stands before its children) and the number of text runs.

    A run is text without a block's edge inside; its pieces go to the node that they stand in. Each open
    element knows which open one a new tag would close, so no tag looks through the open ones.
    """
    nodes = [Node("html", -1, 0)]
    #: Open elements; beside each, by tag, the place among them that such a tag closes (0: none).
    stack, reach = [0], [dict.fromkeys(["p", *CLOSED_BY], 0)]
    opened: Counter = Counter()
    run, links, skip_head = 0, 0, False
    scan = Scanner(page)

    def text(piece: str) -> None:
        if piece and not skip_head:
            node = nodes[stack[-1]]
            node.pieces.append((run, piece))
            if links:
                node.linked += len(piece)

    def close(k: int) -> None:
        opened.subtract(nodes[i].tag for i in stack[k:])
        del stack[k:], reach[k:]

    for before, tag, closing, attributes in scan:
        text(before)
        if tag is None:
            continue
        if not closing and tag in RAW_END:
            run += tag != "svg"
            if tag == "svg" and attributes.endswith("/"):
                continue
            at = scan.at
            end = scan.skip_raw(tag)
            if tag == "xmp":  # its text is shown as it is written
                text(page[at : end if end >= 0 else len(page)].replace("&", "&amp;"))
                run += 1
            if end < 0 and tag in ("script", "style", "xmp"):
                scan.at = len(page)
            continue
        if tag == "a":
            links = 0 if closing else 1
            continue
        if tag == "br" or tag == "hr":
            run += 1
            continue
        if tag in ("input", "img", "textarea"):
            nodes[stack[-1]].inputs += tag != "img"
            continue
        if tag not in BLOCKS:
            continue
        run += 1
        if tag == "head":
            skip_head = not closing
            continue
        if tag == "html":
            continue
        if tag == "body":
            skip_head = False
        if closing:
            if opened[tag]:
                k = len(stack) - 1
                while nodes[stack[k]].tag != tag:
                    k -= 1
                close(k)
                links = 0
            continue
        skip_head = False
        if tag in CLOSES_P and reach[-1]["p"]:
            close(reach[-1]["p"])
        while tag in CLOSED_BY and reach[-1][tag]:
            close(reach[-1][tag])
        parent = stack[-1]
        node = Node(tag, parent, nodes[parent].depth + 1)
        nodes[parent].kids += 1
        if attributes:
            for a in ATTR.finditer(attributes):
                name, value = a[1].lower(), (a[2] or "").strip("\"'").lower()
                if name in ("hidden",) or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                    node.hidden = True
                elif name != "style":
                    for w in HINT.findall(value):
                        node.hints.update(WORD_GROUP.get(w, ()))
        here, own = reach[-1], len(stack)
        if tag == "p":
            here = here | {"p": own}
        elif here["p"] and tag not in ("button", "label"):
            here = here | {"p": 0}
        for k, ends in REACHES.get(tag, ()):
            if here[k] or not ends:
                here = here | {k: 0 if ends else own}
        nodes.append(node)
        stack.append(len(nodes) - 1)
        reach.append(here)
        opened[tag] += 1
    return nodes, run + 1


def vectors(nodes: list[Node]) -> np.ndarray:
    x = np.zeros((len(nodes), SIZE), np.float32)
    inside, junk = [False] * len(nodes), [False] * len(nodes)
    has_h1 = [False] * len(nodes)
    inputs = [n.inputs for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        p = nodes[i].parent
        has_h1[p] = has_h1[p] or has_h1[i] or nodes[i].tag == "h1"
        inputs[p] += inputs[i]
    base = N_TAGS + len(GROUPS)
    for i, n in enumerate(nodes):
        row = x[i]
        if n.tag in TAG_AT:
            row[TAG_AT[n.tag]] = 1
        for g in n.hints:
            row[N_TAGS + g] = 1
        inside[i] = n.tag in ("article", "main") or (i > 0 and inside[n.parent])
        own = "".join(p for _, p in n.pieces).strip()
        size = len(own)
        row[base] = 1
        row[base + 1] = min(math.log1p(size) / 5, 1.5)
        row[base + 2] = size > 80
        row[base + 3] = size > 0 and n.linked >= 0.6 * size
        row[base + 4] = size > 0 and 0 < n.linked < 0.6 * size
        row[base + 5] = 0 < size < 25
        row[base + 6] = own[-1:] in (".", "!", "?", "…", "。") if own else 0
        row[base + 7] = inside[i]
        row[base + 8] = has_h1[i]
        row[base + 9] = n.hidden
        row[base + 10] = own.count(",") > 1
        row[base + 11] = n.depth == 2
        row[base + 12] = inputs[i] > 0
        above = i > 0 and junk[n.parent]
        here = n.tag in JUNK_TAGS or n.hidden or bool(n.hints & JUNK_HINTS) and GROUPS.index("main") not in n.hints
        junk[i] = above or here
        row[base + 13], row[base + 14] = above, here
    return x


def messages(nodes: list[Node], unary: np.ndarray, psi: tuple[float, float, float, float]) -> tuple[list[float], list[float], list[float]]:
    """Sum-product on the tree: for each node the log odds of its marginal, of its subtree alone (with its own
    potential), and of its parent without its subtree. psi: log potentials of (parent, child) 00, 01, 10, 11."""
    e00, e01, e10, e11 = map(math.exp, psi)
    up = unary.tolist()
    sent = [0.0] * len(nodes)
    log, exp = math.log, math.exp
    for i in range(len(nodes) - 1, 0, -1):
        b = exp(min(max(up[i], -40.0), 40.0))
        sent[i] = log((e10 + e11 * b) / (e00 + e01 * b))
        up[nodes[i].parent] += sent[i]
    full = up[:]
    without = [0.0] * len(nodes)
    for i in range(1, len(nodes)):
        w = full[nodes[i].parent] - sent[i]
        without[i] = w
        a = exp(min(max(w, -40.0), 40.0))
        full[i] = up[i] + log((e01 + e11 * a) / (e00 + e10 * a))
    return full, up, without


def fit(pages: list[str], labels: list[list[int]], rounds: int = 200, rate: float = 0.15, ridge: float = 0.02) -> tuple[np.ndarray, tuple[float, float, float, float]]:
    """Weights and edge potentials of greatest likelihood; labels: of each page's nodes, in parse order."""
    trees = [parse(p)[0] for p in pages]
    xs = [vectors(t) for t in trees]
    w, psi = np.zeros(SIZE), np.zeros(4)
    total = sum(map(len, trees))
    mean, square = np.zeros(SIZE + 4), np.zeros(SIZE + 4)
    for step in range(1, rounds + 1):
        g, ge = -ridge * w * total / 100, np.zeros(4)
        for nodes, x, y in zip(trees, xs, labels, strict=True):
            full, up, without = messages(nodes, x @ w, tuple(psi))
            prob = 1 / (1 + np.exp(-np.clip(full, -40, 40)))
            g = g + x.T @ (np.array(y) - prob)
            if len(nodes) < 2:
                continue
            child, par = np.clip(np.array(up[1:]), -40, 40), np.clip(np.array(without[1:]), -40, 40)
            joint = np.exp(psi[:, None] + np.stack([0 * par, child, par, par + child]) - np.maximum(0, par + child))
            joint /= joint.sum(axis=0)
            yy = np.array([2 * y[n.parent] + y[i] for i, n in enumerate(nodes) if i])
            ge += np.bincount(yy, minlength=4) - joint.sum(axis=1)
        grad = np.concatenate([g, ge]) / total
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        w, psi = w + move[:SIZE], psi + move[SIZE:]
    return w, tuple(map(float, psi))


def labelled_pages(count: int = 300, seed: int = 5) -> tuple[list[str], list[list[int]]]:
    """Pages in random layouts, and the label of each block node in page order (the root first)."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ta", "ri", "no", "el", "su", "mo", "ka", "pe"]) for _ in range(rng.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda a=4, b=18: words(a, b).capitalize() + rng.choice(".....!?")
    prose = lambda a=1, b=6: " ".join(sentence() for _ in range(rng.randint(a, b)))
    inline = lambda t: rng.choice([t, t, f"<b>{t}</b>", f"{t} <a href='/x'>{word()}</a> {word()}.", f"<em>{word()}</em> {t}", f"{t}<br>{sentence()}"])
    link = lambda: f'<a href="/{word()}">{words(1, 3)}</a>'
    pages, all_labels = [], []
    for _ in range(count):
        out: list[str] = []
        labels = [0]

        def el(tag, y, inner, attrs="", close=True):
            out.append(f"<{tag}{attrs}>")
            labels.append(y)
            inner() if callable(inner) else out.append(inner)
            if close:
                out.append(f"</{tag}>")

        attr = lambda *names: "" if not names else rng.choice([' class="%s"', ' id="%s"', ' class="x-%s y"']) % rng.choice(names)

        def menu(y=0):
            el(rng.choice(["ul", "ul", "ol"]), y, lambda: [el("li", y, link(), close=rng.random() < 0.8) for _ in range(rng.randint(2, 7))])

        def notes():
            for _ in range(rng.randint(1, 3)):
                el(rng.choice(["div", "li", "article"]), 0, lambda: [el("p", 0, rng.choice([prose(1, 4), prose(1, 2), words(1, 3)])) for _ in range(rng.randint(1, 2))], attr("comment", "reply"))

        def junk():
            kind = rng.choice(["ad", "aside", "notice", "form", "related", "share", "comments", "nav", "ad", "popup", "meta"])
            if kind == "ad":
                el(rng.choice(["div", "div", "section", "aside"]), 0, rng.choice([prose(1, 5), prose(1, 2), link(), words(2, 6)]), attr("ad", "ads", "advert", "sponsored", "promo", "banner"))
            elif kind == "aside":
                el(rng.choice(["aside", "aside", "div"]), 0, lambda: [el("h3", 0, words(1, 4)), menu() if rng.random() < 0.5 else el("p", 0, prose(1, 5))] if rng.random() < 0.7 else out.append(prose(1, 4)), attr("sidebar", "widget", "rail", "complementary"))
            elif kind == "notice":
                el(rng.choice(["div", "section", "p"]), 0, (prose(1, 4) + rng.choice(["", " OK"])) if rng.random() < 0.6 else lambda: [el("p", 0, prose(1, 3)), el("button", 0, word())], attr("cookie", "consent", "gdpr", "notice", "cookie-banner"))
            elif kind == "popup":
                el(rng.choice(["div", "dialog"]), 0, lambda: [el("p", 0, prose(1, 3)), el("button", 0, word())], rng.choice([attr("modal", "popup", "newsletter"), ' style="display:none"', " hidden"]))
            elif kind == "form":
                el("form", 0, lambda: [el("label", 0, words(1, 3) + "<input name=q>"), el("button", 0, word())] + ([el("p", 0, prose(1, 3))] if rng.random() < 0.5 else []), attr("search", "login", "subscribe"))
            elif kind == "related":
                el(rng.choice(["div", "section", "aside"]), 0, lambda: [el("h2", 0, words(1, 4)), menu()], attr("related", "recommended", "popular", "trending"))
            elif kind == "share":
                el("div", 0, " ".join(link() for _ in range(rng.randint(2, 4))), attr("share", "social", "tags"))
            elif kind == "comments":
                el(rng.choice(["section", "div"]), 0, lambda: [el("h3", 0, words(1, 3)), notes()], attr("comments", "discussion", "replies", "reader-comments", "commentlist"))
            elif kind == "meta":
                el(rng.choice(["div", "p"]), 0, words(2, 5), attr("byline", "meta", "author"))
            else:
                el("nav", 0, menu if rng.random() < 0.6 else rng.choice([" ".join(link() for _ in range(4)), prose(1, 2)]), attr("breadcrumb", "pagination", "menu"))

        def body():
            if rng.random() < 0.75:
                tag = rng.choice(["h1", "h1", "h1", "h2"])
                if rng.random() < 0.25:
                    el("header", 1, lambda: el(tag, 1, words(2, 9)))
                else:
                    el(tag, 1, words(2, 9) + rng.choice(["", "."]))
            for _ in range(rng.randint(1, 8)):
                r = rng.random()
                if r < 0.62:
                    el("p", 1, inline(rng.choice([prose(), prose(), sentence(1, 3), words(1, 2)])), close=rng.random() < 0.75)
                elif r < 0.7:
                    el(rng.choice(["h2", "h3", "h4"]), 1, words(1, 6))
                elif r < 0.76:
                    el(rng.choice(["ul", "ol"]), 1, lambda: [el("li", 1, rng.choice([sentence(), words(1, 4)]), close=rng.random() < 0.8) for _ in range(rng.randint(2, 5))])
                elif r < 0.8:
                    el("blockquote", 1, lambda: el("p", 1, prose(1, 2)))
                elif r < 0.83:
                    el("table", 1, lambda: [el("tr", 1, lambda: [el("td", 1, words(1, 3)) for _ in range(3)]) for _ in range(2)])
                elif r < 0.86:
                    el("figure", 1, lambda: el("figcaption", 1, sentence()))
                elif r < 0.88:
                    el("pre", 1, words(3, 10))
                elif r < 0.93:
                    el(rng.choice(["div", "section"]), 1, lambda: [el("p", 1, prose()) for _ in range(rng.randint(1, 3))])
                elif r < 0.95:
                    el("div", 1, prose())
                else:
                    junk()

        def bare():
            for _ in range(rng.randint(1, 4)):
                el("p", 1, prose())

        out.append("<!DOCTYPE html><html><head><meta charset=utf-8><title>" + words(2, 6) + "</title></head><body>")
        labels.append(0)
        if rng.random() < 0.75:
            if rng.random() < 0.5:
                el("nav", 0, menu if rng.random() < 0.7 else " ".join(link() for _ in range(5)))
            else:
                el(rng.choice(["header", "header", "div"]), 0, lambda: rng.choice([lambda: [el("div", 0, words(1, 3)), el("nav", 0, menu)], menu, lambda: out.append(words(1, 4)), lambda: [el("p", 0, sentence()), el("nav", 0, menu)]])(), attr("header", "masthead", "topbar"))
        for _ in range(rng.choice([0, 0, 1, 2])):
            junk()
        kind = rng.random()
        if kind < 0.45:
            el("article", 1, body, rng.choice(["", attr("post", "entry", "article")]))
        elif kind < 0.65:
            el("main", 1, body if rng.random() < 0.5 else lambda: el("article", 1, body), rng.choice(["", attr("content", "main")]))
        elif kind < 0.9:
            el("div", 1, body if rng.random() < 0.6 else lambda: el("div", 1, body, attr("text", "prose", "entry-content")), attr("content", "main", "article", "post", "story", "entry"))
        else:
            labels[1] = 1
            bare()
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            junk()
        if rng.random() < 0.8:
            if rng.random() < 0.7:
                el("footer", 0, rng.choice([lambda: el("p", 0, prose(1, 3)), prose(1, 3), "&copy; " + word() + " &middot; " + sentence(), words(2, 8), " ".join(link() for _ in range(3))]))
            else:
                el("div", 0, lambda: [el("p", 0, "&copy; " + words(2, 5)), menu()], attr("footer", "copyright", "legal"))
        out.append("</body></html>")
        pages.append("".join(out))
        all_labels.append(labels)
    return pages, all_labels


def main_text(page: str | None, w: np.ndarray, psi: tuple[float, float, float, float]) -> tuple[str, list[float]]:
    """The page's main text, and the marginals of its nodes."""
    if not page:
        return "", []
    nodes, _ = parse(page)
    if len(nodes) == 1:
        odds = [1.0]
    else:
        odds, _, _ = messages(nodes, vectors(nodes) @ w, psi)
    runs: dict[int, list[str]] = {}
    for node, odd in zip(nodes, odds, strict=True):
        if odd > 0:
            for run, piece in node.pieces:
                runs.setdefault(run, []).append(piece)
    blocks = (SPACE.sub(" ", html.unescape("".join(runs[r]))).strip() for r in sorted(runs))
    return " ".join(b for b in blocks if b), [1 / (1 + math.exp(-max(min(o, 40.0), -40.0))) for o in odds]


def train() -> tuple[np.ndarray, tuple[float, float, float, float]]:
    return fit(*labelled_pages())


def extracted(df: DataFrame, model: tuple[np.ndarray, tuple[float, float, float, float]], page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns `keep`, text and n_chars."""
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches):
        w, psi = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = [main_text(p.as_py(), w, psi)[0] for p in part.column(len(keep))]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(keep))), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.fieldNames())

    return df.select(*keep, page).mapInArrow(run, schema)


def op7_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"), train())
