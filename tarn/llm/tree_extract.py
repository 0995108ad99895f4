"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a node in one of three states: boilerplate, container of content, or
content. A node's own evidence comes from a multinomial regression over its features; parent-child
potentials come from counted transitions. Both are fitted on a bounded sample of labelled pages: pages
with an ``article`` or ``main`` element, whose inside is content but for its navigation, header, footer,
aside and form elements. Class names decide no label. Each page is used as it is, with its telling tags and
names hidden, and with comments, asides, forms and notices of its own prose put inside and beside the article
and labelled as such, with the article's paragraphs in other forms, and with a very short article, so that
plain pages, unwanted prose, lists and bare text are judged too. One upward and one downward sum-product
pass give exact marginals, and blocks of content nodes are the text. Where no page has an article or main
element, nothing can be learned, and fixed weights of telling tags, names and long paragraphs stand in.

Work is linear in the size of a page. Elements nested deeper than 512 become siblings at that depth, as in
browsers, so a hostile page has a bounded number of levels; no text is lost by it.

A page that no element beyond html and body divides is text as a whole. Null, empty and text-free pages give an
empty text. Character references are decoded, white space in
a block becomes one space, blocks are joined by one space; markup cut off at the page's end is dropped.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import Scratch

TAG = re.compile(r"""<(?:!--.*?(?:-->|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)>|(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""", re.S)
HINT = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
# HTML element kinds and words that pages use to name their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style title noscript template textarea select option iframe svg object head".split())
RAW = frozenset("script style title noscript textarea iframe svg".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
KINDS = {
    **dict.fromkeys("article main".split(), 1),
    **dict.fromkeys("nav header footer aside form menu dialog button fieldset".split(), 2),
    **dict.fromkeys("p blockquote pre figcaption".split(), 3),
    **dict.fromkeys("ul ol li dl dt dd".split(), 4),
    **dict.fromkeys("h1 h2 h3 h4 h5 h6".split(), 5),
    **dict.fromkeys("table tbody thead tr td th".split(), 6),
}
AWAY = frozenset("ad ads advert advertisement adverts banner sponsor sponsored promo sidebar side comment comments reply replies respond notice notices cookie cookies consent alert popup modal nav navbar navigation menu breadcrumb breadcrumbs footer header masthead social share sharing related recommended newsletter subscribe signup login search widget pagination pager copyright legal disclaimer form".split())
TOWARDS = frozenset("article content main post entry story body text".split())
WIDTH = 20
DEEPEST = 512  # levels of nesting


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """Nodes of each depth, by one sort."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1])


class Page:
    """Block nodes of a page (parent, kind, hints, link and text sizes) and its text blocks."""

    def __init__(self, source: str):
        self.parent, self.kind, self.away, self.towards, self.depth, self.put_in = [-1], [0], [0], [0], [0], [0]
        self.divided = False  # by an element beyond html and body
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        stack: list[tuple[str, int]] = [("#", 0)]
        open_tags: dict[str, int] = {}  # how many of each tag are on the stack, so that none is looked for in vain
        buf: list[tuple[str, bool]] = []
        links = unseen = 0

        def flush() -> None:
            if buf:
                raw = "".join(t for t, _ in buf)
                text = " ".join((htmllib.unescape(raw) if "&" in raw else raw).split())
                if text:
                    self.blocks.append((stack[-1][1], text, sum(len(t) for t, inside in buf if inside)))
                buf.clear()

        def pop(to: int) -> None:
            nonlocal links, unseen
            for tag, _ in stack[to:]:
                links -= tag == "a"
                unseen -= tag in UNSEEN
                open_tags[tag] -= 1
            del stack[to:]

        def innermost(tag: str) -> int:
            """Place of the last open ``tag`` on the stack, 0 if there is none; what lies above it is then closed."""
            if not open_tags.get(tag):
                return 0
            return next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag)

        at, size = 0, len(source)
        while at < size:
            m = TAG.search(source, at)
            if (m.start() if m else size) > at and not unseen:
                buf.append((source[at : m.start()] if m else source[at:], links > 0))
            if not m:
                break
            at = m.end()
            name = m[2] or m[5]
            if not name:
                continue
            tag = name.lower()
            if m[1] or m[4]:
                k = innermost(tag)
                if tag not in INLINE:
                    flush()
                if k:
                    if any(t not in INLINE for t, _ in stack[k:]):
                        flush()
                    pop(k)
                continue
            attrs = m[3] if m[2] else m[6]
            if m[5] and not source.endswith(">", 0, m.end()):
                continue  # cut off inside the tag
            if tag not in INLINE:
                flush()
            if tag in VOID:
                continue
            if tag in ENDS_P:
                k = innermost("p")
                if k:
                    pop(k)
            if tag in SAME and stack[-1][0] in SAME[tag]:
                pop(len(stack) - 1)
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else size
                continue
            if attrs.rstrip().endswith("/") and tag not in ENDS_P and tag not in INLINE and tag not in KINDS:
                continue
            node = stack[-1][1]
            if tag not in INLINE and tag not in UNSEEN:
                words = {w for h in HINT.findall(attrs) for w in WORD.findall("".join(h).lower())} if "=" in attrs else ()
                if self.depth[node] >= DEEPEST:
                    node = self.parent[node]
                self.divided |= tag not in ("html", "body")
                self.parent.append(node)
                self.depth.append(self.depth[node] + 1)
                self.put_in.append(int(PUT_IN in attrs))
                self.kind.append(KINDS.get(tag, 0))
                self.away.append(int(bool(AWAY & set(words))))
                self.towards.append(int(bool(TOWARDS & set(words))))
                node = len(self.parent) - 1
            links += tag == "a"
            unseen += tag in UNSEEN
            stack.append((tag, node))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        flush()

    def features(self) -> np.ndarray:
        n = len(self.parent)
        own, link, words, stops = (np.zeros(n) for _ in range(4))
        for node, text, inside in self.blocks:
            own[node] += len(text)
            link[node] += min(inside, len(text))
            words[node] += text.count(" ") + 1
            stops[node] += text.count(".") + text.count(",")
        sub, sublink, parent = own.copy(), link.copy(), np.array(self.parent)
        for at in reversed(_levels(np.array(self.depth))[1:]):
            np.add.at(sub, parent[at], sub[at])
            np.add.at(sublink, parent[at], sublink[at])
        x = np.zeros((n, WIDTH), np.float32)
        x[np.arange(n), self.kind] = 1
        x[:, 7], x[:, 8] = self.away, self.towards
        x[:, 9] = np.log1p(own) / 5
        x[:, 10] = link / np.maximum(own, 1)
        x[:, 11] = np.log1p(sub) / 5
        x[:, 12] = sublink / np.maximum(sub, 1)
        x[:, 13] = stops / np.maximum(words, 1)
        x[:, 14] = own == 0
        x[:, 15] = sub == 0
        x[:, 16] = words >= 12
        x[:, 17] = (x[:, 10] > 0.5) & (own > 0)
        x[:, 18] = (words < 4) & (own > 0)
        x[:, 19] = (stops == 0) & (own > 0)
        return x

    def labels(self) -> np.ndarray | None:
        """States by the page's own article or main element and by what was put in; None if it has none."""
        n, kind = len(self.parent), self.kind
        if 1 not in kind:
            return None
        state = np.zeros(n, np.int64)
        for i in range(1, n):
            p = self.parent[i]
            inside = state[p] == 2 or kind[i] == 1
            state[i] = 2 if inside and kind[i] != 2 and not self.put_in[i] else 0
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            if state[i] and not state[p] and state[i] != state[p]:
                state[p] = 1
        return state


def hide(x: np.ndarray, both: bool) -> np.ndarray:
    """The features without the tags and names that tell content and, if ``both``, boilerplate."""
    y, gone = x.copy(), [1, 2] if both else [1]
    y[:, 0] += y[:, gone].sum(axis=1)
    y[:, [*gone, 8, *([7] if both else [])]] = 0
    return y


PUT_IN = "data-put-in"  # marks parts that training puts into a page; no feature
GRAFTS = ['<div data-put-in class="comments"><p>%s</p><p>%s</p></div>', "<aside data-put-in><p>%s</p><p>%s</p></aside>", "<form data-put-in><p>%s</p><label>%s</label></form>", '<div data-put-in class="notice">%s %s</div>', '<div data-put-in class="sidebar"><h3>%s</h3><p>%s</p></div>', '<section data-put-in id="comment-list" class="comments"><div><p>%s</p></div><div><p>%s</p></div></section>']


def graft(source: str) -> str:
    """The page with its own prose as comments, asides, forms and notices in and beside the article."""
    m = re.search(r"<(article|main)\b[^>]*>", source, re.I)
    prose = re.findall(r"<p>([^<]{4,600})", source)
    if not m or not prose:
        return source
    k = source.lower().rfind(f"</{m[1].lower()}>")
    k = k if k > m.end() else len(source)
    pick = len(source)
    parts = [GRAFTS[(pick + i) % len(GRAFTS)] % (prose[(pick + i) % len(prose)], prose[(pick * 7 + i) % len(prose)]) for i in range(4)]
    return source[: m.start()] + parts[0] + source[m.start() : k] + parts[1] + parts[2] + source[k:] + parts[3]


def _inside(source: str) -> tuple[int, int] | None:
    """Where the inside of the first article or main element starts and ends."""
    m = re.search(r"<(article|main)\b[^>]*>", source, re.I)
    if not m:
        return None
    k = source.lower().rfind(f"</{m[1].lower()}>")
    return m.end(), k if k > m.end() else len(source)


FORMS = ["<p>%s</p>", "<div>%s</div>", "<ul><li>%s</li></ul>", "<table><tr><td>%s</td></tr></table>", "%s<br>", '<p>See <a href="/a">%s</a> there.</p>']


def vary(source: str) -> str:
    """The page with the paragraphs of its article as lists, tables, plain blocks and bare text."""
    at = _inside(source)
    if not at:
        return source
    i = iter(range(10**9))

    def change(m: re.Match) -> str:
        form = FORMS[next(i) % len(FORMS)]
        text = m[1].replace(", ", ",</li><li>") if "<li>" in form else m[1]
        return form.replace("%s", text)

    return source[: at[0]] + re.sub(r"<p>([^<]*)</p>", change, source[at[0] : at[1]]) + source[at[1] :]


def shorten(source: str) -> str:
    """The page with an article of a heading and one or two words."""
    at = _inside(source)
    words = re.sub(r"<[^>]*>", " ", source[at[0] : at[1]]).split() if at else []
    if not words:
        return source
    few = " ".join(words[: 1 + len(source) % 2])
    form = ("<h1>%s</h1><p>%s</p>", "<p>%s %s</p>", "%s %s", "<div>%s</div><div>%s</div>")[len(source) % 4]
    return source[: at[0]] + form % (words[0], few) + source[at[1] :]


def _labelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for source, both in ((f(s or ""), both) for s in pdf["html"] for f, both in ((str, True), (graft, False), (vary, None), (shorten, None))):
            page = Page(source)
            y = page.labels()
            if y is None:
                continue
            x = page.features()
            up = np.array([-1, *(y[p] for p in page.parent[1:])])
            for z in (x, hide(x, both)) if both is not None else (x,):
                rows += [(z[i].astype(float), int(y[i]), int(up[i])) for i in range(len(y))]
        yield pd.DataFrame(rows, columns=["x", "y", "up"])


def fit(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", most: int = 600) -> dict[str, np.ndarray]:
    """Weights and potentials from at most about ``most`` pages, picked by a hash of their id."""
    tmp = Scratch(pages.sparkSession)
    n = pages.count()
    share = min(1.0, most / max(1, n))
    some = pages.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(share * (1 << 20)) + (share >= 1)).select(F.col(html_col).cast("string").alias("html"))
    nodes = tmp.put(some.repartition(8).mapInPandas(_labelled, "x array<double>, y int, up int"), "nodes")
    pairs = np.ones((4, 3))
    for r in nodes.groupBy("up", "y").agg(F.count("*").alias("n")).collect():
        pairs[r["up"], r["y"]] += r["n"]
    model = {"w": np.zeros((3, WIDTH)), "b": np.zeros(3)}
    if (pairs[:, :].sum(axis=0) > 5).all():
        lr = LogisticRegression(featuresCol="v", labelCol="y", family="multinomial", maxIter=40, regParam=1e-3)
        m = lr.fit(nodes.select(array_to_vector("x").alias("v"), "y"))
        model = {"w": m.coefficientMatrix.toArray(), "b": m.interceptVector.toArray()}
    else:  # no labelled pages: telling tags, names and paragraphs alone
        model["w"][0, [2, 7, 10]] = 4.0
        model["w"][2, [1, 3, 8, 16]] = 3.0
        model["w"][1, [0, 14]] = 2.0
        pairs = np.array([[50, 1, 5], [20, 20, 20], [3, 1, 60], [1, 9, 1]], float)
    pairs[:3] += 0.0005 * pairs[:3].sum()
    prior = pairs.sum(axis=0) / pairs.sum()
    return model | {"prior": np.log(prior), "pair": np.log(pairs[:3] / pairs[:3].sum(axis=1, keepdims=True)), "root": np.log(pairs[3] / pairs[3].sum())}


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def marginals(x: np.ndarray, parent: np.ndarray, depth: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Exact state marginals of the nodes of many trees at once, level by level."""
    u = x @ model["w"].T + model["b"]
    u = u - _lse(u, 1)[:, None] - model["prior"]
    pair, up = model["pair"], np.zeros((len(x), 3))
    levels = _levels(depth)
    sent = np.zeros((len(x), 3))
    for at in reversed(levels[1:]):
        sent[at] = _lse(pair[None] + (u[at] + up[at])[:, None, :], 2)
        np.add.at(up, parent[at], sent[at])
    belief = u + up
    belief[levels[0]] += model["root"]
    for at in levels[1:]:
        rest = belief[parent[at]] - sent[at]
        belief[at] += _lse(rest[:, :, None] + pair[None], 1)
        belief[at] -= _lse(belief[at], 1)[:, None]
    return np.exp(belief - _lse(belief, 1)[:, None])


def _texts(sources: list[str | None], model: dict[str, np.ndarray]) -> list[str]:
    pages = [Page(s or "") for s in sources]
    sizes = np.array([len(p.parent) for p in pages])
    base = np.r_[0, np.cumsum(sizes)[:-1]]
    parent = np.concatenate([np.array(p.parent) + b for p, b in zip(pages, base, strict=True)])
    content = marginals(np.concatenate([p.features() for p in pages]), parent, np.concatenate([np.array(p.depth) for p in pages]), model)[:, 2] > 0.5
    return [" ".join(t for node, t, _ in p.blocks if content[b + node] or not p.divided) for p, b in zip(pages, base, strict=True)]


def _extract(batches: Iterator[pd.DataFrame], model: dict[str, np.ndarray], slice_rows: int = 200) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for at in range(0, len(pdf), slice_rows):
            part = pdf.iloc[at : at + slice_rows]
            texts = _texts(part["html"].tolist(), model)
            yield pd.DataFrame({"page_id": part["page_id"].astype("Int64"), "url": part["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", most: int = 600) -> DataFrame:
    """(page_id, url, text, n_chars), one row per page; the model is fitted on the table itself."""
    model = fit(pages, html_col, id_col, most)
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return src.mapInPandas(partial(_extract, model=model), "page_id long, url string, text string, n_chars long")
