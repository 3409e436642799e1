"""Main text of web pages: flat text blocks, each classified by a decision tree that sees its neighbours.

A page is cut into blocks at the tags that break lines. Of each block the tree sees the number of words and the share of
them inside links, the same of the block before and behind it, and a few marks of the markup around it: inside or outside
an element that says article or main text, inside one that says navigation, advert, form, notice or comments (by its tag,
role, class or id), heading, list item. The tree is grown by Gini impurity on LABELLED, a small table of page layouts whose
pieces are marked as main text or not; lengths of texts and links are the only words it holds.

Scripts, styles, templates, embedded media, form fields, comments of the markup and hidden elements have no text. A `br` is
white space. Character references are decoded once; an unfinished one stays as it is. Tags that are never closed end with
the element around them; an unfinished tag, comment, script or style at the end of a page ends with it.

A page is read whole by one task, without a shuffle, in time linear in its length. Null and empty pages have the empty
text; a null url stays null; repeated rows get equal texts each; an empty table gives an empty one; other columns are not
read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lumenfold.llm.common import by_piece

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements without text of their own, skipped up to their end tag.
RAW = set("script style title textarea noscript iframe xmp noembed noframes".split())
SILENT = set("head svg math template object audio video canvas map datalist select option button label legend fieldset".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
#: An open element that a start tag of the same group ends, unless one of the second group stands between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
HARD_TAGS, SOFT_TAGS, BODY_TAGS = set("nav aside footer menu dialog".split()), {"form"}, set("article main".split())
HARD_ROLES, SOFT_ROLES, BODY_ROLES = set("navigation contentinfo complementary search dialog alertdialog alert menu menubar toolbar".split()), {"banner", "form"}, set("main article".split())
#: Whole tokens of classes and ids, and parts of longer ones: of what is never main text, and of what may also name a frame around it.
HARD_WORDS = set(
    "ad ads adv advert adverts dfp gpt sponsor sponsored promo promos nav navs menu menus crumbs pager toc aside skip share sharing social follow login signin signup register search subscribe popup modal toast notice notices notification alert alerts warning consent gdpr cookie cookies paywall privacy legal copyright colophon widget widgets related recommended trending popular teaser teasers tags meta byline author bio comment comments commentlist disqus respond reply replies responses discussion reactions feedback foot footer footnav".split()
)
HARD_PARTS = re.compile(
    r"advert|adsense|adslot|adcontainer|adbox|adunit|sponsor|promot|navbar|navigation|topnav|mainnav|subnav|sitenav|footer|breadcrumb|paginat|toolbar|topbar|cookie|consent|newsletter|subscri|popup|disclaimer|copyright|comment|disqus|discussion|sharebar|sharing|related|recommend|trending|blogroll|signup|signin|loginbox|searchbox|searchform|notification"
)
SOFT_WORDS = set("sidebar side rail tabs form banner banners masthead logo branding overlay header head top bottom".split())
SOFT_PARTS = re.compile(r"sidebar|masthead|siteheader|pageheader")
BODY_WORDS = set("article content contents post entry story body text main prose".split())
BODY_PARTS = re.compile(r"article|content|entry|story|posttext|postbody|maintext|fulltext")
#: Names that hold one of these say how a frame is laid out, not what is in it.
FRAMES = set("has have with without no layout template column columns theme two three".split())
HEADER = set("header head top".split())
TELLING = re.compile(r"class|id\s*=|role|hidden|style|itemprop", re.I)

TAG = re.compile(r"""(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+')|[^>])*+)>""")
ATTR = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|$)[^>]*+>?", re.I) for t in RAW}


class Place(NamedTuple):
    """What the open elements say about a text: no text, link, main text, not main text (1: a frame may say so by mistake, 2),
    heading, list item, paragraph."""

    silent: bool = False
    link: bool = False
    body: bool = False
    chrome: int = 0
    heading: bool = False
    item: bool = False
    paragraph: bool = False


def hints(names: list[str], in_body: bool) -> tuple[int, bool]:
    """(not main text: 0, 1 or 2; main text) of classes and ids."""
    chrome, body = 0, False
    for name in names:
        tokens = {t.lower() for t in TOKEN.findall(name)}
        joined = name.lower().replace("-", "").replace("_", "")
        if not FRAMES.isdisjoint(tokens):
            continue
        if not HARD_WORDS.isdisjoint(tokens) or HARD_PARTS.search(joined):
            chrome = 2
        elif not SOFT_WORDS.isdisjoint(tokens) or SOFT_PARTS.search(joined):
            # a header belongs to the page, or to the article that it stands in
            chrome = max(chrome, int(not (in_body and tokens & SOFT_WORDS <= HEADER)))
        body = body or not BODY_WORDS.isdisjoint(tokens) or bool(BODY_PARTS.search(joined))
    return chrome, body


def inside(place: Place, tag: str, attributes: str) -> Place:
    """The place within an element."""
    a = {k.lower(): (v or "").strip("\"'") for k, v in ATTR.findall(attributes)}
    role = a.get("role", "").lower()
    chrome, body = hints(f"{a.get('class', '')} {a.get('id', '')}".split(), place.body) if tag not in ("body", "html") else (0, False)
    if tag in HARD_TAGS or role in HARD_ROLES:
        chrome = 2
    elif tag in SOFT_TAGS or role in SOFT_ROLES or (tag == "header" and not place.body):
        chrome = max(chrome, 1)
    whole = tag == "main" or role == "main" or a.get("itemprop", "").lower() == "articlebody"
    around = 0 if not chrome and (whole or (tag == "article" and place.chrome < 2)) else place.chrome
    silent = tag in SILENT or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or bool(HIDDEN.search(a.get("style", "")))
    on = tag in INLINE
    return Place(
        place.silent or silent,
        place.link or tag == "a",
        place.body or whole or tag == "article" or role == "article" or (body and not chrome),
        max(around, chrome),
        tag in ("h1", "h2", "h3", "h4", "h5", "h6") or (place.heading and on),
        tag in ("li", "dt", "dd", "td", "th") or (place.item and on),
        tag in ("p", "pre", "blockquote") or (place.paragraph and on),
    )


ROOT = Place()


@dataclass
class Block:
    start: int
    text: str
    words: int
    linked: int
    place: Place


def blocks_of(html: str, known: dict[tuple[Place, str, str], Place] | None = None) -> list[Block]:
    """The flat text blocks of a page, in its order. known: places found before, to be shared by the pages of a batch."""
    known = {} if known is None else known
    out: list[Block] = []
    parts: list[tuple[int, str, Place]] = []
    stack: list[tuple[str, Place]] = []
    opened: dict[str, int] = {}

    def flush() -> None:
        if not parts:
            return
        # references are decoded in the whole block: markup within a word is no white space
        text = " ".join(unescape("".join([t for _, t, _ in parts])).split())
        if text:
            n = text.count(" ") + 1
            linked = sum(len(unescape(t).split()) for _, t, p in parts if p.link)
            longest = parts[0] if len(parts) == 1 else max(parts, key=lambda x: len(x[1].strip()))
            out.append(Block(parts[0][0], text, n, min(linked, n), longest[2]))
        parts.clear()

    def close_to(depth: int) -> None:
        for tag, _ in stack[depth:]:
            opened[tag] -= 1
        del stack[depth:]

    def close_group(group: set[str], wall: set[str]) -> None:
        """Close the innermost open element of a group, if it is open within the wall."""
        if not any(opened.get(g) for g in group):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in group:
                return close_to(i)
            if stack[i][0] in wall:
                return None

    def close_paragraph() -> None:
        if opened.get("p"):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    return close_to(i)
                if stack[i][0] not in INLINE:
                    return None

    at = 0
    while at < len(html):
        lt = html.find("<", at)
        lt = len(html) if lt < 0 else lt
        place = stack[-1][1] if stack else ROOT
        if lt > at and not place.silent:
            parts.append((at, html[at:lt], place))
        if lt == len(html):
            break
        mark = html[lt + 1 : lt + 2]
        if html.startswith("<!--", lt):
            end = html.find("-->", lt + 4)
            at = len(html) if end < 0 else end + 3
            continue
        if mark in ("!", "?"):
            end = html.find(">", lt)
            at = len(html) if end < 0 else end + 1
            continue
        m = TAG.match(html, lt + 1) if mark == "/" or mark.isalpha() and mark.isascii() else None
        if m is None:
            if mark == "/" and html[lt + 2 : lt + 3].isalpha() or mark.isalpha() and mark.isascii():
                at = len(html)  # an unfinished tag ends with the page
            else:
                if not place.silent:
                    parts.append((lt, "<", place))
                at = lt + 1
            continue
        at, tag, ends = m.end(), m[2].lower(), bool(m[1])
        block = tag not in INLINE
        if block:
            flush()
        elif tag == "br" and not place.silent:
            parts.append((lt, " ", place))
        if ends:
            if opened.get(tag):
                depth = len(stack) - 1
                while stack[depth][0] != tag:
                    depth -= 1
                # an inline end tag doesn't end blocks that stand around it
                if block or all(t in INLINE for t, _ in stack[depth:]):
                    close_to(depth)
            continue
        if tag in RAW:
            end = RAW_END[tag].search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in VOID:
            continue
        if tag == "a":
            close_group({"a"}, {t for t, _ in stack[-1:] if t not in INLINE})
        elif block:
            if tag == "body":
                close_group({"head"}, set())
            close_paragraph()
            if tag in ENDS:
                close_group(*ENDS[tag])
            if opened.get("a") and stack and stack[-1][0] in INLINE and tag == "p":
                close_group({"a"}, set())
        if m[3].endswith("/") and not block:
            continue
        base = stack[-1][1] if stack else ROOT
        key = (base, tag, m[3] if TELLING.search(m[3]) else "")
        if key not in known:
            known[key] = inside(*key)
        stack.append((tag, known[key]))
        opened[tag] = opened.get(tag, 0) + 1
    flush()
    return out


FEATURES = ("words", "links", "words_before", "links_before", "words_behind", "links_behind", "body", "chrome", "heading", "item", "paragraph", "page_has_body")


def features(blocks: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block of a page. Neighbours beyond the page's ends have no words."""
    n = len(blocks)
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    size = np.array([b.words for b in blocks], float)
    links = np.array([b.linked for b in blocks]) / size
    out[:, 0], out[:, 1] = size, links
    out[1:, 2], out[1:, 3], out[:-1, 4], out[:-1, 5] = size[:-1], links[:-1], size[1:], links[1:]
    out[:, 6:11] = [(b.place.body, b.place.chrome > 0, b.place.heading, b.place.item, b.place.paragraph) for b in blocks]
    out[:, 11] = any(b.place.body and not b.place.chrome for b in blocks)
    return out


#: Page layouts. A line is a piece of a page: + main text, - anything else. {n} stands for n words, [n] for a link of n words.
LABELLED = [
    """- <nav><ul><li>[1]</li><li>[1]</li><li>[2]</li><li>[1]</li></ul></nav><div class="ad">{9}</div>
+ <article><h1>{8}</h1><p>{40}</p><p>{3}</p><p>{90}</p><p>{12}</p></article>
- <footer>{11}</footer>""",
    """- <header><div>[2]</div><p>{6}</p><nav>[1] [1] [1]</nav></header>
+ <main><article><h1>{5}</h1><p>{1}</p><p>{2} [2] {30}</p><ul><li>{7}</li><li>[3] {2}</li><li>[4]</li></ul><h2>{3}</h2><p>{60}</p>
- <div class="advert"><p>{35}</p></div>
+ <p>{4}</p><blockquote>{22}</blockquote></article></main>
- <aside><h3>{2}</h3><p>{45}</p><ul><li>[6]</li><li>[5]</li></ul></aside><footer><p>{25}</p>[2] [1]</footer>""",
    """- <div id="header"><h1>[2]</h1><p>{5}</p></div><div id="menu">[1] | [1] | [2]</div>
+ <div id="content"><h2>{6}</h2><p>{70}</p><p>{35}</p><p>{8}</p>
- </div><div id="sidebar"><h3>{2}</h3><p>{30}</p>[3]</div><div class="comments"><h3>{2}</h3><p>{40}</p><p>{6}</p></div><div id="footer">{14}</div>""",
    """- <div class="cookie-notice">{24} [2]</div><div class="topbar">[1] [1]</div>
+ <div class="post"><h1>{7}</h1><div class="post-body"><p>{55}</p><p>[3] {6}</p><p>{28}</p></div>
- <section id="comments"><article class="comment"><p>{50}</p></article><article class="comment"><p>{3}</p></article></section><form>{6}</form></div>""",
    """- <div>[1] [1] [1] [1]</div><div>[2]</div>
+ <div>{75}</div><div>{48}</div><div>{33}</div>
- <div>[3]</div><div>[4] [2]</div><div>{3} [2]</div>""",
    """- <table><tr><td>[1]</td><td>[1]</td><td>[2]</td></tr></table>
+ <p>{38}</p><p>{64}</p><p>{26} [2] {11}</p>
- <p>[1] [1]</p><p>{4} [3]</p>""",
    """- <ul><li>[2]</li><li>[3]</li></ul>
+ <h1>{6}</h1><p>{45}</p><h2>{4}</h2><p>{12}</p><p>{30}</p>
- <h3>{2}</h3><ul><li>[5]</li><li>[7]</li></ul><p>[2]</p>""",
    """- <div class="banner">{18}</div><div class="newsletter"><h4>{4}</h4><p>{20}</p></div>
+ <article><header><h1>{9}</h1></header><p>{2}</p><p>{5}</p></article>
- <div class="related"><h3>{2}</h3><p>[8]</p><p>[6]</p></div><div role="contentinfo">{12}</div>""",
    """+ <article><p>{1}</p></article>
- <footer>{9}</footer>""",
    """- <nav>[1]</nav><div class="notice">{60}</div>
+ <article><h1>{2}</h1><p>[4]</p><p>{2}</p>
- <aside>{14}</aside><div class="sponsor">{80}</div>
+ <p>{6}</p><table><tr><th>{1}</th><td>{1}</td></tr><tr><th>{2}</th><td>[1]</td></tr></table><pre>{20}</pre>
- <nav>[2] [2]</nav><form><p>{10}</p></form></article>""",
    """- <p>{3}</p><p>[2] [3]</p>
+ <p>{50}</p><p>{80}</p><p>{14}</p><p>{41}</p>
- <p>{5}</p><p>[1]</p>""",
    """- <div><ul><li>[1]</li><li>[1]</li></ul></div>
+ <div><h1>{5}</h1></div><div><p>{33}</p></div><div><p>{20}</p></div><div><ul><li>{15}</li><li>{18}</li></ul></div><div><p>{25}</p></div>
- <div><p>{2} [1]</p><p>{6}</p></div>""",
    """- <div>{6}</div><p>{30}</p><div>{2}</div>
+ <article><h1>{5}</h1><p>{24}</p><p>{9}</p><p>[3]</p><h2>{3}</h2><p>{66}</p></article>
- <div>{12}</div><p>{44}</p><p>{8} [1]</p>""",
    """- <div><p>{16}</p></div><p>{52}</p>
+ <div id="main-content"><p>{31}</p><div>{17}</div><ul><li>[2]</li><li>{3}</li></ul><p>{5}</p></div>
- <p>{70}</p><div>{3}</div>""",
    """- <h2>{3}</h2><p>{21}</p>
+ <main><h1>{6}</h1><div>{47}</div><div>[5] {4}</div><p>{2}</p></main>
- <h2>{2}</h2><p>{33}</p><p>[4]</p>""",
    """- <p>{2}</p><p>{4}</p><p>[1] [1] {1}</p>
+ <h1>{7}</h1><p>{52}</p><p>{36}</p><p>{44}</p><p>{23}</p>
- <p>{3}</p><p>{4}</p>""",
    """- <div>{4}</div><div>[1]</div>
+ <div>{64}</div><div>{51}</div><div>{40}</div>
- <div>{5}</div><div>{3}</div><div>[2]</div>""",
    """- <div class="widget"><p>{90}</p><p>{33}</p></div><div id="disqus_thread"><p>{44}</p></div><div role="alert">{30}</div>
+ <div class="story"><h1>{4}</h1><p>{7}</p><p>{19}</p><p>{120}</p></div>
- <div class="promo"><h2>{5}</h2><p>{12}</p></div>""",
]
MARK = re.compile(r"\{(\d+)\}|\[(\d+)\]")


def layout(text: str) -> tuple[str, list[tuple[int, int]]]:
    """A page of a layout, and (start, label) of its pieces."""
    page, starts = "", []
    for line in text.splitlines():
        starts.append((len(page), int(line[0] == "+")))
        page += MARK.sub(lambda m: "<a href=x>" + "w " * int(m[2]) + "</a>" if m[2] else "w " * int(m[1]), line[2:])
    return page, starts


def variants(text: str) -> Iterator[str]:
    """A layout, with longer and with shorter texts, and without what stands before or behind the main text. Where only
    lengths tell the main text, they aren't made shorter."""
    marked = re.search(r"<article|<main|class=|id=", text) is not None
    for times in (1, 3, 0.25) if marked else (1, 3):
        lines = MARK.sub(lambda m: "{" + str(max(1, int(int(m[1]) * times))) + "}" if m[1] else m[0], text).splitlines()
        yield "\n".join(lines)
        for cut in (lines[1:] if lines[0][0] == "-" else [], lines[:-1] if lines[-1][0] == "-" else []):
            if cut:
                yield "\n".join(cut)


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of LABELLED and its variants."""
    xs, ys = [], []
    for text in LABELLED:
        for v in variants(text):
            page, starts = layout(v)
            blocks = blocks_of(page)
            at = np.searchsorted([s for s, _ in starts], [b.start for b in blocks], "right") - 1
            xs.append(features(blocks))
            ys.append(np.array([y for _, y in starts])[at])
    return np.concatenate(xs), np.concatenate(ys)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 2) -> list[tuple[int, float, int, int, float]]:
    """Nodes (feature or -1, threshold, child below it, child above, share of ones) of a tree; splits lower the Gini impurity most,
    the first feature and threshold of equally good ones."""
    nodes: list[tuple[int, float, int, int, float]] = []

    def node(rows: np.ndarray, left: int) -> int:
        me, p = len(nodes), float(y[rows].mean())
        nodes.append((-1, 0.0, -1, -1, p))
        best, found = len(rows) * p * (1 - p) - 1e-9, None
        for f in range(x.shape[1]) if left and 0 < p < 1 else ():
            v = x[rows, f]
            order = np.argsort(v, kind="stable")
            ones = np.cumsum(y[rows][order])
            cut = np.flatnonzero(v[order][1:] > v[order][:-1]) + 1
            cut = cut[(cut >= least) & (cut <= len(rows) - least)]
            if len(cut):
                a, b = ones[cut - 1] / cut, (ones[-1] - ones[cut - 1]) / (len(rows) - cut)
                cost = cut * a * (1 - a) + (len(rows) - cut) * b * (1 - b)
                i = int(cost.argmin())
                if cost[i] < best:
                    best, found = cost[i], (f, float(v[order][cut[i] - 1] + v[order][cut[i]]) / 2)
        if found:
            f, t = found
            low = x[rows, f] <= t
            nodes[me] = (f, t, node(rows[low], left - 1), node(rows[~low], left - 1), p)
        return me

    node(np.arange(len(y)), depth)
    return nodes


def probability(nodes: list[tuple[int, float, int, int, float]], x: np.ndarray) -> np.ndarray:
    """Share of main text in the leaf of each row, all rows going down one level at a time."""
    feature, threshold, low, high, p = (np.array(c) for c in zip(*nodes, strict=True))
    at = np.zeros(len(x), int)
    while (inner := np.flatnonzero(feature[at] >= 0)).size:
        n = at[inner]
        at[inner] = np.where(x[inner, feature[n]] <= threshold[n], low[n], high[n])
    return p[at]


def tree() -> list[tuple[int, float, int, int, float]]:
    return grow(*labelled())


def page_blocks(pages: list[str | None], nodes: list) -> Iterator[tuple[list[Block], np.ndarray]]:
    """Blocks and their probabilities of every page."""
    known: dict = {}
    all_blocks = [blocks_of(h, known) if h else [] for h in pages]
    p = probability(nodes, np.concatenate([features(b) for b in all_blocks] or [np.zeros((0, len(FEATURES)))]))
    ends = np.cumsum([len(b) for b in all_blocks])
    for b, end in zip(all_blocks, ends, strict=True):
        yield b, p[end - len(b) : end]


def classify_blocks(pages: DataFrame, nodes: list | None = None) -> DataFrame:
    """page_id, n (from 0, in page order), text, words, link_density, p_main: every block of every page."""
    nodes = nodes or tree()
    names = ["page_id", "n", "text", "words", "link_density", "p_main"]

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(r, n, k.text, k.words, k.linked / k.words, float(q)) for r, (ks, p) in enumerate(page_blocks(b.column(1).to_pylist(), nodes)) for n, (k, q) in enumerate(zip(ks, p, strict=True))]
        at, *cols = zip(*rows, strict=True) if rows else ((),) * 6
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names)

    kind = dict(pages.dtypes)["page_id"]
    return pages.select("page_id", "html").mapInArrow(by_piece(one, "html"), f"page_id {kind}, n int, text string, words int, link_density double, p_main double")


def extract(pages: DataFrame, nodes: list | None = None) -> DataFrame:
    """page_id, url, text (the blocks of main text, one a line), n_chars of every row."""
    nodes = nodes or tree()

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = ["\n".join(k.text for k, q in zip(ks, p, strict=True) if q >= 0.5) for ks, p in page_blocks(b.column(2).to_pylist(), nodes)]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(by_piece(one, "html"), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
