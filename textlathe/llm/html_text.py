"""Main text of web pages by tag-path ratios.

A page is read once into blocks of text, each with its root-to-leaf path of
block-level tags. Parts whose element says what they are (scripts, forms,
menus, sidebars, adverts, comments, ...) are set apart. For the rest, text and
punctuation are summed per path (after Wu et al., "Web news extraction via
path ratios"):

* text ratio: characters outside links a node; punctuation ratio: marks a node;
* fused: text ratio x (1 + punctuation ratio), and much more below an
  ``article`` or ``main`` element;
* the container is found by walking down the path tree while one child holds
  most of the fused text;
* smoothed: a path's ratio is averaged with those of the paths around it, from
  its parent up to the container, halving the weight at each step, so headings
  and one-word paragraphs share the ratio of the text that they stand in;
* paths whose smoothed ratio reaches a share of the container's are content,
  and all their nodes are kept whole and in page order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: element names of HTML, by how they are read.
RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "mark", "nobr", "q", "rb", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset",
            "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "li",
            "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "ul"}
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"})}
HEAD_ONLY = {"base", "basefont", "bgsound", "link", "meta", "noscript", "script", "style", "template", "title"}
# FIXED VALUES: elements, roles and words of class or id that are not the article.
ASIDE_TAGS = {"aside", "audio", "button", "canvas", "datalist", "dialog", "footer", "head", "header", "iframe", "menu",
              "nav", "noscript", "object", "script", "search", "select", "style", "svg", "template", "textarea", "title",
              "video"}
ASIDE_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar",
               "navigation", "search", "status", "toolbar"}
ASIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs",
               "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login",
               "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay",
               "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "search",
               "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "subscription",
               "toolbar", "widget"}
COMMENT_WORDS = {"comment", "comments", "disqus", "replies", "reply"}
NEGATED = {"has", "no", "with", "without", "hide", "non", "not"}

TOKEN = re.compile(r"""<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*>?"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
                   r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
MARKS = re.compile(r"[.,;:!?…、。！，：；？؟،।]")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Block:
    """Text of one block: its path, link characters, and the marked elements
    around it."""
    __slots__ = ("path", "parts", "links", "marks", "text")

    def __init__(self, path: int, marks: tuple):
        self.path, self.parts, self.links, self.marks, self.text = path, [], 0, marks, ""


class Page:
    """Blocks of a page in order, and its tree of tag paths (a path's parent
    has a smaller number)."""

    def __init__(self, html: str):
        self.parent, self.tag, self.inside = [-1], [""], [False]  # inside: below article or main
        self.children: dict[tuple[int, str], int] = {}
        self.blocks: list[Block] = []
        self.soft: dict[int, list] = {}  # marked element: [characters, holds article or main]
        self.article = False
        self._read(html)

    def _path(self, parent: int, tag: str) -> int:
        got = self.children.get((parent, tag))
        if got is None:
            got = self.children[parent, tag] = len(self.parent)
            self.parent.append(parent)
            self.tag.append(tag)
            self.inside.append(self.inside[parent] or tag in ("article", "main"))
        return got

    def _read(self, html: str) -> None:
        stack: list[tuple] = []  # (tag, path, marks)
        count: dict[str, int] = {}
        path, marks, links, block = 0, (), 0, None
        at, n, search = 0, len(html), TOKEN.search

        def pop_to(depth: int) -> None:
            nonlocal path, marks, links
            for tag, _, _ in stack[depth:]:
                count[tag] -= 1
                links -= tag == "a"
            del stack[depth:]
            path, marks = (stack[-1][1], stack[-1][2]) if stack else (0, ())

        def find(tags: set, stops: set) -> int:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in tags:
                    return i
                if stack[i][0] in stops:
                    return -1
            return -1

        def add(raw: str) -> None:
            nonlocal block
            if block is None:
                if raw.isspace():
                    return
                block = Block(path, marks)
                self.blocks.append(block)
            text = unescape(raw) if "&" in raw else raw
            block.parts.append(text)
            if links:
                block.links += len(text)

        while at < n:
            m = search(html, at)
            begin = m.start() if m else n
            if begin > at and marks is not None:
                add(html[at:begin])
            if m is None:
                break
            at = m.end()
            end, name, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
            if name is None:
                continue  # a comment or declaration
            tag = name.lower()
            if end:
                if tag not in INLINE:
                    block = None
                if count.get(tag):
                    i = len(stack) - 1
                    while stack[i][0] != tag:
                        if tag in INLINE and stack[i][0] not in INLINE:
                            i = -1  # an inline end does not close blocks
                            break
                        i -= 1
                    if i >= 0:
                        if stack[i][2] != (stack[i - 1][2] if i else ()):
                            block = None
                        pop_to(i)
                continue
            if tag == "br":
                if block is not None:
                    block.parts.append(" ")
                continue
            if tag not in INLINE:
                block = None
            if tag in ("html", "body") and count.get(tag):
                continue
            if count.get("head") and tag not in HEAD_ONLY:
                pop_to(find({"head"}, set()))
            if tag in CLOSES_P and count.get("p"):
                i = find({"p"}, {"button", "table", "td", "th", "caption", "object"})
                if i >= 0:
                    pop_to(i)
            if tag in ENDS:
                i = find(*ENDS[tag])
                if i >= 0:
                    pop_to(i)
            if tag in VOID:
                continue
            now = self._marked(tag, attributes, path, marks)
            if now is not marks and tag in INLINE:
                block = None
            if tag in RAW:
                close = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I).search(html, at) if tag != "plaintext" else None
                at = close.start() if close else n
                continue
            if tag in ("article", "main") and None not in now:
                self.article = True
                for k in marks:
                    self.soft[k][1] = True
            where = path if tag in INLINE else self._path(path, tag)
            stack.append((tag, where, now))
            count[tag] = count.get(tag, 0) + 1
            links += tag == "a"
            path, marks = where, now
        for b in self.blocks:
            b.text = " ".join("".join(b.parts).split())
            b.parts = None
            for k in b.marks:
                if k is not None:
                    self.soft[k][0] += len(b.text)

    def _marked(self, tag: str, attributes: str, path: int, marks: tuple) -> tuple:
        """Marks of a new element: None for a part that is never the article,
        a number for one that its class, id or kind speaks against."""
        if None in marks or tag in ("html", "body"):
            return marks
        if tag in ASIDE_TAGS and not (tag == "header" and self.inside[path]):
            return (None,)
        soft = tag == "form"
        if attributes and not attributes.isspace():
            known = set()
            for name, value in ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in known:
                    continue
                known.add(name)
                value = value.strip("\"'")
                if name == "hidden" or (name == "style" and HIDDEN.search(value)):
                    return (None,)
                if name == "role" and value.lower() in ASIDE_ROLES:
                    return (None,)
                if name in ("class", "id") and tag != "main":
                    words = COMMENT_WORDS if tag == "article" else ASIDE_WORDS
                    for token in value.split():
                        split = [w.lower() for w in WORDS.findall(token)]
                        if not NEGATED.intersection(split) and words.intersection(split):
                            soft = True
        if not soft:
            return marks
        k = len(self.soft)
        self.soft[k] = [0, False]
        return (*marks, k)

    def kept(self) -> list[Block]:
        """Blocks outside marked parts. A mark is lifted from an element that
        holds the article, or, on a page without one, most of the text."""
        open_blocks = [b for b in self.blocks if b.text and None not in b.marks]
        total = sum(len(b.text) for b in open_blocks)
        lifted = {k for k, (size, holds) in self.soft.items()
                  if 2 * size > total and (holds or not self.article)}
        return [b for b in open_blocks if lifted.issuperset(b.marks)]


def content_blocks(page: Page, share: float = 0.6, threshold: float = 0.05, article_weight: float = 100.0) -> list[Block]:
    """Blocks on content paths, in page order."""
    blocks = page.kept()
    if not blocks:
        return []
    n = len(page.parent)
    nodes, chars, marks, size = [0] * n, [0] * n, [0] * n, [0] * n
    for b in blocks:
        nodes[b.path] += 1
        chars[b.path] += max(0, len(b.text) - b.links)
        size[b.path] += len(b.text)
        marks[b.path] += len(MARKS.findall(b.text))
    fused = [chars[p] / nodes[p] * (1 + marks[p] / nodes[p]) * (article_weight if page.inside[p] else 1.0)
             if nodes[p] else 0.0 for p in range(n)]
    # sums over the subtree of a path
    mass, weight = [f * c for f, c in zip(fused, chars)], [float(c) for c in chars]
    for p in range(n - 1, 0, -1):
        mass[page.parent[p]] += mass[p]
        weight[page.parent[p]] += weight[p]
    if not mass[0]:
        return blocks  # nothing but links
    mean = [m / w if w else 0.0 for m, w in zip(mass, weight)]
    # the container: down while one child that has children holds most of the fused text
    inner: dict[int, list[int]] = {}
    for p in range(1, n):
        inner.setdefault(page.parent[p], []).append(p)
    box = 0
    while True:
        best = max(inner.get(box, ()), key=lambda p: mass[p], default=None)
        if best is None or mass[best] < share * mass[0] or (page.tag[best] not in ("article", "main")
                                                            and not any(weight[c] for c in inner.get(best, ()))):
            break
        box = best
        if page.tag[box] == "article":
            break
    flat = page.tag[box] in ("", "html", "body")  # no element of its own around the text
    # smoothed ratio, from the container down
    level, total, chosen = [0.0] * n, [0.0] * n, [False] * n
    below = [False] * n
    below[box] = True
    for p in range(n):
        up = page.parent[p]
        if p != box and up >= 0:
            below[p] = below[up]
        shared = below[p] and p != box and not (flat and up == box)
        level[p] = mean[p] + (0.5 * level[up] if shared else 0.0)
        total[p] = 1.0 + (0.5 * total[up] if shared else 0.0)
        if not nodes[p]:
            continue
        ratio = level[p] / total[p]
        menu = not page.inside[p] and nodes[p] > 2 and 5 * chars[p] < size[p]  # almost all of it links
        if below[p] and not flat:
            chosen[p] = ratio >= threshold * mean[box] and not menu
        elif below[p]:
            chosen[p] = (ratio >= 4 * threshold * mean[box] or page.tag[p] in ("h1", "h2", "h3")) and not menu
        else:  # text of the same kind elsewhere
            chosen[p] = fused[p] >= 0.5 * mean[box] and not menu
    return [b for b in blocks if chosen[b.path]]


def main_text(html: str | None) -> str:
    """The article of a page: content blocks in page order, joined by one space."""
    if not html:
        return ""
    return " ".join([b.text for b in content_blocks(Page(html))])


def extract(df: DataFrame, key: str = "page_id", html: str = "html", carry: list[str] | None = None) -> DataFrame:
    """``key``, the columns of ``carry``, ``text`` and ``n_chars`` (code points)
    for every row. A null, empty or textless page gives the empty text. Row-wise
    without a shuffle; a worker holds one input batch and one output batch.
    Repeated rows stay; columns that are not named are not carried and may have
    any name.
    """
    names = [key, *(carry or [])]
    source = df.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], F.col(html).cast("string").alias("html"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = [main_text(h.as_py()) for h in part.column(len(names))]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())],
                                                 names=[*part.schema.names[:-1], "text"])

    out = source.mapInArrow(run, f"{kinds}, text string")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "text",
                      F.char_length("text").cast("long").alias("n_chars"))
