"""Main text of web pages by scores over the element tree.

A page becomes a tree of elements (unclosed paragraphs, list items and cells are closed
as browsers do).  Every paragraph passes points to its ancestors: one, one per comma,
one per hundred characters; whole to its parent, half to the next, less further up.  A
container's points are discounted by the share of its text inside links.  The best
container is kept, widened to the article it lies in, and so are siblings with a fair
share of its points.  Inside, everything is text but elements that are never part of an
article: menus, headers, footers, sidebars, forms, scripts, styles, and those that are
hidden or whose class, id or role names adverts, notices, comments and the like.  Names
may mislead ("no-sidebar" on the whole page), so they are judged when all points are
known: an element that holds the article, or most of the page's points, stays.

Character references are decoded, white space in a block becomes one space, blocks are
trimmed and joined in page order by one space.  Null or empty pages, and pages without
text, give the empty string.  Rows are independent: repeated rows give equal texts and
an empty table an empty result.  The work is linear in the page's length.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt rtc s samp small span strike strong sub sup time tt u var wbr".split()
)
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in ("script", "style", "textarea", "title", "iframe", "noembed", "xmp")}
NEVER = frozenset(
    "script style textarea title iframe noembed noscript template nav footer aside form button select option datalist dialog menu object svg math canvas audio video head".split()
)
PARAGRAPHS = frozenset("p pre blockquote td dd li figcaption".split())
#: Words of a class, id or role that name what is not part of an article.
OTHER = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsense|sponsor(?:ed|s)?|promos?|promotion|banners?|cookies?|consent|notices?|alerts?|popups?|modals?|overlay"
    r"|sidebars?|side-?bar|menus?|nav|navbar|navigation|breadcrumbs?|footers?|masthead|site-?header|page-?header|toolbars?|pagination|pager"
    r"|comments?|comment-?list|disqus|replies|respond|reader-?comments|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|search"
    r"|widgets?|complementary|contentinfo)(?=$|[\s_-])",
    re.I,
)
#: A start tag closes these, back to one of the limits.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
TAG = re.compile(r"""<(?:!--|([a-zA-Z][^\s/<>]*)|/([a-zA-Z][^\s/<>]*)[^<>]*>|[!?][^<>]*>)""")
#: The rest of most start tags, whose quoted values hold no "<".
REST = re.compile(r"""(?:[^<>"'=]|=\s*(?:"[^"<]*"|'[^'<]*')?)*+>""")
STOP = re.compile(r"""[<>"']""")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
UNSHOWN = re.compile(r"display\s*:\s*none", re.I)
#: Shares of the page's points that keep an element in spite of its name: one that only
#: has such a word in a longer name, and one that is hidden or has just that name.
DOUBTED, NAMED = 0.5, 0.8

#: Shares of a paragraph's points for its parent, grandparent and so on.
SHARES = (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)
#: Share of the best container's points that keeps a sibling.
SIBLING = 0.2
SEMANTIC = {"article": 1.5, "main": 1.2}


def doubt(attributes: str) -> int:
    """0: nothing in the attributes speaks against the element, 1: a word inside a longer
    class, id or role does, 2: such a name does, or it is hidden."""
    most = 0
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            if OTHER.search(value):
                most = max(most, 1)
                if any(OTHER.fullmatch(v) for v in value.split()):
                    return 2
        elif name == "hidden" and value.lower() != "false" or name == "aria-hidden" and value.lower() == "true":
            return 2
        elif name == "style" and UNSHOWN.search(value):
            return 2
    return most


class Page:
    """Elements in the order of their start tags, and the text between."""

    def __init__(self, html: str):
        self.tag, self.parent, self.skip, self.last = ["body"], [-1], [False], []
        self.doubt: dict[int, int] = {}
        self.unclosed: set[str] = set()  # quotes that do not follow any more
        self.failed: set[int] = set()  # places behind quoted values of what is no tag
        self.chunks: list[tuple[int, str | None]] = []  # element and its text; None ends a block
        self.open = [0]
        self.counts = {"body": 1}
        self._read(html)
        while self.open:
            self._pop()
        if self.doubt:
            self._judge()

    def _judge(self) -> None:
        """Leave out the elements of doubtful names, but those that hold the article."""
        n = len(self.tag)
        chars, links, _, _ = sums = _sums(self)
        held = _given(self, sums)
        named = [False] * n  # inside an element of level 2
        for node in range(1, n):
            named[node] = named[self.parent[node]] or self.doubt.get(node) == 2
        clean = [0.0 if inside else own for inside, own in zip(named, held, strict=True)]
        for node in range(n - 1, 0, -1):
            held[self.parent[node]] += held[node]
            clean[self.parent[node]] += clean[node]
        if not held[0]:
            held = clean = [a - b for a, b in zip(chars, links, strict=True)]
        main = [i for i in range(1, n) if self.tag[i] in SEMANTIC and not self.skip[i]]
        main = [i for i in main if not named[i]] or [i for i in main if self.tag[i] == "main" or i not in self.doubt]
        most = max((held[i] for i in main), default=0.0)
        holds = [False] * n
        for node in main:
            holds[node] = held[node] >= SIBLING * most
        for node in range(n - 1, 0, -1):
            holds[self.parent[node]] |= holds[node]
        for node in range(1, n):
            if not self.skip[node]:
                level = self.doubt.get(node, 0)
                most = held[node] > (DOUBTED if level == 1 else NAMED) * held[0] or (level == 1 and clean[node] > DOUBTED * clean[0])
                self.skip[node] = self.skip[self.parent[node]] or (level > 0 and not most and not holds[node])
        self.chunks = [(node, text) for node, text in self.chunks if text is None or not self.skip[node]]

    def _pop(self) -> None:
        node = self.open.pop()
        self.counts[self.tag[node]] -= 1
        while len(self.last) <= node:
            self.last.append(0)
        self.last[node] = len(self.tag)  # elements node ... last - 1 are inside
        if self.tag[node] not in INLINE:
            self.chunks.append((node, None))

    def _close_to(self, tags: set[str], limits: set[str]) -> None:
        if not any(self.counts.get(t) for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[i]]
            if tag in tags:
                while len(self.open) > i:
                    self._pop()
                # A row also closes its cells' row.
                if tag == "tr" or "tr" not in tags:
                    return
            elif tag in limits:
                return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            return
        if tag not in INLINE:
            if tag != "br" and tag not in VOID and self.counts.get("p"):
                self._close_to({"p"}, {"button", "table", "td", "th", "caption", "object"})
            if tag in CLOSES:
                self._close_to(*CLOSES[tag])
            self.chunks.append((self.open[-1], None))
        if tag in VOID:
            return
        up = self.open[-1]
        skip = self.skip[up] or tag in NEVER
        if not skip and attributes and len(attributes) > 5:
            level = doubt(attributes)
            if level:
                self.doubt[len(self.tag)] = level
        if not skip and tag == "header":
            skip = not self._in_article()
        self.open.append(len(self.tag))
        self.counts[tag] = self.counts.get(tag, 0) + 1
        self.tag.append(tag)
        self.parent.append(up)
        self.skip.append(skip)

    def _in_article(self) -> bool:
        return bool(self.counts.get("article") or self.counts.get("main"))

    def _end(self, tag: str) -> None:
        if not self.counts.get(tag) or tag == "body":
            return
        while self.tag[self.open[-1]] != tag:
            self._pop()
        self._pop()

    def _text(self, text: str) -> None:
        if text and not self.skip[self.open[-1]]:
            self.chunks.append((self.open[-1], unescape(text) if "&" in text else text))

    def _tag_end(self, html: str, at: int) -> int:
        """Where the start tag ends whose name ends at ``at``; -1 if it is none.

        A quoted value goes to its closing quote, whatever it holds; without one the quote
        is a character like others.  No place is scanned twice after a failure.
        """
        if found := REST.match(html, at):
            return found.end()
        begin, places = at, []
        while at not in self.failed and (found := STOP.search(html, at)):
            mark, at = found[0], found.end()
            if mark == ">":
                return at
            if mark == "<":
                break
            before = found.start() - 1
            while before >= begin and html[before].isspace():
                before -= 1
            if before < begin or html[before] != "=" or mark in self.unclosed:
                continue
            end = html.find(mark, at)
            if end < 0:
                self.unclosed.add(mark)
                continue
            at = end + 1
            places.append(at)
        self.failed.update(places)
        return -1

    def _read(self, html: str) -> None:
        at, done = 0, 0
        search = TAG.search
        while found := search(html, at):
            begin, at = found.span()
            if found[1]:
                name_end, at = at, self._tag_end(html, at)
                if at < 0:
                    at = name_end
                    continue
            self._text(html[done:begin])
            if found[1]:
                start, attributes = found[1].lower(), html[name_end : at - 1]
                self._start(start, attributes)
                if start in RAW:
                    end = RAW[start].search(html, at)
                    at = end.start() if end else len(html)
                elif attributes.endswith("/") and start in ("svg", "math"):
                    self._end(start)
            elif found[2]:
                self._end(found[2].lower())
            elif html.startswith("<!--", begin):
                end = html.find("-->", begin + 4)
                at = end + 3 if end >= 0 else len(html)
            done = at
        self._text(html[done:])


def _sums(page: Page) -> tuple[list[int], list[int], list[int], list[bool]]:
    """Per element: characters and characters in links of all that is inside, commas of
    its own text, and whether it has own text."""
    n = len(page.tag)
    chars, links, commas, own = [0] * n, [0] * n, [0] * n, [False] * n
    in_link = [False] * n
    for node in range(1, n):
        in_link[node] = page.tag[node] == "a" or in_link[page.parent[node]]
    for node, text in page.chunks:
        if text:
            size = len(text.strip())
            if size:
                chars[node] += size
                links[node] += size if in_link[node] else 0
                commas[node] += text.count(",") + text.count("，") + text.count("、")
                own[node] = True
    for node in range(n - 1, 0, -1):
        up = page.parent[node]
        chars[up] += chars[node]
        links[up] += links[node]
        if page.tag[node] in INLINE:
            commas[up] += commas[node]
            own[up] = own[up] or own[node]
    return chars, links, commas, own


def _given(page: Page, sums) -> list[float]:
    """The points that each paragraph passes on."""
    chars, links, commas, own = sums
    given = [0.0] * len(page.tag)
    for node in range(1, len(given)):
        tag = page.tag[node]
        if page.skip[node] or not own[node] or tag in INLINE or not (tag in PARAGRAPHS or tag in ("div", "section", "article", "main")):
            continue
        given[node] = (1 + commas[node] + chars[node] / 100) * (1 - links[node] / max(1, chars[node]))
    return given


def containers(page: Page) -> list[int]:
    """The elements whose text is the article, in page order."""
    n = len(page.tag)
    chars, links, commas, own = sums = _sums(page)
    points = [0.0] * n
    for node, given in enumerate(_given(page, sums)):
        if not given:
            continue
        up = node if page.tag[node] not in PARAGRAPHS else page.parent[node]
        for share in SHARES:
            if up < 0:
                break
            points[up] += given * share
            up = page.parent[up]
    best, most = -1, 0.0
    for node in range(n):
        if page.skip[node] or page.tag[node] in INLINE:
            continue
        points[node] *= (1 - links[node] / max(1, chars[node])) * SEMANTIC.get(page.tag[node], 1)
        if points[node] > most:
            best, most = node, points[node]
    if best < 0:
        for wanted in ("article", "main", "body"):
            for node in range(n):
                if page.tag[node] == wanted and not page.skip[node] and (chars[node] or wanted == "body"):
                    return [node]
    up = best
    while up > 0:
        if page.tag[up] == "article":
            best = up
        up = page.parent[up]
    beside = [i for i in range(1, n) if page.parent[i] == page.parent[best] and not page.skip[i] and page.tag[i] not in INLINE] if best else [0]
    kept = []
    for i in beside:
        dense = links[i] / max(1, chars[i])
        if i == best or points[i] >= max(3, SIBLING * most) or (page.tag[i] in PARAGRAPHS and chars[i] > 80 and dense < 0.25):
            kept.append(i)
    return kept


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = Page(html)
    ranges = [(i, page.last[i]) for i in containers(page)]
    blocks, parts = [], []
    for node, text in page.chunks:
        if text is None:
            if parts:
                blocks.append(" ".join("".join(parts).split()))
                parts = []
        elif any(a <= node < b for a, b in ranges):
            parts.append(text)
    if parts:
        blocks.append(" ".join("".join(parts).split()))
    return " ".join(b for b in blocks if b)


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: the id, url, text and n_chars (code points of the text)."""

    def run(batches):
        for batch in batches:
            texts = [main_text(h) for h in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("link"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["id", "link", "text", "n_chars"],
            )

    cases = pages.select(F.col(page_id).alias("id"), F.col(url).alias("link"), F.col(html).alias("body"))
    schema = f"id {cases.schema['id'].dataType.simpleString()}, link string, text string, n_chars long"
    return cases.mapInArrow(run, schema).withColumnsRenamed({"id": page_id, "link": url})
