"""Main text of a web page by composite text density.

Every DOM node gets its characters per tag, adjusted for links (many link characters or
link tags lower it). A node's density sum is the sum of its children's densities (bare
text between them counts as a child); the node with the largest sum is the core of the
page. The smallest density on its path to the body is the threshold: other nodes at or
above it contribute their own densest subtree. Where most of the core's text lies in
article or main elements, the core is sought in them. An article around the core is text as
a whole (with other articles beside it that reach the threshold); a main element without
articles that hold most of its text only bounds the search.

Scripts, styles, controls and the stand-in texts of embedded media are always left out;
formulas, drawings' texts, image maps and objects are text like any other. Menus, page headers,
footers, sidebars, notices, adverts, forms and comments are left out of the tree by element,
role, class and id before densities are taken, unless the page's text lies in them: a
wrapper stays where it holds a main element or (for a form, or where nothing outside is
marked as the article) an article, or most of the page's text outside links.

Cases: null and empty pages give an empty text, unclosed and stray tags are repaired as
browsers do for common cases, very long or deeply nested pages need no recursion, pages
without markup are one block; repeated rows and null ids pass through; other columns are
ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import small_batches

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select option optgroup textarea input label "
    "iframe canvas embed audio video dialog menu datalist noembed noframes title annotation annotation-xml".split())
WRAPPERS = frozenset("head nav footer aside form dialog menu".split())
EXTENT = frozenset(("article", "main"))
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
             "tfoot": ("tr", "td", "th", "tbody")}
SCOPE = frozenset("ul ol dl table body html article main section div td th".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
                  "toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead comment comments reply replies disqus cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social related "
    "recommended widget toolbar pagination pager copyright disclaimer".split())

#: Wrappers by these names yield to any marked article, however much text they hold.
FIRM_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored comment comments reply replies "
                       "disqus cookie cookies consent gdpr".split())
#: Names that begin so tell what a layout has or lacks, or what a post is about.
MODIFIERS = frozenset("has no not with without category tag".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KEPT, WRAPPER, FIRM, CONTROL = range(4)

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)""", re.S)
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


def _unwanted(tag: str, attributes: str, in_extent: bool) -> int:
    """Whether an element is kept, a wrapper to leave out by its name, or a control."""
    if tag in DROPPED:
        if tag not in WRAPPERS:
            return CONTROL
        return WRAPPER if tag in ("form", "head") else FIRM
    if tag == "header" and not in_extent:
        return FIRM
    if not attributes or tag in ("html", "body", "main"):
        return KEPT
    found = KEPT
    seen = set()
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        if name in seen:  # the first of repeated attributes holds
            continue
        seen.add(name)
        value = m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return FIRM
        if name == "role" and value.lower() in ROLES:
            found = max(found, WRAPPER if value.lower() == "form" else FIRM)
        if name in ("class", "id"):
            for label in value.split():
                words = _SPLIT.split(_CAMEL.sub(r"\1 \2", label).lower())
                if words[0] in MODIFIERS:
                    continue
                if not FIRM_WORDS.isdisjoint(words):
                    return FIRM
                if not WORDS.isdisjoint(words) or not in_extent and "header" in words:
                    found = max(found, WRAPPER)
    return found


def _tag_end(source: str, at: int, gone: set[str]) -> int:
    """Where a tag ends whose name ends at ``at``: the first > outside quotes, however long the
    quoted values are. A quote that is never closed is no quote: the tag ends at the first >.
    ``gone`` collects quotes that do not occur further on, so that they are sought only once."""
    i = at
    while (m := _STOP.search(source, i)) is not None:
        quote = m[0]
        if quote == ">":
            return m.start()
        j = -1 if quote in gone else source.find(quote, m.end())
        if j < 0:
            gone.add(quote)
            break
        i = j + 1
    return source.find(">", at)


def density(chars: int, tags: int, link_chars: int, link_tags: int, body: float) -> float:
    """Link-adjusted characters per tag of a subtree; ``body`` is the page's share of link characters."""
    if not chars:
        return 0.0
    lc, lt, t = max(link_chars, 1), max(link_tags, 1), max(tags, 1)
    base = math.log(chars / max(chars - lc, 1) * lc + body * chars + math.e)
    return chars / t * max(math.log(chars / lc * t / lt), 0.0) / math.log(base)


class Page:
    """A repaired tree in document order: node i has tag, parent and items (text or node)."""

    def __init__(self, source: str):
        self.tag, self.parent = ["body"], [-1]
        self.items: list[list] = [[]]
        self.unwanted = [KEPT]
        extent = [False]  # whether the node lies in an article or main element
        open_tags: Counter[str] = Counter()
        stack, at, last = [0], 0, source.rfind(">") + 1
        gone: set[str] = set()

        def close(depth: int) -> None:
            open_tags.subtract(self.tag[s] for s in stack[depth:])
            del stack[depth:]

        def text(s: str) -> None:
            if s:
                self.items[stack[-1]].append(s)

        while True:
            m = _TOKEN.search(source, at, last) if at < last else None
            if m is None:
                tail = source[at:]
                cut = re.search(r"<[a-zA-Z/][^<>]*\Z", tail)  # a tag that the page's end cuts off
                text(tail[:cut.start()] if cut else tail)
                break
            text(source[at:m.start()])
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            end = _tag_end(source, at, gone)
            attributes = source[at:end]
            at = end + 1
            if m[1]:
                if not open_tags[tag]:
                    continue
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[depth]] == tag:
                        close(depth)
                        break
                continue
            if tag in ("html", "body"):
                continue
            if tag == "br":
                text("\n")
                continue
            if tag in BLOCK:  # a paragraph ends where another block begins
                for depth in range(len(stack) - 1, 0, -1):
                    t = self.tag[stack[depth]]
                    if t == "p":
                        close(depth)
                        break
                    if t in BLOCK:
                        break
            if tag in CLOSED_BY:
                for depth in range(len(stack) - 1, 0, -1):
                    t = self.tag[stack[depth]]
                    if t in CLOSED_BY[tag]:
                        close(depth)
                        break
                    if t in SCOPE:
                        break
            if tag in VOID:
                if tag == "hr":
                    self._add(tag, stack[-1], KEPT)
                    extent.append(extent[stack[-1]])
                continue
            inside = extent[stack[-1]]
            node = self._add(tag, stack[-1], _unwanted(tag, attributes, inside))
            extent.append(inside or tag in EXTENT)
            if tag in RAW:
                close_tag = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
                at = close_tag.end() if close_tag else len(source)
                continue
            if not attributes.rstrip().endswith("/") or tag in BLOCK:
                stack.append(node)
                open_tags[tag] += 1

    def _add(self, tag: str, parent: int, unwanted: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.items.append([])
        self.unwanted.append(unwanted)
        self.items[parent].append(len(self.tag) - 1)
        return len(self.tag) - 1

    def _wanted(self) -> list[int]:
        """Characters of each subtree outside links, headings and what is left out."""
        out = [0] * len(self.tag)
        for i in range(len(out) - 1, -1, -1):
            if self.unwanted[i] == CONTROL:
                out[i] = 0
                continue
            if not self.muted[i]:
                out[i] += sum(self.own[i])
            if i and not self.unwanted[i]:
                out[self.parent[i]] += out[i]
        return out

    def _articles(self, wanted: list[int]) -> list[int]:
        """The outermost article and main elements that have text and lie in nothing unwanted."""
        out, covered = [], [False] * len(self.tag)
        for i in range(1, len(self.tag)):
            covered[i] = covered[self.parent[i]] or self.unwanted[i] != KEPT
            if not covered[i] and self.tag[i] in EXTENT and wanted[i]:
                out.append(i)
                covered[i] = True
        return out

    def _keep_path(self, node: int, seen: set[int]) -> None:
        while node > 0 and node not in seen:
            seen.add(node)
            if self.unwanted[node] != CONTROL:
                self.unwanted[node] = KEPT
            node = self.parent[node]

    def _spare(self) -> None:
        """Keep the unwanted wrappers in which the page's text lies."""
        n, tag, unwanted = len(self.tag), self.tag, self.unwanted
        free = [0] * n  # characters outside links
        in_link, below = [False] * n, [False] * n
        self.muted = [False] * n
        for i in range(1, n):
            p = self.parent[i]
            in_link[i] = in_link[p] or tag[i] == "a"
            self.muted[i] = in_link[i] or self.muted[p] or tag[i] in HEADINGS
            below[i] = below[p] or unwanted[p] == CONTROL
            if below[i]:
                unwanted[i] = CONTROL
        clean = [False] * n  # whether an article lies below, with no wrapper but forms between
        for i in range(n - 1, -1, -1):
            if unwanted[i] == CONTROL:
                continue
            free[i] += 0 if in_link[i] else sum(self.own[i])
            if tag[i] in ("form", "head") and clean[i]:
                unwanted[i] = KEPT
            if i:
                free[self.parent[i]] += free[i]
                if unwanted[i] == KEPT and free[i] and (clean[i] or tag[i] in EXTENT):
                    clean[self.parent[i]] = True
        seen: set[int] = set()
        for i in range(n):
            if tag[i] == "main" and free[i] and unwanted[i] == KEPT:
                self._keep_path(i, seen)
        if not any(unwanted[i] in (WRAPPER, FIRM) for i in range(n)):
            return
        wanted = self._wanted()
        articles = self._articles(wanted)
        if not articles:
            inner = [i for i in range(n) if tag[i] == "article" and unwanted[i] == KEPT and free[i] > wanted[0]]
            if not inner and 10 * wanted[0] < free[0]:  # a page of little but comments
                inner = [i for i in range(n) if tag[i] == "article" and unwanted[i] != CONTROL and free[i]]
                for i in inner:
                    self._keep_path(i, seen)
            elif inner:
                self._keep_path(max(inner, key=lambda i: (free[i], -i)), seen)
            if inner:
                wanted = self._wanted()
                articles = self._articles(wanted)
        most = [i for i in range(1, n) if unwanted[i] in (WRAPPER, FIRM) and 2 * free[i] > free[0]]
        if most:  # each lies in the one before
            above, i = set(), most[-1]
            while i > 0:
                above.add(i)
                i = self.parent[i]
            beside = sum(wanted[i] for i in articles if i not in above)
            for i in most:
                if not articles or unwanted[i] == WRAPPER and 10 * beside < free[0]:
                    unwanted[i] = KEPT

    def prune(self) -> None:
        """Remove unwanted subtrees, but not those in which the page's text lies."""
        self.own = [[] if u == CONTROL else
                    [k for k in (len(" ".join(html.unescape(x).split())) for x in items if isinstance(x, str)) if k]
                    for items, u in zip(self.items, self.unwanted, strict=True)]
        if any(self.unwanted):
            self._spare()
        self.gone = [u != KEPT for u in self.unwanted]
        for i in range(1, len(self.tag)):
            if self.gone[self.parent[i]]:
                self.gone[i] = True

    def core(self) -> set[int]:
        """The nodes whose subtrees are the main text."""
        n = len(self.tag)
        chars, tags = [0] * n, [0] * n
        link_chars, link_tags = [0] * n, [0] * n
        own = self.own
        for i in range(n - 1, -1, -1):
            if self.gone[i]:
                continue
            chars[i] += sum(own[i])
            if self.tag[i] == "a":
                link_chars[i], link_tags[i] = chars[i], link_tags[i] + 1
            p = self.parent[i]
            if p >= 0:
                chars[p] += chars[i]
                tags[p] += tags[i] + 1
                link_chars[p] += link_chars[i]
                link_tags[p] += link_tags[i]
        if not chars[0]:
            return set()
        body = link_chars[0] / chars[0]

        dens = [density(*x, body) for x in zip(chars, tags, link_chars, link_tags, strict=True)]
        sums = [0.0] * n
        for i in range(n - 1, -1, -1):
            if self.gone[i]:
                continue
            kids = [k for k in self.items[i] if not isinstance(k, str)]
            if not kids:
                sums[i] += dens[i]
            else:
                sums[i] += sum(density(c, 1, 0, 0, body) for c in own[i])
            if self.parent[i] >= 0:
                sums[self.parent[i]] += dens[i]
        alive = [i for i in range(n) if not self.gone[i] and chars[i]]
        best = list(range(n))  # the node with the largest sum in each subtree
        marked_up = [0] * n  # characters of the outermost articles and mains below
        for i in reversed(alive):
            p = self.parent[i]
            if i:
                if sums[best[i]] >= sums[best[p]] and (sums[best[i]] > sums[best[p]] or best[p] != p):
                    best[p] = best[i]
                marked_up[p] += chars[i] if self.tag[i] in EXTENT else marked_up[i]

        def around(i: int) -> int:
            """The innermost article or main at or above a node, 0 if there is none."""
            while i and self.tag[i] not in EXTENT:
                i = self.parent[i]
            return i

        def outermost(i: int) -> list[int]:
            """The outermost articles and mains below a node."""
            out, todo = [], [i]
            while todo:
                for k in self.items[todo.pop()]:
                    if not isinstance(k, str) and not self.gone[k] and chars[k]:
                        (out if self.tag[k] in EXTENT else todo).append(k)
            return out

        top = best[0]
        extent = around(top)
        while self.tag[extent] != "article" and 2 * marked_up[top] > chars[top]:
            top = best[max(outermost(top), key=lambda i: (sums[best[i]], -i))]
            extent = around(top)
        # an article with articles of its own, such as the entries of a day, is one text
        i = self.parent[extent]
        while self.tag[extent] == "article" and (i := around(max(i, 0))) and self.tag[i] == "article":
            if 2 * chars[extent] <= chars[i]:
                extent = i
            i = self.parent[i]
        path = [top]
        while path[-1] != extent:
            path.append(self.parent[path[-1]])
        # the body itself averages all that surrounds the text: it counts only as the core
        threshold = min(dens[i] for i in (path if extent else path[:-1] or path))
        if self.tag[extent] == "article":
            scope = around(max(self.parent[extent], 0))
            texts = {extent} | {i for i in outermost(scope) if self.tag[i] == "article" and dens[i] >= threshold
                                and link_chars[i] <= 0.25 * chars[i]}
            # a title above them in the same main element belongs to them
            return texts | {i for i in alive if scope < i < min(texts) and self.tag[i] == "h1" and around(i) == scope > 0}
        inside = [not extent] * n
        marked = {top}
        for i in alive:
            inside[i] = inside[i] or i == extent or i > 0 and inside[self.parent[i]]
            links = link_chars[i] / chars[i]
            if inside[i] and self.tag[i] in BLOCK and i and i != extent and dens[i] >= threshold and links <= 0.25 and (
                    self.parent[i] not in marked):
                marked.add(best[i])
        # headings beside what is marked, or in the same main element, belong to it
        parents = {self.parent[m] for m in marked if m}
        marked |= {i for i in alive if self.tag[i] in HEADINGS and (
            self.parent[i] in parents or extent and inside[i] and link_chars[i] <= 0.25 * chars[i])}
        return marked

    def blocks(self, roots: set[int]) -> list[str]:
        """The text blocks under the roots, in page order."""
        out: list[str] = []
        now: list[str] = []

        def end() -> None:
            if now:
                s = " ".join(html.unescape("".join(now)).split())
                if s:
                    out.append(s)
                now.clear()

        todo: list[tuple] = [(0, 0 in roots, False)]
        while todo:
            item, inside, leaving = todo.pop()
            if isinstance(item, str):
                if inside:
                    now.append(item)
                continue
            if leaving:
                end()
                continue
            if self.gone[item]:
                continue
            block = self.tag[item] in BLOCK
            inside = inside or item in roots
            if block:
                end()
                todo.append((item, inside, True))
            todo.extend((k, inside, False) for k in reversed(self.items[item]))
        end()
        return out


def main_text(source: str | None) -> str:
    """The main text of one page, blocks joined by line feeds."""
    if not source:
        return ""
    page = Page(source)
    page.prune()
    return "\n".join(page.blocks(page.core()))


def extract_pages(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
