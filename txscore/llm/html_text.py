"""Main text of web pages by composite text density.

A page is parsed into nodes. Elements that hold no article text by their tag or role (menus, page
headers, footers, controls, scripts, styles, hidden parts) are left out. So are elements whose
class or id names reader comments, a sidebar, notice, advert and the like, however long, inside an
article too; a form goes unless it holds more text than all outside of it. If nothing else holds
text, the named element with the most text stays, as does one (but for comments) around an article
or main element with more text than all that is free. Names that also tell a state or a wrapper
(``has-sidebar``, ``comments-open``, ``social-policy``), and names of article elements, are evidence
only: such an element is left out unless it holds the node with the largest density sum of the
rest, the article or main element with most of the text, or more text than all that stays without
it (in a page whose articles hold text, only elements in them are measured by this share). For every
other node

    density = C / T * log(C / LC * T / LT)  to the base  ln(C / (C - LC) * LC + LCb / Cb * C + e)

with C characters and T tags below it, LC and LT of them in links, and b the body: the link-
adjusted characters for each tag. A node's density sum is that of its children, not
counting inline elements, which only mark words up. The node with the largest density sum is
the main subtree; the smallest density on its path from the body is the threshold, and in every
other subtree with at least this density the node with the largest density sum is content
as well. A content node in an article element stands for the whole of it, title included.
Blocks of several links that hold hardly any other text are menus, and go, outside of articles.

Text of content nodes is returned whole: character references decoded, white space in a
block as one space, blocks in page order joined by one line break. Null or empty pages, and
pages without text, give an empty text. Work is linear in the page, whose nesting may be
of any depth. Each row is a page of its own, repeated or not.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import require, slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
RAW = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in (
    "script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "svg", "math")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section summary table tbody tfoot thead tr ul".split())
#: Elements that an opening tag ends, up to the scope they lie in.
ENDS = {t: ({"p"}, {"button", "table", "td", "th", "caption"}) for t in BLOCKS} | {
    "li": ({"li", "p"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}), "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}),
    "option": ({"option"}, {"select"})}
del ENDS["html"], ENDS["body"]
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
#: What a closing tag doesn't reach beyond.
FENCES = frozenset("table td th".split())
DROPPED = frozenset(
    "head nav footer aside button select input textarea label fieldset dialog menu script style "
    "noscript iframe template svg math object embed canvas audio video map datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert "
                  "menu menubar toolbar tablist".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos "
    "promotion promoted banner banners cookie cookies consent gdpr notice notices notification "
    "notifications popup modal overlay lightbox sidebar sidebars widget widgets related recommended "
    "recommendations share sharing social comment comments commentlist disqus reply replies respond "
    "newsletter subscribe subscription signup login breadcrumb breadcrumbs menu menus nav navbar "
    "navigation footer masthead topbar toolbar pagination pager copyright paywall".split())
#: Marks of reader comments, and parts of a name that tell a state of the page or a wrapper.
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
STATES = frozenset("has no not with without is open closed enabled disabled policy page site wrapper wrap "
                   "container layout".split())
#: What an element's name says: nothing, evidence only, a form, boilerplate, reader comments.
FREE, WEAK, FORM, STRONG, COMMENT = range(5)
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Share of a block's characters in links that makes it a menu.
MENU_SHARE = 0.8
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def named_as(tag: str, names: str, inside: bool) -> int:
    """What the words of a class or id say of an element."""
    out = FREE
    for word in names.split():
        parts = {p.lower() for p in NAME_PARTS.findall(word)}
        if parts & MARKS:
            if parts & STATES:
                kind = WEAK
            elif parts & COMMENTS:
                kind = COMMENT
            else:
                kind = WEAK if tag == "article" else STRONG
        else:
            kind = WEAK if "header" in parts and not inside and tag != "article" else FREE
        out = max(out, kind)
    return out


def boilerplate(tag: str, attributes: str, inside: bool) -> tuple[bool, int]:
    """(the element holds no article text, what its class or id says). ``inside``: it lies in an
    article or main element."""
    if tag in DROPPED or tag == "header" and not inside:
        return True, FREE
    named = FORM if tag == "form" else FREE
    if not attributes or tag in ("html", "body", "main"):
        return False, named
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id") and tag != "form":
            named = max(named, named_as(tag, value, inside))
        elif name == "role" and value.lower() in ROLES or name == "hidden" or (
                name == "aria-hidden" and value.lower() == "true") or (
                name == "style" and HIDDEN.search(value)):
            return True, FREE
    return False, named


class Page:
    """Nodes of a page in page order (parents before children), without boilerplate."""

    def __init__(self, source: str):
        self.tags, self.parents = ["html"], [-1]
        self.gone = [False]  # by node: left out
        self.named = [FREE]
        self.texts: list[tuple[int, str]] = []  # (node, text); node -1: the end of a block
        self.body = 0
        stack = [(0, "html", False)]  # (node or -1 where text is dropped, tag, inside an article)
        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            stop = m.start() if m else end
            if stop > at and stack[-1][0] >= 0:
                self.texts.append((stack[-1][0], source[at:stop]))
            if not m:
                break
            at = m.end()
            close, tag, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
            if not tag:
                continue
            tag = tag.lower()
            if tag in BLOCKS:
                self.texts.append((-1, ""))
            elif tag in ("br", "td", "th"):
                self.texts.append((stack[-1][0], " ") if stack[-1][0] >= 0 else (-2, ""))
            if close:
                self._close(stack, tag)
                continue
            if tag in ("html", "body") and len(stack) > 1 and any(t == tag for _, t, _ in stack):
                continue
            if tag in ENDS:
                ended, scope = ENDS[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][1] in scope:
                        break
                    if stack[i][1] in ended:
                        del stack[i:]
                        if tag not in ("li", "dt", "dd", "tr", "td", "th"):
                            break
            if tag == "body":  # an unclosed head ends here
                del stack[1:]
            top, _, inside = stack[-1]
            node = -1
            drop, named = boilerplate(tag, attributes, inside) if top >= 0 else (True, FREE)
            if not drop:
                node = len(self.tags)
                self.tags.append(tag)
                self.parents.append(top)
                self.gone.append(False)
                self.named.append(named)
                if tag == "body" and not self.body:
                    self.body = node
            if tag in RAW:
                found = RAW[tag].search(source, at)
                at = found.start() if found else end
                if not found:
                    break
            if tag not in VOID and not (attributes.endswith("/") and tag in ("path", "svg")):
                stack.append((node, tag, inside or tag in ("article", "main")))
        if any(k > WEAK for k in self.named):
            self._leave_out()
        if WEAK in self.named:
            self._settle()

    def _leave_out(self) -> None:
        """Leaves out what is named as boilerplate, with all it holds, but for the exceptions."""
        n, kind = len(self.tags), self.named
        own, linked = [0] * n, [False] * n  # text of a node, then that outside of named elements below
        for i in range(1, n):
            linked[i] = self.tags[i] == "a" or linked[self.parents[i]]
        for node, text in self.texts:
            if node >= 0 and not linked[node]:
                own[node] += len(" ".join(text.split()))
        full, main = own[:], [0] * n  # main: of the largest article or main element
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            full[up] += full[i]
            own[up] += 0 if kind[i] > WEAK else own[i]
            size = max(main[i], own[i] if self.tags[i] in ("article", "main") else 0)
            main[up] = max(main[up], size)
        free, heap = own[0], []
        below: dict[int, list[int]] = {}  # named elements by the next named one around them, or -1
        around = [-1] * n
        for i in range(n):
            up = around[self.parents[i]] if i else -1
            around[i] = i if kind[i] > WEAK else up
            if kind[i] > WEAK:
                below.setdefault(up, []).append(i)

        def offer(nodes: list[int]) -> None:
            for i in nodes:
                # reader comments come last, whatever their length
                heapq.heappush(heap, (kind[i] == COMMENT, -own[i], -full[i], i))

        offer(below.get(-1, []))
        while heap:
            _, _, _, i = heapq.heappop(heap)
            if not free and full[i] or kind[i] == FORM and own[i] > free or kind[i] != COMMENT and main[i] > free:
                kind[i] = WEAK if kind[i] != FORM else FREE
                free += own[i]
                offer(below.get(i, []))
        for i in range(1, n):
            self.gone[i] = kind[i] > WEAK or self.gone[self.parents[i]]

    def _settle(self) -> None:
        """Decides which elements named as evidence are left out, with all they hold."""
        n, out = len(self.tags), self.gone
        named = [k == WEAK and not g for k, g in zip(self.named, out, strict=True)]
        _, total = self.densities()
        plain, linked, held = [0] * n, [False] * n, [False] * n  # held: in an article or main element
        for i in range(1, n):
            linked[i] = self.tags[i] == "a" or linked[self.parents[i]]
            held[i] = self.tags[i] in ("article", "main") or held[self.parents[i]]
        for node, text in self.texts:
            if node >= 0 and not linked[node] and not out[node]:
                plain[node] += len(" ".join(text.split()))

        def keep(node: int) -> None:
            while node >= 0:
                named[node] = False
                node = self.parents[node]

        def sums() -> tuple[list[int], list[int]]:
            """Text of every node, and that outside of named elements below it."""
            full, own = plain[:], plain[:]
            for i in range(n - 1, 0, -1):
                full[self.parents[i]] += full[i]
                own[self.parents[i]] += 0 if named[i] else own[i]
            return full, own

        keep(max((i for i in range(self.body, n) if not out[i]), key=lambda i: (total[i], -i), default=0))
        full, own = sums()
        inside = [False] * n  # in a named element
        for i in range(n):
            inside[i] = named[i] or i > 0 and inside[self.parents[i]]
        free = sum(p for p, h, x in zip(plain, held, inside, strict=True) if h and not x)
        most = max((i for i in range(n) if self.tags[i] in ("article", "main") and inside[i]),
                   key=lambda i: (own[i], -i), default=0)
        if most and own[most] > free:
            keep(most)
            full, own = sums()
            free = own[most]
        below: dict[int, list[int]] = {}  # named elements by the next named one around them, or -1
        around = [-1] * n
        for i in range(n):
            up = around[self.parents[i]] if i else -1
            if named[i]:
                below.setdefault(up, []).append(i)
            around[i] = i if named[i] else up
        # beside an article with text of its own, however short, the share of the page says nothing
        stays, heap = own[0], [(-full[i], i) for i in below.get(-1, []) if held[i] or not free]
        heapq.heapify(heap)
        while heap and -heap[0][0] > stays:
            _, node = heapq.heappop(heap)
            named[node] = False
            stays += own[node]
            for i in below.get(node, []):
                heapq.heappush(heap, (-full[i], i))
        for i in range(1, n):
            self.gone[i] = out[i] or named[i] or self.gone[self.parents[i]]

    @staticmethod
    def _close(stack: list[tuple[int, str, bool]], tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][1] == tag:
                del stack[i:]
                return
            if stack[i][1] in FENCES and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                return

    def densities(self) -> tuple[list[float], list[float]]:
        """Density and density sum of every node."""
        n = len(self.tags)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        linked = [False] * n
        for i in range(1, n):
            linked[i] = self.tags[i] == "a" or linked[self.parents[i]]
        for node, text in self.texts:
            if node >= 0 and not self.gone[node]:
                size = len(" ".join(text.split()))
                chars[node] += size
                if linked[node]:
                    link_chars[node] += size
        for i in range(n - 1, 0, -1):
            if self.gone[i]:
                continue
            p = self.parents[i]
            chars[p] += chars[i]
            tags[p] += tags[i] + 1
            link_chars[p] += link_chars[i]
            link_tags[p] += link_tags[i] + (self.tags[i] == "a")
        self.menu = [link_tags[i] > 1 and link_chars[i] >= MENU_SHARE * chars[i]
                     and self.tags[i] not in INLINE for i in range(n)]
        share = link_chars[self.body] / max(1, chars[self.body])
        density, total = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            c, lc = chars[i], link_chars[i]
            if c:
                t = max(1, tags[i])
                base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
                ratio = c / max(1, lc) * t / max(1, link_tags[i])
                # a page without any link has base one, where no logarithm exists
                density[i] = c / t * math.log(max(1.0, ratio)) / (math.log(base) if base > 1.0001 else 1.0)
            if i and self.tags[i] not in INLINE:
                total[self.parents[i]] += density[i]
        return density, total

    def content(self) -> list[bool]:
        """Which nodes are content."""
        n = len(self.tags)
        density, total = self.densities()
        # the node with the largest density sum of every subtree; the upper, earlier one of equals
        best = list(range(n))
        for i in range(n - 1, 0, -1):
            p = self.parents[i]
            if total[best[i]] > total[best[p]] or (
                    total[best[i]] == total[best[p]] and best[p] != p and best[i] < best[p]):
                best[p] = best[i]
        main = best[self.body]
        least, node = density[main], main
        while node not in (self.body, -1):
            node = self.parents[node]
            if node >= 0:
                least = min(least, density[node])
        article = [-1] * n  # the outermost article element that a node lies in
        for i in range(1, n):
            article[i] = article[self.parents[i]]
            if article[i] < 0 and self.tags[i] == "article":
                article[i] = i
        marked, reached = [False] * n, [False] * n
        for i in range(self.body, n):
            reached[i] = i == self.body or reached[self.parents[i]]
            if reached[i] and density[i] >= least and density[i] > 0 and self.tags[i] not in INLINE:
                node = best[i]
                marked[article[node] if article[node] >= 0 else node] = True
        for i in range(1, n):
            p = self.parents[i]
            marked[i] = marked[i] or marked[p]
            self.menu[i] = self.menu[p] or self.menu[i] and i != main and article[i] < 0
        return [m and not menu and not gone for m, menu, gone in zip(marked, self.menu, self.gone, strict=True)]

    def text(self) -> str:
        content = self.content()
        blocks, now = [], []
        for node, text in [*self.texts, (-1, "")]:
            if node >= 0 and content[node]:
                now.append(text)
            elif node == -1 and now:
                block = " ".join(html.unescape("".join(now)).split())
                if block:
                    blocks.append(block)
                now = []
        return "\n".join(blocks)


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """page_id, url, text of every row."""
    require(pages, id_col, url_col, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string")
