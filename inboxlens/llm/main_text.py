"""Main text of web pages by scoring the containers of their tree.

A page becomes a tree of elements; what is marked as menu, header, footer, sidebar, notice, advert, form,
comment or script is cut off first.  Every paragraph then earns points for its length and its
commas and passes them to its container, half of them to the next one up and a third to the one
above; a container's sum is discounted by the share of its text that is links.  The container with
most points is the article, together with the siblings that score alike; the article's text is
kept whole.

Every step is linear in the length of the page and free of recursion, so very long and very deep pages
are no special case.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.llm.common import fresh, short_batches

# --- fixed values: element names of HTML -------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style xmp iframe noembed noframes title textarea".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math nobr "
    "output q rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr".split()
)
IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Cells and the like: nothing inside closes anything outside.
FENCES = ("td", "th", "caption", "button", "object", "table")
#: Start tags that end an open element, up to the nearest of the elements named last.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "thead": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot"), ("table",)),
    "option": (("option",), ("select", "datalist")),
}
#: Elements that never hold main text.
DROPPED = frozenset(
    "head script style noscript template iframe object embed applet canvas audio video map svg nav "
    "footer aside button select textarea input dialog menu title xmp noembed noframes".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar "
    "tablist form".split()
)
#: Words in a class or id that mark what surrounds an article.
MARKS = frozenset(
    "ad ads adbox adslot adsense advert adverts advertisement advertising sponsor sponsored promo promoted "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager topbar toolbar masthead "
    "header footer colophon sidebar sidenav rail widget widgets comment comments disqus respond replies "
    "reply cookie cookies consent gdpr notice notices notification banner alert popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations trending outbrain taboola".split()
)
COMMENTS = frozenset("comment comments disqus respond replies reply".split())
#: Words that say a mark speaks of something else: "has-sidebar", "page-with-menu", "content-wrapper".
EXCUSES = frozenset(
    "has no with without is show hide hides shows wrap wrapper layout container grid row columns".split()
)
#: Words that mark an article or its container.
GOOD = frozenset("article body content entry main post story text".split())

# --- end of fixed values -----------------------------------------------------------------------

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
#: The same for tags whose quotes don't match.
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
COMMAS = re.compile("[,،、，;]")
#: Paragraphs shorter than this earn nothing.
LEAST_CHARS = 25
#: Bonus of elements named or marked as the article.
BONUS = 25.0
#: A sibling is kept from this share of the best score on.
SIBLING_SHARE = 0.2
#: Lists and boxes of at least three links are menus when links fill this share of their text.
LINKS, LINK_SHARE = 3, 0.8


class Element:
    __slots__ = ("tag", "attributes", "parent", "kids")

    def __init__(self, tag: str, attributes: str, parent: "Element | None") -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.kids: list[Element | str] = []


class Builder:
    """The elements of a page, parents first; tags that don't match are put right as browsers do."""

    def __init__(self, page: str) -> None:
        self.root = Element("body", "", None)
        self.elements = [self.root]
        self.stack = [self.root]
        self.places: dict[str, list[int]] = {}
        self.read(page)

    def last(self, *tags: str) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def text(self, raw: str) -> None:
        if self.places.get("head") and not raw.isspace():
            self.pop_to(self.places["head"][-1])
        self.stack[-1].kids.append(entities.unescape(raw) if "&" in raw else raw)

    def open(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body"):
            if tag == "body":
                self.root.attributes = self.root.attributes or attributes
                if self.places.get("head"):
                    self.pop_to(self.places["head"][-1])
            return
        if self.places.get("head") and tag not in IN_HEAD:
            self.pop_to(self.places["head"][-1])
        if tag in ENDS:
            ended, within = ENDS[tag]
            place = min((p for t in ended if (p := self.last(t)) > self.last(*within)), default=0)
            if place:
                self.pop_to(place)
        if tag not in INLINE and tag not in ("br", "option", "legend", "input", "select", "textarea"):
            place = self.last("p")
            if place > self.last(*FENCES):
                self.pop_to(place)
        made = Element(tag, attributes, self.stack[-1])
        self.elements.append(made)
        self.stack[-1].kids.append(made)
        if tag not in VOID:
            self.places.setdefault(tag, []).append(len(self.stack))
            self.stack.append(made)

    def close(self, tag: str) -> None:
        if tag == "br":
            self.open("br", "")
        if tag in ("html", "body") or not self.places.get(tag):
            return
        place = self.places[tag][-1]
        if tag in FENCES or place > self.last(*FENCES):
            # a style that ends inside a block it doesn't hold ends with the block's own end
            if tag in INLINE and any(e.tag not in INLINE for e in self.stack[place + 1 : place + 9]):
                return
            self.pop_to(place)

    def read(self, page: str) -> None:
        at, size = 0, len(page)
        while at < size:
            mark = page.find("<", at)
            if mark < 0:
                self.text(page[at:])
                return
            if mark > at:
                self.text(page[at:mark])
            found = TAG.match(page, mark) or LOOSE.match(page, mark)
            if found:
                closing, tag, attributes = found[1], found[2].lower(), found[3]
                at = found.end()
                if closing:
                    self.close(tag)
                    continue
                self.open(tag, attributes)
                if tag in RAW and not attributes.endswith("/"):
                    end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
                    at = end.start() if end else size
            elif page.startswith("<!--", mark):
                end = page.find("-->", mark + 2)
                at = end + 3 if end >= 0 else size
            elif page[mark + 1 : mark + 2] in ("!", "?", "/"):
                end = page.find(">", mark)
                at = end + 1 if end >= 0 else size
            elif page[mark + 1 : mark + 2].isalpha() and page[mark + 1] < "\x7f":
                at = size  # a tag that the page ends in
            else:
                self.text("<")
                at = mark + 1


def attributes_of(raw: str) -> dict[str, str]:
    if not raw or raw.isspace():
        return {}
    return {
        m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)
    }


def _marks(attributes: dict[str, str]) -> list[set[str]]:
    """Words of every class and of the id."""
    names = [*attributes.get("class", "").split(), attributes.get("id", "")]
    return [{w.lower() for w in WORDS.findall(n)} for n in names if n]


class Page:
    """Sums over the elements of a page, in the builder's order."""

    def __init__(self, page: str) -> None:
        self.elements = Builder(page).elements
        self.number = {id(e): k for k, e in enumerate(self.elements)}
        self.parent = [self.number[id(e.parent)] if e.parent else -1 for e in self.elements]
        self.attributes = [attributes_of(e.attributes) for e in self.elements]
        self.marks = [_marks(a) for a in self.attributes]
        self.good = [any(m & GOOD and not m & MARKS for m in ms) for ms in self.marks]
        self.articles = self.below(lambda k: self.is_article(k))
        self.inside = [False] * len(self.elements)
        for k, e in enumerate(self.elements[1:], 1):
            up = self.parent[k]
            self.inside[k] = self.inside[up] or self.elements[up].tag == "article"
        whole = self.texts([False] * len(self.elements))[0]
        self.dead = [False] * len(self.elements)
        for k in range(1, len(self.elements)):
            self.dead[k] = self.dead[self.parent[k]] or self.surrounds(k, whole)

    def is_article(self, k: int) -> bool:
        comment = any(m & COMMENTS for m in self.marks[k])
        named = self.attributes[k].get("itemprop") == "articleBody" or self.attributes[k].get("role") in ("main", "article")
        return (self.elements[k].tag in ("article", "main") or named) and not comment

    def below(self, test) -> list[int]:
        """For every element, how many inside it pass the test; itself is not counted."""
        counts = [0] * len(self.elements)
        for k in range(len(self.elements) - 1, 0, -1):
            counts[self.parent[k]] += counts[k] + test(k)
        return counts

    def surrounds(self, k: int, whole: list[int]) -> bool:
        """Whether an element is marked as something around the article."""
        tag, attributes = self.elements[k].tag, self.attributes[k]
        if tag in DROPPED or "hidden" in attributes:
            return True
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
            return True
        # a form or a box that holds the article, or most of the page, is a frame around it
        holds = self.articles[k] > 0
        if tag == "form" or attributes.get("role") == "form":
            return not holds and 2 * whole[k] < whole[0]
        if attributes.get("role") in ROLES:
            return not holds
        if tag == "header":
            return not self.inside[k] and not holds
        if tag in ("article", "main", "html", "body"):
            return tag == "article" and any(m & COMMENTS for m in self.marks[k])
        for words in self.marks[k]:
            hit = words & MARKS
            if not hit or words & EXCUSES:
                continue
            if hit <= {"header", "banner"} and (self.inside[k] or words & GOOD):
                continue  # an article's own heading
            if hit & COMMENTS or not holds:
                return True
        return False

    def texts(self, dead: list[bool]) -> tuple[list[int], list[int], list[int], list[int]]:
        """Characters, characters in links, links, and characters outside inner blocks, of every element."""
        n = len(self.elements)
        chars, linked, links, own = ([0] * n for _ in range(4))
        for k in range(n - 1, -1, -1):
            if dead[k]:
                continue
            e = self.elements[k]
            here = sum(len(" ".join(t.split())) for t in e.kids if isinstance(t, str))
            chars[k] += here
            own[k] += here
            if e.tag == "a" and "href" in self.attributes[k]:
                linked[k], links[k] = chars[k], 1
            if k:
                up = self.parent[k]
                chars[up] += chars[k]
                linked[up] += linked[k]
                links[up] += links[k]
                if e.tag in INLINE:
                    own[up] += own[k]
        return chars, linked, links, own

    def commas(self) -> list[int]:
        """Commas outside inner blocks."""
        counts = [0] * len(self.elements)
        for k in range(len(self.elements) - 1, -1, -1):
            e = self.elements[k]
            counts[k] += sum(len(COMMAS.findall(t)) for t in e.kids if isinstance(t, str))
            if k and e.tag in INLINE:
                counts[self.parent[k]] += counts[k]
        return counts

    def main(self) -> list[int]:
        """The elements, in page order, that make up the article."""
        chars, linked, links, own = self.texts(self.dead)
        for k in range(1, len(self.elements)):
            up = self.parent[k]
            tag = self.elements[k].tag
            menu = (
                tag in ("ul", "ol", "dl", "div", "section", "table")
                and links[k] >= LINKS
                and linked[k] >= LINK_SHARE * chars[k]
            )
            self.dead[k] = self.dead[k] or self.dead[up] or menu
        chars, linked, links, own = self.texts(self.dead)
        scores = self.scores(chars, linked, own)
        live = [k for k in range(len(self.elements)) if not self.dead[k] and chars[k]]
        if not live:
            return []
        best = max(live, key=lambda k: (scores[k], -k))
        if scores[best] <= 0:
            named = [k for k in live if self.is_article(k)]
            return [named[0] if named else 0]
        top = self.lifted(best)
        if not top:
            return [0]
        floor = SIBLING_SHARE * scores[best]
        kept = []
        for kid in self.elements[self.parent[top]].kids:
            if isinstance(kid, str):
                continue
            k = self.number[id(kid)]
            if k == top or self.joins(k, top, floor, scores, chars, linked):
                kept.append(k)
        return kept

    def scores(self, chars: list[int], linked: list[int], own: list[int]) -> list[float]:
        scores = [0.0] * len(self.elements)
        commas = self.commas()
        for k, e in enumerate(self.elements):
            if self.dead[k] or e.tag in INLINE or own[k] < LEAST_CHARS:
                continue
            points = 1.0 + commas[k] + min(own[k] / 100, 3.0)
            # a box with text of its own is its own container
            at = k if e.tag in ("div", "section", "article", "main", "body") else self.parent[k]
            for share in (1.0, 0.5, 1 / 3, 0.25):
                if at < 0:
                    break
                scores[at] += points * share
                at = self.parent[at]
        for k in range(len(scores)):
            if scores[k]:
                bonus = BONUS if self.is_article(k) or self.good[k] else 0.0
                scores[k] = (scores[k] + bonus) * (1 - linked[k] / max(1, chars[k]))
        return scores

    def lifted(self, k: int) -> int:
        """The article that the best container lies in: its nearest named ancestor, if there is one."""
        at = k
        while at > 0:
            if self.is_article(at):
                return at
            at = self.parent[at]
        # headings and single boxes around the best container belong to it
        while self.parent[k] > 0 and self.good[self.parent[k]]:
            k = self.parent[k]
        return k

    def joins(self, k: int, top: int, floor: float, scores, chars, linked) -> bool:
        """Whether a sibling of the best container belongs to the article."""
        if self.dead[k] or not chars[k]:
            return False
        tag, density = self.elements[k].tag, linked[k] / chars[k]
        if self.is_article(top) and self.elements[top].tag != "main":
            return self.is_article(k) and scores[k] >= floor
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup", "header"):
            return True
        if scores[k] >= floor:
            return True
        if tag in ("p", "blockquote", "pre", "figure", "table", "ul", "ol", "dl"):
            return density < (0.25 if chars[k] >= 80 else 0.01)
        return False

    def text(self) -> str:
        """Text of the article, blocks in page order; white space is one blank."""
        pieces: list[str] = []
        stack: list[Element | str] = [self.elements[k] for k in reversed(self.main())]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                pieces.append(item)
            elif not self.dead[self.number[id(item)]]:
                if item.tag in INLINE:
                    stack.extend(reversed(item.kids))
                else:
                    stack.append(" ")
                    stack.extend(reversed(item.kids))
                    stack.append(" ")
        return " ".join("".join(pieces).split())


def main_text(page: str | None) -> str:
    """The main text of one page; empty where there is none."""
    return Page(page).text() if page else ""


def extract(
    pages: DataFrame, *, html_col: str = "html", keep: list[str] | None = None
) -> DataFrame:
    """Every row's kept columns (all but the HTML by default) with ``text`` and ``n_chars``.

    ``n_chars`` counts code points.  Null, empty and unreadable pages, and pages without an article, give
    the empty text; a page without any markup is all text.  Whole pages are read, however long or
    deep, and of the article nothing is dropped but what is marked as surroundings.  Rows that repeat
    give the same text each; a clashing column name gets underscores in front; an empty table gives
    an empty result.
    """
    kept = list(keep) if keep is not None else [c for c in pages.columns if c != html_col]
    rest = pages.select(*kept)
    text, size = fresh(rest, "text"), fresh(rest, "n_chars")
    short_batches(pages.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page) for page in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64()),
                ],
                names=[*kept, text, size],
            )

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema]
    schema = ", ".join([*kinds, f"`{text}` string", f"`{size}` bigint"])
    page = F.col(html_col).cast("string").alias(fresh(pages, "whole_page"))
    return pages.select(page, *kept).mapInArrow(run, schema)


QUERY = "op12_main_text"
#: A tree is not built in SQL; tests compare with articles of planted pages.
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: the main text of all ``pages``."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, keep=["page_id", "url"])
