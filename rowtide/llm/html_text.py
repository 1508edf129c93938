"""Layout-aware text of web pages.

A tree builder closes tags that HTML leaves implied and skips what is not
shown. The renderer writes blocks on lines of their own with blank lines
around paragraphs, marks and indents list items, and aligns table cells.
Pages are independent; Spark spreads them over tasks.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript iframe object svg math datalist title".split())
#: Blocks with a blank line around them, and blocks on lines of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr".split())
BLOCKS = SPACED | frozenset(
    "html body div article section header footer nav aside main address form fieldset li dt dd tr caption "
    "thead tbody tfoot figcaption details summary center option".split()
)
#: For an opening tag, the open tags that it closes, up to a tag that bounds the search.
IMPLIED = {
    "li": ("li", "ul ol"),
    "dt": ("dt dd", "dl"),
    "dd": ("dt dd", "dl"),
    "tr": ("tr td th caption colgroup", "table"),
    "td": ("td th", "tr table"),
    "th": ("td th", "tr table"),
    "tbody": ("tbody thead tfoot tr td th caption colgroup", "table"),
    "thead": ("tbody thead tfoot tr td th caption colgroup", "table"),
    "tfoot": ("tbody thead tfoot tr td th caption colgroup", "table"),
    "option": ("option", "select"),
    "body": ("head", "html"),
}
#: Start tags that leave an open head open; any other one closes it.
HEAD_CONTENT = frozenset("head base basefont bgsound link meta title noscript noframes style script template".split())
CLOSES_P = (BLOCKS - {"html", "body", "tr", "thead", "tbody", "tfoot", "caption", "option"}) | {"hr"}
INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")


class Lines:
    """Lines under construction: collapses white space and keeps block spacing."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line, self.mark, self.blank = "", "", False

    def text(self, data: str, indent: str) -> None:
        data = SPACE.sub(" ", data)
        if not self.line:
            data = data.lstrip(" ")
            if not data:
                return
            self.line = (indent[: len(indent) - len(self.mark)] + self.mark) if self.mark else indent
            self.mark = ""
        elif self.line.endswith(" "):
            data = data.lstrip(" ")
        self.line += data

    def verbatim(self, data: str, indent: str) -> None:
        first, *rest = data.split("\n")
        self.line += first
        for part in rest:
            self.end(keep=True)
            self.line = part

    def end(self, keep: bool = False) -> None:
        if self.line.strip() or keep:
            if self.blank and self.lines:
                self.lines.append("")
            self.lines.append(self.line.rstrip())
            self.blank = False
        self.line = ""

    def space(self) -> None:
        self.end()
        self.blank = True

    def done(self) -> str:
        self.end()
        return "\n".join(self.lines)


class Renderer(HTMLParser):
    """Builds the stack of open elements and renders as they close."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool]] = []  # tag, hidden
        self.places: dict[str, list[int]] = {}  # where each tag is open, outermost first
        self.out = [Lines()]
        self.lists: list[int] = []  # 0 for bullets, else the next number
        self.tables: list[list[list[str]]] = []
        self.pre = 0

    @property
    def indent(self) -> str:
        return "  " * len(self.lists)

    def shut(self, tags: str, bounds: str) -> None:
        """Close the innermost of ``tags`` that is open within ``bounds``."""
        names = tags.split()
        bound = self.innermost(t for t in bounds.split() if t not in names)
        outer = min((p[bisect_right(p, bound)] for t in names if (p := self.places.get(t)) and p[-1] > bound), default=None)
        if outer is not None:
            while len(self.open) > outer:
                self.leave()

    def innermost(self, tags: Iterable[str]) -> int:
        """Where the innermost of ``tags`` is open, -1 if none is."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=-1)

    def enter(self, tag: str, hidden: bool) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, hidden))

    def leave_head(self) -> None:
        """What is no head content closes a head whose end tag is left out."""
        if self.open and self.open[-1][0] == "head":
            self.leave()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "head" and any(t != "html" for t, _ in self.open):
            return  # only the first counts
        if tag not in HEAD_CONTENT and tag != "html":
            self.leave_head()
        if tag in CLOSES_P:
            self.shut("p", "td th li div article section table body button")
        if tag in IMPLIED:
            self.shut(*IMPLIED[tag])
        own = dict(attrs)
        hidden = tag in HIDDEN or "hidden" in own or bool(INVISIBLE.search(own.get("style") or ""))
        hidden = hidden or bool(self.open and self.open[-1][1])
        out = self.out[-1]
        if tag in VOID:
            if not hidden and tag == "br":
                out.end(keep=bool(out.line.strip()))
            elif not hidden and tag == "hr":
                out.space()
            elif not hidden and tag == "img" and own.get("alt"):
                out.text(own["alt"], self.indent)
            return
        if tag in ("td", "th") and not hidden and not self.tables:
            self.tables.append([])
            self.enter("table", False)
        self.enter(tag, hidden)
        if hidden:
            return
        if tag in ("td", "th"):
            if not self.tables[-1]:
                self.tables[-1].append([])
            self.out.append(Lines())
            return
        if tag in SPACED and not (tag in ("ul", "ol") and self.lists):
            out.space()
        elif tag in BLOCKS:
            out.end()
        if tag in ("ul", "ol"):
            self.lists.append(0 if tag == "ul" else 1)
        elif tag == "li":
            if self.lists and self.lists[-1]:
                out.mark = f"{self.lists[-1]}. "
                self.lists[-1] += 1
            else:
                out.mark = "- "
        elif tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag == "pre":
            self.pre += 1

    def leave(self) -> None:
        tag, hidden = self.open.pop()
        self.places[tag].pop()
        if hidden:
            return
        if tag in ("td", "th"):
            cell = SPACE.sub(" ", self.out.pop().done()).strip()
            self.tables[-1][-1].append(cell)
            return
        out = self.out[-1]
        if tag == "table" and self.tables:
            rows = [r for r in self.tables.pop() if any(r)]
            width = [max(len(r[i]) if i < len(r) else 0 for r in rows) for i in range(max(map(len, rows), default=0))]
            out.end()
            for r in rows:
                out.line = self.indent + "  ".join(c.ljust(w) for c, w in zip(r, width))
                out.end()
        if tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        elif tag == "pre":
            self.pre -= 1
        if tag in SPACED and not (tag in ("ul", "ol") and self.lists):
            out.space()
        elif tag in BLOCKS:
            out.end()
            out.mark = ""

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
            return
        if tag in ("body", "html"):
            self.leave_head()
        bound = {"li": ("ul", "ol"), "td": ("table",), "th": ("table",), "tr": ("table",)}.get(tag, ("td", "th"))
        at = self.innermost([tag])
        if tag not in ("table", "tbody", "thead", "tfoot", "body", "html"):
            bound = self.innermost(t for t in bound if t != tag)
            if bound > at:
                return
        while at >= 0 and len(self.open) > at:
            self.leave()

    def handle_data(self, data: str) -> None:
        if data.strip(" \t\n\r\f"):
            self.leave_head()
        if self.open and self.open[-1][1]:
            return
        if self.pre:
            self.out[-1].verbatim(data, self.indent)
        else:
            self.out[-1].text(data, self.indent)


def render(html: str) -> str:
    """All visible text of a page."""
    page = Renderer()
    page.feed(html)
    page.close()
    while page.open:
        page.leave()
    return page.out[0].done()


def extract(pages: DataFrame) -> DataFrame:
    """page_id and text of each row of ``pages`` (page_id, html).

    Null and empty pages have an empty text; page_id may be null or repeat;
    malformed mark-up is read as far as tags can be recognised; other columns
    are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [render(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), pa.array(texts, pa.string())], names=["page_id", "text"]
                )

    html = F.coalesce("html", F.lit("")).alias("html")
    return pages.select(F.col("page_id").cast("long"), html).mapInArrow(run, "page_id long, text string")
