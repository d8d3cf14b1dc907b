"""Visible text of web pages, laid out as a text browser would.

A tree builder takes the tags as they come: missing end tags are implied (a new paragraph, list
item, row, cell or option ends the open one), stray end tags are ignored, the content of scripts
and styles is never parsed. Elements that a reader doesn't see are left out: head, scripts, media
and form controls without text, the hidden attribute, and display:none or visibility:hidden in a
style attribute; what is visible again inside hidden content is shown. The rest is rendered as lines:
block elements start lines of their own, paragraphs and headings are set off by a blank line, list
items carry a bullet or their number and are indented by depth, cells of a table are laid out as pages
of their own and stand side by side, padded to columns, and pre keeps its spaces.

Defined results: null and empty pages give empty text. Broken markup is text where it can't be a
tag. Elements may be nested to any depth. Repeated rows are rendered one by one. Very long pages: spaces
of indentation and alignment add at most PADDING characters and PADDING_PER_CHARACTER for each of the
page; tables and lists that need more get narrower columns or none, and lose no text.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from itertools import accumulate
from collections.abc import Generator, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import spans

#: Element names of the HTML standard, by how they are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript title audio video svg math iframe noembed noframes datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre xmp plaintext ul ol dl table figure hr".split())
AS_TYPED = frozenset("pre xmp plaintext textarea".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside header footer main nav address li dt dd fieldset form details "
    "dialog summary figcaption legend center dir menu caption option optgroup select textarea hgroup search".split()
)
PARTS = frozenset("tr td th thead tbody tfoot caption colgroup col".split())
#: A start tag ends these open elements, up to the nearest of the containers.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
_PARAGRAPH_ENDS = (BLOCK | {"hr"}) - {"html", "body", "li", "option", "optgroup", "select", "textarea"}
_NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\b", re.I)
_COMMENT_END = re.compile("--!?>")
_SPACE = re.compile(r"[ \t\n\r\f]+")

#: Spaces that indentation and alignment may add to a page.
PADDING = 1 << 16
PADDING_PER_CHARACTER = 16
#: Widths that columns of a table are cut to, one after the other, until the spaces suffice.
COLUMN_WIDTHS = (1 << 40, 64, 32, 16, 8)


class Element:
    __slots__ = ("name", "attributes", "children", "shown")

    def __init__(self, name: str, attributes: dict[str, str | None], shown: bool = True):
        self.name, self.attributes = name, attributes
        self.children: list[Element | str] = []
        found = _VISIBILITY.findall(attributes.get("style") or "")
        self.shown = found[-1].lower() == "visible" if found else shown

    def seen(self) -> bool:
        """Whether it is laid out at all; its own text shows only where ``shown``."""
        a = self.attributes
        if self.name in UNSEEN or "hidden" in a or (self.name == "input" and (a.get("type") or "").lower() == "hidden"):
            return False
        if self.name == "dialog" and "open" not in a:
            return False
        return not (a.get("style") and _NOT_DISPLAYED.search(a["style"]))


class TreeBuilder(HTMLParser):
    #: Elements whose content is never parsed as markup.
    CDATA_CONTENT_ELEMENTS = ("script", "style", "xmp", "iframe", "noembed", "noframes", "plaintext")

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]
        self.at: dict[str, list[int]] = {}  # where in open the elements of each name are, but for the root

    def set_cdata_mode(self, elem: str, **_) -> None:
        self.cdata_elem = elem.lower()
        # no tag ends plaintext
        self.interesting = re.compile("(?!)" if elem == "plaintext" else rf"</{elem}(?=[ \t\n\r\f/>])", re.I)

    def parse_endtag(self, i: int) -> int:
        if self.cdata_elem is None:
            return super().parse_endtag(i)
        end = self.rawdata.find(">", i)
        if end >= 0:
            name = self.cdata_elem
            self.clear_cdata_mode()
            self.handle_endtag(name)
        return end + 1 or -1

    def parse_comment(self, i: int, report: int = 1) -> int:
        for short in (">", "->"):
            if self.rawdata.startswith(short, i + 4):
                return i + 4 + len(short)
        end = _COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def finish(self) -> Element:
        self.close()
        if self.cdata_elem is not None and self.rawdata:
            self.handle_data(self.rawdata)  # the page ends inside it
        return self.root

    def _last(self, names: set[str] | tuple[str, ...]) -> int:
        return max((self.at[x][-1] for x in names if self.at.get(x)), default=0)

    def _end(self, at: int) -> None:
        while len(self.open) > at:
            self.at[self.open.pop().name].pop()

    def _close(self, names: set[str], within: set[str]) -> None:
        """End the outermost open element of the names inside the nearest container."""
        bound = self._last(within | {"table"})
        inside = [found[i] for x in names if (found := self.at.get(x)) and (i := bisect_right(found, bound)) < len(found)]
        if inside:
            self._end(min(inside))

    def handle_starttag(self, name: str, attributes: list[tuple[str, str | None]]) -> None:
        if name == "html":
            return
        if name in IMPLIED:
            self._close(*IMPLIED[name])
        if name in _PARAGRAPH_ENDS:
            self._close({"p"}, {"td", "th", "table", "li", "button", "object"})
        if "head" in (e.name for e in self.open[1:2]) and name not in UNSEEN | {"base", "link", "meta"}:
            self._end(1)  # content begins without a body tag
        element = Element(name, dict(attributes), self.open[-1].shown)
        self.open[-1].children.append(element)
        if name not in VOID:
            self.at.setdefault(name, []).append(len(self.open))
            self.open.append(element)

    def handle_startendtag(self, name: str, attributes: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(name, attributes)

    def handle_endtag(self, name: str) -> None:
        if name == "br":
            self.open[-1].children.append(Element("br", {}))
            return
        at = self._last((name,))
        if name not in PARTS | {"table"} and self._last(("td", "th", "table")) > at:
            return  # an end tag in a cell can't end what is outside
        if at:
            self._end(at)

    def handle_data(self, data: str) -> None:
        if self.open[-1].name == "head" and data.strip():
            self._end(len(self.open) - 1)
        self.open[-1].children.append(data)


class Lines:
    """Collects lines; spaces between words are collapsed, blank lines come from margins only.

    Items nest: the first line of an item carries its mark, later ones are indented by the mark's width.
    ``room`` holds one number, the spaces that the page may still add.
    """

    def __init__(self, room: list[int]):
        self.done: list[str] = []
        self.line = ""
        self.room = room
        self.gap = self.held = False  # a margin inside the item; one before it
        self.fresh = True  # the item has no line yet
        self.marks: list[str] = []  # of items without a line
        self.base = self.indent = 0  # before the marks; after them
        self.items: list[tuple] = []

    def text(self, data: str, keep: bool) -> None:
        if keep:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self.line += first
            for x in rest:
                self.flush(keep=True)
                self.line = x
            return
        data = _SPACE.sub(" ", data)
        if not self.line or self.line.endswith(" "):
            data = data.removeprefix(" ")
        self.line += data

    def flush(self, keep: bool = False) -> None:
        line = self.line if keep else self.line.rstrip(" ")
        if line or keep:
            if (self.held if self.fresh else self.gap) and self.done:
                self.done.append("")
            self.gap = self.held = self.fresh = False
            spaces = self.base if self.base <= self.room[0] and line else 0
            self.room[0] -= spaces
            self.done.append((" " * spaces + "".join(self.marks) + line).rstrip())
            self.marks, self.base = [], self.indent
        self.line = ""

    def enter(self, mark: str) -> None:
        self.flush()
        self.items.append((len(self.done), len(self.marks), self.base, self.indent, self.gap, self.held, self.fresh))
        if not self.fresh:
            self.held = self.gap
        self.gap, self.fresh = False, True
        self.marks.append(mark)
        self.indent += len(mark)

    def leave(self) -> None:
        self.flush()
        lines, marks, base, self.indent, gap, held, fresh = self.items.pop()
        while len(self.done) > lines and not self.done[-1]:
            self.done.pop()
        if len(self.done) > lines:
            self.base, self.gap, self.fresh = self.indent, False, False
        else:
            self.base, self.gap, self.held, self.fresh = base, gap, held, fresh
            del self.marks[marks:]

    def block(self, lines: list[str]) -> None:
        self.flush()
        for self.line in lines:
            self.flush(keep=True)


def _run(task: Generator):
    """What the task returns. Tasks yield the tasks whose results they need, so depth is no recursion."""
    stack, value = [task], None
    while stack:
        try:
            task = stack[-1].send(value)
        except StopIteration as end:
            stack.pop()
            value = end.value
        else:
            stack.append(task)
            value = None
    return value


def _lines(element: Element, room: list[int]) -> Generator:
    out = Lines(room)
    yield _walk(element, out, False)
    out.flush()
    while out.done and not out.done[-1]:
        out.done.pop()
    return out.done


def _walk(element: Element, out: Lines, keep: bool) -> Generator:
    number, step = _numbering(element) if element.name == "ol" else (0, 0)
    for child in element.children:
        if isinstance(child, str):
            if element.shown:
                out.text(child, keep)
            continue
        if not child.seen():
            continue
        name = child.name
        if name == "br":
            if out.line:
                out.flush(keep)
            else:
                out.gap = True
        elif name in BLOCK or name in PARTS:
            out.flush()
            out.gap |= name in SPACED and not (name in ("ul", "ol") and element.name == "li")
            if name == "table":
                out.block((yield _table(child, out.room)))
            elif name in ("li", "dd", "blockquote"):
                mark = "- " if name == "li" else "  "
                if name == "li" and element.name == "ol":
                    number = _whole(child, "value", number)
                    mark = f"{number}. "
                    number += step
                out.enter(mark)
                yield _walk(child, out, False)
                out.leave()
            else:
                yield _walk(child, out, keep or name in AS_TYPED)
                out.flush()
            out.gap |= name in SPACED and not (name in ("ul", "ol") and element.name == "li")
        else:
            yield _walk(child, out, keep)


def _whole(element: Element, name: str, default: int) -> int:
    value = (element.attributes.get(name) or "").strip()
    return int(value) if re.fullmatch("-?[0-9]{1,9}", value) else default


def _numbering(element: Element) -> tuple[int, int]:
    """Number of the first item and the step to the next."""
    if "reversed" not in element.attributes:
        return _whole(element, "start", 1), 1
    items = sum(isinstance(x, Element) and x.name == "li" and x.seen() for x in element.children)
    return _whole(element, "start", items), -1


def _rows(element: Element, rest: list[Element | str], holders: set[int]) -> Generator:
    """Rows of a table, not those of tables inside its cells; cells without a row make one. Rows and
    cells are also found inside other elements; whatever is in none of them goes to rest. None stands
    before and after a row group, where cells that span rows end."""
    rows: list[list[Element] | None] = []
    loose: list[Element] = []
    for child in element.children:
        if isinstance(child, str):
            if element.shown:
                rest.append(child)
        elif not child.seen():
            continue
        elif child.name in ("td", "th"):
            loose.append(child)
        elif child.name == "tr":
            rows.append([cell for cells in (yield _rows(child, rest, holders)) for cell in cells or ()])
        elif id(child) in holders and child.name in ("thead", "tbody", "tfoot"):
            rows += [None, *(yield _rows(child, rest, holders)), None]
        elif id(child) in holders:
            rows += yield _rows(child, rest, holders)
        else:
            rest.append(child)
    return [*rows, loose] if loose else rows


def _holders(table: Element) -> set[int]:
    """Ids of the elements that rows or cells of the table lie in."""
    todo, above, out = [table], {}, set()
    while todo:
        element = todo.pop()
        for child in element.children:
            if isinstance(child, Element) and child.name not in ("table", "caption") and child.seen():
                above[id(child)] = at = id(element)
                while child.name in ("tr", "td", "th") and at not in out:
                    out.add(at)
                    at = above.get(at, at)
                if child.name not in ("td", "th"):
                    todo.append(child)
    return out


def _span(cell: Element, name: str, least: int, most: int) -> int:
    value = (cell.attributes.get(name) or "1").strip()
    return min(max(int(value), least), most) if value.isascii() and value.isdigit() and len(value) < 6 else 1


def _wide(text: str) -> int:
    """Columns of a screen that the text takes."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(x) else 1 + (unicodedata.east_asian_width(x) in "WF") for x in text)


def _merged(spans_below: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out: list[tuple[int, int, int]] = []
    for start, end, until in sorted(spans_below):
        if out and out[-1][1] == start and out[-1][2] == until:
            out[-1] = (out[-1][0], end, until)
        else:
            out.append((start, end, until))
    return out


def _table(table: Element, room: list[int]) -> Generator:
    """Rows with the lines of their cells side by side, each cell from its column's place on."""
    rest = Element("div", {})  # what isn't part of a cell: captions and misplaced content
    rows: list[list[tuple[int, list[str]]]] = []
    widths: dict[int, int] = {}
    above: list[tuple[int, int, int]] = []  # columns taken by cells from above: first, end, the row they end before
    for cells in (yield _rows(table, rest.children, _holders(table))):
        if cells is None:
            above = []
            continue
        above = [x for x in above if x[2] > len(rows)]
        row, column, passed, below = [], 0, 0, []
        for cell in cells:
            while passed < len(above) and above[passed][0] <= column:
                column = max(column, above[passed][1])
                passed += 1
            span, down = _span(cell, "colspan", 1, 1000), _span(cell, "rowspan", 0, 65534) or 1 << 40  # 0: the rest of the group
            lines = yield _lines(cell, room)
            row.append((column, lines))
            if span == 1:
                widths[column] = max(widths.get(column, 0), max(map(_wide, lines), default=0))
            if down > 1:
                below.append((column, column + span, len(rows) + down))
            column += span
        above = _merged(above + below) if below else above
        rows.append(row)
    out = [x for x in (yield _lines(rest, room)) if x]
    places = _places(rows, widths, room)
    for row in rows:
        for i in range(max((len(lines) for _, lines in row), default=0)):
            line, wide = [], 0
            for column, lines in row:
                if i < len(lines) and lines[i]:
                    gap = max(places.get(column, 0) - wide, 2 if line else 0)
                    line += [" " * gap, lines[i]]
                    wide += gap + _wide(lines[i])
            out.append("".join(line))
    return out


def _places(rows: list[list[tuple[int, list[str]]]], widths: dict[int, int], room: list[int]) -> dict[int, int]:
    """Where the cells of each column begin, for the widest columns whose spaces the page may still add.
    Empty where none fit: cells are then set off by two spaces."""
    known, starts = sorted(widths), {column for row in rows for column, _ in row}
    for most in COLUMN_WIDTHS:
        before = [0, *accumulate(min(widths[x], most) for x in known)]
        places = {x: before[bisect_left(known, x)] + 2 * x for x in starts}
        needed = 0
        for row in rows:
            done = 0
            for column, lines in reversed(row):  # lines of each height, by the last cell that has them
                needed += max(len(lines) - done, 0) * places[column]
                done = max(done, len(lines))
        if needed <= room[0]:
            room[0] -= needed
            return places
    return {}


def render(html: str | None) -> str:
    if not html:
        return ""
    builder = TreeBuilder()
    builder.feed(html)
    room = [PADDING + PADDING_PER_CHARACTER * len(html)]
    return "\n".join(_run(_lines(builder.finish(), room)))


def extract(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url and the visible text of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.sliced(batches, "html"):
            texts = [render(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), pages["html"].alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
