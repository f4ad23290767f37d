"""Visible text of HTML pages, laid out as a reader sees it: blocks apart, lists marked and indented, table cells in columns.

A tree is built from the tags with the end tags (and table rows) that HTML implies, hidden elements are left out, and the rest is
written by one walk over the tree. Both use explicit stacks, so depth is no limit.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from querylode.llm import encoding

# HTML's element categories.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEAD = frozenset("base link meta noscript script style template title head".split())
HIDDEN = frozenset("head script style template noscript title datalist iframe object audio video canvas".split())
#: Not shown inside the key.
FOREIGN = {"svg": frozenset("title desc defs metadata".split()), "math": frozenset(("annotation", "annotation-xml"))}
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol menu dl table pre figure hr fieldset listing".split())
BLOCKS = PARAGRAPHS | frozenset(
    "address article aside body center dd details dialog dir div dt figcaption footer form header hgroup html legend li main nav "
    "optgroup option search section summary caption".split())
CELLS = frozenset(("td", "th"))
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
#: Opening the key closes an open element of the first set, unless one of the second stands between.
IMPLIED = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "td", "th"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl", "td", "th"))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl", "td", "th"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (CELLS | {"caption"}, frozenset(("tr", "table"))),
    "th": (CELLS | {"caption"}, frozenset(("tr", "table"))),
    "tr": (frozenset(("tr", "caption")), frozenset(("table",))),
    **{s: (SECTIONS | {"tr", "caption", "colgroup"}, frozenset(("table",))) for s in SECTIONS},
    "body": (frozenset(("head",)), frozenset()),
}
SCOPE = frozenset(("td", "th", "caption", "table", "button", "html", "template"))

_TAG = re.compile(
    r"<(?:!--(?P<note>.*?)(?:--!?>|\Z)|(?P<odd>[!?][^>]*+)(?:>|\Z)|/(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"'=]|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"']*+)|[\"'])*+)(?:>|\Z))", re.DOTALL)
_NO_BOX = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_SEEN = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)
#: Attributes of a tag that is closed at once, where the grammar is that of XML.
_EMPTY = re.compile(r"(?:^|[\s\"'])/$")
_GAPS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = "") -> None:
        self.tag, self.attrs, self.children = tag, attrs, []


def attribute(attrs: str, name: str) -> str | None:
    """Value of an attribute, "" for one without, None where it is missing."""
    found = re.search(rf"(?:^|[\s/\"']){name}(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*))|(?=[\s/]|$))", attrs, re.I)
    return None if not found else next((g for g in found.groups() if g is not None), "")


class Tree:
    """Open elements and what the next tag does to them."""

    def __init__(self) -> None:
        self.root = Node("html")
        self.stack, self.open = [self.root], Counter(("html",))
        self.places: dict[str, list[int]] = {"html": [0]}  # where in the stack the open elements of a tag are

    def pop(self) -> None:
        tag = self.stack.pop().tag
        self.open[tag] -= 1
        self.places[tag].pop()

    def push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)
        self.open[node.tag] += 1

    def nearest(self, tags: frozenset) -> int:
        """Place of the innermost open element of ``tags``, 0 without any."""
        return max((self.places[t][-1] for t in tags if self.open[t]), default=0)

    def close(self, tags: frozenset, within: frozenset) -> bool:
        """Close up to the nearest open element of ``tags``, unless one of ``within`` stands inside it."""
        at = self.nearest(tags)
        if at == 0 or at < self.nearest(within):
            return False
        while len(self.stack) > at:
            self.pop()
        return True

    def start(self, tag: str, attrs: str) -> None:
        if self.open["head"] and tag not in HEAD:
            self.close(frozenset(("head",)), frozenset())
        if tag in ("html", "body"):
            return
        if tag in BLOCKS and self.open["p"]:
            self.close(frozenset(("p",)), SCOPE)
        if tag in IMPLIED:
            self.close(*IMPLIED[tag])
        if tag in CELLS and self.open["table"] and self.stack[-1].tag != "tr":
            self.start("tr", "")
        if tag == "tr" and self.stack[-1].tag == "table":
            self.push(Node("tbody"))
        node = Node(tag, attrs)
        foreign = tag in FOREIGN or self.open["svg"] or self.open["math"]
        if tag in VOID or foreign and _EMPTY.search(attrs):
            self.stack[-1].children.append(node)
        else:
            self.push(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.stack[-1].children.append(Node("br"))
        elif tag == "p" and not self.close(frozenset(("p",)), SCOPE):
            self.stack[-1].children.append(Node("p"))
        elif tag not in ("p", "html", "body"):
            table = tag in CELLS or tag in SECTIONS or tag in ("tr", "table", "caption")
            self.close(frozenset((tag,)), frozenset(("table",)) - {tag} if table else SCOPE - {tag})


def parse(page: str) -> Node:
    tree, at = Tree(), 0
    while at < len(page):
        found = _TAG.search(page, at)
        if not found:
            tree.stack[-1].children.append(html.unescape(page[at:]))
            break
        if found.start() > at:
            text = html.unescape(page[at : found.start()])
            first = tree.stack[-1].tag in ("pre", "listing") and not tree.stack[-1].children and text[:1] == "\n"
            tree.stack[-1].children.append(text[1:] if first else text)
        at = found.end()
        if found["end"]:
            tree.end(found["end"].lower())
        elif found["start"] and page[at - 1 : at] == ">":
            tag = found["start"].lower()
            tree.start(tag, found["attrs"])
            if tag in RAW and tree.stack[-1].tag == tag:
                stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                text = page[at : stop.start() if stop else len(page)]
                tree.stack[-1].children.append(html.unescape(text) if tag in ("textarea", "title") else text)
                tree.pop()
                at = stop.end() if stop else len(page)
    return tree.root


def boxed(node: Node) -> bool:
    """Whether an element takes part in the page at all; nothing inside another one does."""
    if node.tag in HIDDEN:
        return False
    if not node.attrs:
        return True
    if attribute(node.attrs, "hidden") is not None or node.tag == "input" and (attribute(node.attrs, "type") or "").lower() == "hidden":
        return False
    return not ("style" in node.attrs.lower() and _NO_BOX.search(attribute(node.attrs, "style") or ""))


def seen(node: Node, around: bool) -> bool:
    """Whether text in the element shows: as around it, unless its style says otherwise (the last time it says so)."""
    said = _SEEN.findall(attribute(node.attrs, "style") or "") if "style" in node.attrs.lower() else []
    return said[-1].lower() == "visible" if said else around


class Sheet:
    """Lines of text under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap, self.indent, self.marker, self.space = 0, 0, "", False

    def begin(self) -> None:
        if self.gap > 1 and self.lines:
            self.lines.append("")
        self.gap = 0
        self.line.append(" " * (self.indent - len(self.marker)) + self.marker)
        self.marker, self.space = "", False

    def words(self, text: str) -> None:
        flat = _GAPS.sub(" ", text)
        bare = flat.strip(" ")
        if not bare:
            self.space = self.space or bool(self.line and flat)
            return
        if not self.line:
            self.begin()
        elif self.space or flat[0] == " ":
            self.line.append(" ")
        self.line.append(bare)
        self.space = flat[-1] == " "

    def exact(self, text: str) -> None:
        for i, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                if self.line:
                    self.stop(1)
                else:
                    self.lines.append("")
            if part:
                if not self.line:
                    self.begin()
                self.line.append(part)

    def stop(self, gap: int) -> None:
        if self.line:
            self.lines.append("".join(self.line).replace("\xa0", " ").rstrip())
            self.line, self.space = [], False
        self.gap = max(self.gap, gap)

    def row(self, text: str) -> None:
        self.stop(1)
        self.begin()
        self.line.append(text)
        self.stop(1)


def placed(rows: list[list[tuple[str, int, int]] | None]) -> list[list[tuple[int, str, int]]]:
    """Rows of (text, columns spanned, rows spanned, 0: all) as (column, text, columns spanned); None ends a section and its spans."""
    out, busy = [], {}
    for row in rows:
        if row is None:
            busy = {}
            continue
        at, cells, fresh = 0, [], {}
        for text, span, down in row:
            while at in busy:
                at += 1
            cells.append((at, text, span))
            if down != 1:
                fresh.update((at + k, down - 1) for k in range(span))
            at += span
        busy = {**{column: left - 1 for column, left in busy.items() if left != 1}, **fresh}
        out.append(cells)
    return out


def aligned(rows: list[list[tuple[int, str, int]]]) -> list[str]:
    """Rows of (column, text, columns spanned) as lines whose columns line up; a cell of several lines makes its row as high."""
    width: dict[int, int] = {}
    for row in rows:
        for at, text, span in row:
            if span == 1:
                width[at] = max(width.get(at, 0), *map(len, text.split("\n")))
    out = []
    for row in rows:
        parts = [text.split("\n") for _, text, _ in row]
        for i in range(max(map(len, parts), default=0)):
            end, cells = 0, []
            for (at, _, span), lines in zip(row, parts):
                cells += [" " * width.get(k, 0) for k in range(end, at)]
                room = sum(width.get(at + k, 0) for k in range(span)) + 2 * (span - 1)
                cells.append((lines[i] if i < len(lines) else "").ljust(room))
                end = at + span
            out.append("  ".join(cells).rstrip())
    return out


def render(root: Node) -> str:
    sheets, lists, tables, exact, foreign = [Sheet()], [], [], 0, Counter()
    todo: list[tuple[Node | str, bool]] = [(root, True)]
    shows = [True]
    while todo:
        node, enter = todo.pop()
        sheet = sheets[-1]
        if isinstance(node, str):
            if shows[-1]:
                sheet.exact(node) if exact else sheet.words(node)
            continue
        tag = node.tag
        if enter:
            if not boxed(node) or any(n and tag in FOREIGN[name] for name, n in foreign.items()):
                continue
            if tag in FOREIGN:
                foreign[tag] += 1
            elif tag == "text" and foreign["svg"]:
                sheet.stop(1)
            todo.append((node, False))
            shows.append(seen(node, shows[-1]))
            shown = node.children
            if tag == "details" and attribute(node.attrs, "open") is None:
                shown = [c for c in shown if isinstance(c, Node) and c.tag == "summary"][:1]
            todo.extend((c, True) for c in reversed(shown))
            if tag == "br":
                sheet.stop(1) if sheet.line else sheet.stop(2)
            elif tag == "hr":
                sheet.stop(2)
            elif tag in CELLS and tables:
                sheets.append(Sheet())
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in BLOCKS:
                if not (tag == "table" and tables):
                    sheet.stop(2 if tag in PARAGRAPHS and not (tag in ("ul", "ol", "menu") and lists) else 1)
                if tag in ("ul", "ol", "menu"):
                    first = attribute(node.attrs, "start") or "1"
                    lists.append(int(first) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", first) else 1 if tag == "ol" else None)
                elif tag == "li":
                    mark = "- "
                    if lists and lists[-1] is not None:
                        mark = f"{lists[-1]}. "
                        lists[-1] += 1
                    sheet.indent += len(mark)
                    sheet.marker = mark
                elif tag in ("blockquote", "dd"):
                    sheet.indent += 2
                elif tag == "table":
                    tables.append([])
                elif tag in ("pre", "listing"):
                    exact += 1
            continue
        shows.pop()
        if tag in FOREIGN:
            foreign[tag] -= 1
        elif tag == "text" and foreign["svg"]:
            sheet.stop(1)
        if tag in CELLS and tables:
            sheet.stop(0)
            text = "\n".join(line.rstrip() for line in sheet.lines if line.strip())
            sheets.pop()
            span, down = (attribute(node.attrs, name) or "1" for name in ("colspan", "rowspan"))
            if tables[-1] and tables[-1][-1] is not None:
                tables[-1][-1].append((text, min(1000, int(span)) if re.fullmatch(r"[1-9]\d{0,3}", span) else 1,
                                       min(65534, int(down)) if re.fullmatch(r"\d{1,5}", down) else 1))
            else:
                sheets[-1].words(text)
        elif tag in SECTIONS and tables:
            tables[-1].append(None)
        elif tag == "table" and len(tables) > 1:  # a table in a cell goes on in the cell's line
            inner = aligned([r for r in placed(tables.pop()) if any(t for _, t, _ in r)])
            sheet.words(f" {' '.join(inner)} ")
        elif tag in BLOCKS:
            sheet.stop(2 if tag in PARAGRAPHS and not (tag in ("ul", "ol", "menu") and len(lists) > 1) else 1)
            if tag in ("ul", "ol", "menu"):
                lists.pop()
            elif tag == "li":
                mark = 2 if not lists or lists[-1] is None else len(f"{lists[-1] - 1}. ")
                sheet.indent, sheet.marker = max(0, sheet.indent - mark), ""
            elif tag in ("blockquote", "dd"):
                sheet.indent = max(0, sheet.indent - 2)
            elif tag == "table":
                for line in aligned([r for r in placed(tables.pop()) if any(t for _, t, _ in r)]):
                    sheet.row(line)
                sheet.stop(2)
            elif tag in ("pre", "listing"):
                exact -= 1
    sheets[0].stop(0)
    return "\n".join(sheets[0].lines).strip("\n")


def extract(page: str | None) -> str:
    return render(parse(page)) if page else ""


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, pages in encoding.slices(batch.column("html")):
            texts = [extract(p) for p in pages]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").slice(first, len(pages)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], names=["page_id", "text", "n_chars", "n_lines"])


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, text, n_chars and n_lines of every row of ``pages`` (page_id, html).

    Null and empty pages, and pages without visible text, have an empty text. Pages cut off anywhere are closed where they end.
    Repeated rows stay; other columns are ignored; an empty table gives no rows.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("html").cast("string").alias("html")).mapInArrow(
        _pages, f"page_id {kind}, text string, n_chars long, n_lines long")
