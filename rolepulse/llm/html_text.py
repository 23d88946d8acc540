r"""Visible text of pages by layout: a tree with implied tags, visibility rules, and block rendering.

The tree builder closes what HTML leaves open (paragraphs before blocks, list items, table parts,
options, the head before anything that is shown) and knows void elements; a comment that nothing
ends goes to the end of the page. Hidden are scripts, styles, templates and the like, elements
with ``hidden``, hidden inputs, and inline ``display:none``; ``visibility:hidden`` hides until a
child is made visible. Blocks stand on lines of their own, paragraphs, headings, lists and tables
behind a blank line; list items have ``- `` or their number, indented by depth; ``pre`` keeps its
blanks; ``br`` breaks the line; images give their ``alt``, drawings and formulas their text. Cells of a table are
padded to the width of their column and parted by two blanks; a cell that spans columns or rows keeps
those behind and below it in their columns; cells that hold lines are joined by blanks.

All visible text of the whole page is kept, headers and footers too. Both walks use stacks of
their own, so that depth is no limit.

Defined cases: a null or empty html, or one without visible text, gives the empty text. Repeated
rows and null ids get rows each. Other columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from rolepulse.llm.texts import by_rows, table

# Fixed values of the format.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title meta link base script style template noscript iframe object audio video canvas datalist noframes noembed".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr fieldset".split())
BLOCKS = SPACED | frozenset("address article aside body center dd details dialog dir div dt fieldset figcaption footer form header hgroup html legend li main menu nav optgroup option search section select summary text textarea tr caption".split())
#: In a head; anything else ends it.
IN_HEAD = frozenset("title meta link base script style template noscript basefont bgsound noframes".split())
#: Hidden inside of a drawing or a formula.
UNDRAWN = frozenset("defs symbol desc metadata clippath mask marker pattern annotation annotation-xml".split())
MOST_COLUMNS, MOST_ROWS = 1000, 65534
LISTS = frozenset("ul ol menu dir".split())
PARTS = frozenset("thead tbody tfoot".split())
CELLS = frozenset("td th".split())
#: What an opening tag closes, and the elements beyond which it does not look.
CLOSES = {
    "li": (frozenset({"li"}), LISTS),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "caption", "colgroup"}), frozenset({"table"}) | PARTS),
    "td": (CELLS, frozenset({"tr", "table"})), "th": (CELLS, frozenset({"tr", "table"})),
    **{t: (PARTS | {"caption", "colgroup"}, frozenset({"table"})) for t in PARTS},
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "body": (frozenset({"head"}), frozenset()),
}
#: A ``p`` is closed by these, unless one of the others is between.
CLOSES_P = SPACED | frozenset("address article aside center details div dd dt footer form header li main menu nav section".split())
P_WALLS = frozenset("button table td th caption object".split())

_BLANKS = re.compile(r"[ \t\n\r\f]+")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(\w+)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


class Tree(HTMLParser):
    """A tree of the page; ``counts`` tells at once whether an element is open at all."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open, self.counts = [self.root], {}

    def close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self.counts[self.open.pop().tag] -= 1

    def close_within(self, tags: frozenset, walls: frozenset) -> None:
        """Close the outermost of ``tags`` that is open inside of the innermost of ``walls``."""
        if not any(self.counts.get(t) for t in tags):
            return
        found = None
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.open[depth].tag
            if tag in walls:
                break
            if tag in tags:
                found = depth
        if found:
            self.close_to(found)

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self.close_within(frozenset({"p"}), P_WALLS)
        if tag in CLOSES:
            self.close_within(*CLOSES[tag])
        if tag in BLOCKS and tag != "html":
            self.close_within(frozenset({"head"}), frozenset())
        elif self.open[-1].tag == "head" and tag not in IN_HEAD:
            self.close_to(len(self.open) - 1)
        node = Node(tag, dict(attrs))
        if tag in UNDRAWN and (self.counts.get("svg") or self.counts.get("math")):
            node.attrs["hidden"] = ""
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "br":
            self.handle_starttag(tag, [])
        elif self.counts.get(tag):
            walls = frozenset({"table"}) if tag in CELLS | PARTS | {"tr", "li", "p"} else frozenset()
            for depth in range(len(self.open) - 1, 0, -1):
                if self.open[depth].tag == tag:
                    return self.close_to(depth)
                if self.open[depth].tag in walls:
                    return None
        return None

    def handle_data(self, data):
        if self.open[-1].tag == "head" and _BLANKS.sub("", data):
            self.close_to(len(self.open) - 1)
        self.open[-1].children.append(data)

    def finish(self) -> Node:
        if self.rawdata.startswith(("<!", "<?")):  # a comment or the like that nothing ends
            self.rawdata = ""
        self.close()
        return self.root


class Lines:
    """Lines of a block in work: blanks are collapsed, a space between two texts is kept."""

    def __init__(self):
        self.lines, self.parts, self.space, self.gap, self.marker = [], [], False, False, None
        self.indent = ""

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *more = data.replace("\r\n", "\n").split("\n")
            self.parts.append(first)
            for line in more:
                self.end(keep_empty=True)
                self.parts.append(line)
            return
        shown = _BLANKS.sub(" ", data)
        if shown == " ":
            self.space = self.space or bool(self.parts)
        elif shown:
            if self.parts and (self.space or shown[0] == " "):
                self.parts.append(" ")
            self.parts.append(shown.strip(" "))
            self.space = shown[-1] == " "

    def end(self, keep_empty: bool = False) -> None:
        line = "".join(self.parts).rstrip(" ")
        self.parts, self.space = [], False
        if line or (keep_empty and self.lines):
            if self.gap and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap = False
            if self.marker is not None and line:
                line, self.marker = self.marker + line, None
            elif line:
                line = self.indent + line
            self.lines.append(line)

    def space_out(self) -> None:
        self.end()
        self.gap = True

    def done(self) -> str:
        self.end()
        return "\n".join(self.lines).strip("\n")


def span(node: Node, name: str, most: int) -> int:
    value = (node.attrs.get(name) or "").strip()
    return min(max(int(value), 1), most) if re.fullmatch(r"[0-9]{1,9}", value) else 1


def placed(rows: list[list[tuple[str, int, int]]]) -> list[list[tuple[int, int, str]]]:
    """Rows of cells (text, columns, rows) as (first column, columns, text); cells give way to those that reach down to them."""
    below: dict[int, int] = {}
    out = []
    for row in rows:
        at, line, taken = 0, [], {c for c, n in below.items() if n}
        below = {c: n - 1 for c, n in below.items() if n > 1}
        for text, columns, down in row:
            while at in taken:
                at += 1
            line.append((at, columns, text))
            if down > 1:
                below.update(dict.fromkeys(range(at, at + columns), down - 1))
            at += columns
        out.append(line)
    return out


def aligned(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Lines of the rows that hold a text, each column as wide as its widest cell; the last cell of a row needs no width."""
    lines = [line for line in placed(rows) if any(text for *_, text in line)]
    widths: dict[int, int] = {}
    for line in lines:
        for at, columns, text in line[:-1]:
            if columns == 1:
                widths[at] = max(widths.get(at, 0), len(text))
    for line in lines:
        for at, columns, text in line[:-1]:
            if columns > 1:
                room = sum(widths.get(c, 0) for c in range(at, at + columns)) + 2 * (columns - 1)
                widths[at + columns - 1] = widths.get(at + columns - 1, 0) + max(0, len(text) - room)
    starts, start = [], 0
    for c in range(max((line[-1][0] for line in lines), default=-1) + 1):
        starts.append(start)
        start += widths.get(c, 0) + 2
    out = []
    for line in lines:
        shown = ""
        for at, _, text in line:
            shown = shown.ljust(starts[at]) + text
        out.append(shown.rstrip(" "))
    return out


class Table:
    def __init__(self, around: Lines):
        self.around, self.rows, self.before = around, [], Lines()  # before: captions and what else is outside of cells


def unseen(node: Node) -> bool:
    a = node.attrs
    return (node.tag in UNSEEN or "hidden" in a or (node.tag == "input" and (a.get("type") or "").lower() == "hidden")
            or bool(_NOT_SHOWN.search(a.get("style") or "")))


def render(root: Node) -> str:
    """Visible text of a tree."""
    out, tables, lists = Lines(), [], []
    stack: list = [(root, True, False)]  # a node, whether it is visible, whether blanks are kept; a function: what to do at its end
    while stack:
        item = stack.pop()
        if callable(item):
            out = item(out)
            continue
        node, visible, pre = item
        if isinstance(node, str):
            if visible:
                out.text(node, pre)
            continue
        if unseen(node):
            continue
        tag, style = node.tag, node.attrs.get("style")
        if style and (v := _VISIBILITY.findall(style)):
            visible = v[-1].lower() not in ("hidden", "collapse")
        pre = pre or tag in ("pre", "textarea")
        if tag == "br":
            out.end(keep_empty=False)
        elif tag == "img" and visible and node.attrs.get("alt"):
            out.text(node.attrs["alt"], False)
        elif tag == "input" and visible and (node.attrs.get("type") or "text").lower() in ("text", "submit", "button", "reset") and node.attrs.get("value"):
            out.text(node.attrs["value"], False)
        if tag == "table":
            out.space_out()
            tables.append(Table(out))
            out = tables[-1].before

            def end_table(_):
                t = tables.pop()
                around = t.around
                caption = t.before.done()
                for line in (caption.split("\n") if caption else []) + aligned(t.rows):
                    around.parts.append(line)
                    around.end()
                around.gap = True
                return around

            stack.append(end_table)
        elif tag == "tr" and tables:
            tables[-1].rows.append([])
        elif tag in CELLS and tables:
            own, before = tables[-1], out
            if not own.rows:
                own.rows.append([])
            out = Lines()

            def end_cell(cell, own=own, before=before, size=(span(node, "colspan", MOST_COLUMNS), span(node, "rowspan", MOST_ROWS))):
                own.rows[-1].append((" ".join(x for x in map(str.strip, cell.done().split("\n")) if x), *size))
                return before

            stack.append(end_cell)
        elif tag in BLOCKS:
            nested = tag in LISTS and bool(lists)
            if tag in SPACED and not nested:
                out.space_out()
            else:
                out.end()
            indent = out.indent
            if tag in LISTS:
                start = node.attrs.get("start") or ""
                lists.append([tag == "ol", int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
            elif tag == "li":
                mark = "- "
                if lists and lists[-1][0]:
                    mark, lists[-1][1] = f"{lists[-1][1]}. ", lists[-1][1] + 1
                out.marker, out.indent = indent + mark, indent + " " * len(mark)
            elif tag in ("dd", "blockquote"):
                out.indent = indent + "  "

            def end_block(o, tag=tag, indent=indent, nested=nested):
                o.end()
                if tag in LISTS:
                    lists.pop()
                if tag == "li":
                    o.marker = None
                o.indent = indent
                o.gap = o.gap or (tag in SPACED and not nested)
                return o

            stack.append(end_block)
        stack.extend((c, visible, pre) for c in reversed(node.children))
    return out.done()


def visible_text(html: str | None) -> str:
    if not html:
        return ""
    tree = Tree()
    tree.feed(html)
    return render(tree.finish())


_TEXT = pa.schema([("page_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64())])


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, text and its length in code points, of each row."""
    def rows(batch):
        for page_id, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = visible_text(html)
            yield page_id, text, len(text)

    return pages.select("page_id", "html").mapInArrow(by_rows(rows, _TEXT), "page_id long, text string, n_chars long")


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
